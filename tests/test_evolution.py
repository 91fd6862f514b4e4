"""Appends with changing types (S13-S15), balanced writes, order over ranges."""

import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlake.operators import ranges
from voltlake.sources import evolve, lake


def name(what):
    return f"{what}_{uuid.uuid4().hex[:8]}"


def day(i):
    return dt.datetime(2024, 1, 1 + i // 24, i % 24)


def test_lattice():
    i, lo, d, s, t = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()
    assert evolve.join_types(i, lo) == lo and evolve.join_types(lo, d) == d and evolve.join_types(d, i) == d
    assert evolve.join_types(lo, s) == s and evolve.join_types(t, d) == s and evolve.join_types(T.NullType(), d) == d
    for a in (lo, d, s, t):
        for b in (lo, d, s, t):
            assert evolve.join_types(a, b) == evolve.join_types(b, a)
            for c in (lo, d, s, t):
                assert evolve.join_types(evolve.join_types(a, b), c) == evolve.join_types(a, evolve.join_types(b, c))


def test_decimals_after_whole_numbers(spark, tmp_dir):
    """A first delivery of whole numbers must not cut the fraction of later ones."""
    t = name("lake_humidity")
    place = os.path.join(tmp_dir, "humidity")
    for rows, kind in (([(1, day(0)), (2, day(30))], "int"), ([(3.7, day(1))], "double"), ([(4, day(2))], "long"), ([("dry", day(3))], "string"), ([(5.5, day(4))], "double")):
        df = spark.createDataFrame(rows, f"humidity {kind}, datetime timestamp_ntz")
        lake.append_lake(df, t, location=place)
    got = sorted((r.datetime, r.humidity) for r in spark.table(t).collect())
    assert got == [(day(0), "1"), (day(1), "3.7"), (day(2), "4.0"), (day(3), "dry"), (day(4), "5.5"), (day(30), "2")]
    assert evolve.versions(spark, t) == [f"{t}__v1", f"{t}__v2", f"{t}__v3"]
    plan = spark.table(t).where("day = DATE'2024-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(day") == 3
    evolve.drop_versions(spark, t)
    assert not spark.catalog.tableExists(t)


def test_new_columns_in_every_version(spark):
    t = name("lake_cols")
    lake.append_lake(spark.createDataFrame([(1, day(0))], "a int, datetime timestamp_ntz"), t)
    lake.append_lake(spark.createDataFrame([(0.5, "x", day(1))], "a double, b string, datetime timestamp_ntz"), t)
    lake.append_lake(spark.createDataFrame([("y", 7, day(2))], "b string, c long, datetime timestamp_ntz"), t)
    got = sorted((r.datetime, r.a, r.b, r.c) for r in spark.table(t).collect())
    assert got == [(day(0), 1.0, None, None), (day(1), 0.5, "x", None), (day(2), None, "y", 7)]


def test_whole_numbers_beyond_doubles_become_texts(spark):
    t = name("lake_big")
    big = (1 << 53) + 1
    lake.append_lake(spark.createDataFrame([(big,)], "v long"), t)
    lake.append_lake(spark.createDataFrame([(0.25,)], "v double"), t)
    assert sorted(r.v for r in spark.table(t).collect()) == ["0.25", str(big)]


def test_fixed_schema_refuses_loss(spark):
    df = spark.createDataFrame([(1.5,)], "v double")
    with pytest.raises(TypeError, match="without loss"):
        lake.conform(df, T.StructType([T.StructField("v", T.LongType())]))
    assert lake.conform(df, T.StructType([T.StructField("v", T.DoubleType()), T.StructField("w", T.LongType())])).first() == (1.5, None)


def test_one_large_day_is_written_by_many_tasks(spark, tmp_dir):
    place = os.path.join(tmp_dir, "hot")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        df = spark.range(60_000).repartition(8).select(F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(day(0)).cast("timestamp_ntz").alias("datetime"))
        lake.append_lake(df, name("lake_hot"), location=place)
        files = [f for f in os.listdir(os.path.join(place, "day=2024-01-01")) if f.endswith(".parquet")]
        assert len(files) > 4
    finally:
        spark.conf.set(key, before)
    small = os.path.join(tmp_dir, "small")
    lake.append_lake(df.limit(500).repartition(8), name("lake_small"), location=small)
    assert len([f for f in os.listdir(os.path.join(small, "day=2024-01-01")) if f.endswith(".parquet")]) == 1


def test_dense_ids_over_ranges(spark):
    rng = random.Random(1)
    rows = list({(rng.choice([1, 1, 1, rng.randint(0, 50), None]), rng.randint(0, 10**6)) for _ in range(3000)})
    df = spark.createDataFrame(rows, "user_id long, at long")
    got = ranges.dense_ids(df, ["user_id", "at"], offset=10, ranges=7)
    assert got.columns == ["user_id", "at", "_id"]
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [(r.user_id, r.at) for r in sorted(got.collect(), key=lambda r: r._id)] == want
    assert sorted(r._id for r in got.collect()) == list(range(11, 11 + len(rows)))
    # a user with most rows is spread: no range holds much more than its share
    sizes = [r["count"] for r in ranges.in_ranges(df, ["user_id", "at"], 7).groupBy(ranges.RANGE).count().collect()]
    assert len(sizes) == 7 and max(sizes) < 2 * len(rows) / 7
    assert ranges.dense_ids(df.limit(0), ["user_id", "at"]).count() == 0


def test_fill_over_long_series(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", None]), i, rng.choice([None, None, None, 1.5 * i]), rng.choice([None] * 40 + [str(i)])) for i in range(2000)]
    rows += [("c", i, None, None) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t long, x double, y string").repartition(4)
    got = {(r.k, r.t): (r.x, r.y) for r in ranges.fill_forward(df, ["x", "y"], ["k"], ["t"], ranges=9).collect()}
    held, want = {}, {}
    for k, t, x, y in sorted(rows, key=lambda r: r[1]):
        a, b = held.get(k, (None, None))
        held[k] = want[(k, t)] = (a if x is None else x, b if y is None else y)
    assert got == want
    plan = ranges.fill_forward(df, ["x", "y"], ["k"], ["t"], ranges=9)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and sum("_range" in line.split("], [")[1] for line in windows) >= 1
