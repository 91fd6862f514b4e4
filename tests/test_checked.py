"""Checks at write, coverage of requests, documents by name, bucketed marts."""

import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from voltlake.operators import coverage
from voltlake.plans import marts
from voltlake.sources import checked, named
from voltlake.sources import fixtures as fx
from voltlake.sources.landing import weather_documents
from voltlake.sources.lake import DIM_DDL

SF = "/root/testdata/sf0.001"


def test_bad_loads_are_refused(spark, tmp_dir):
    t = checked.create_checked(spark, f"unit_{uuid.uuid4().hex[:8]}", DIM_DDL["unit_DIMEN"], ["_id"], os.path.join(tmp_dir, "unit"))
    frame = lambda rows: spark.createDataFrame(rows, "_id long, unit_short string, unit_long string, unit_class string")
    assert not any(checked.load(t, frame([(1, "MAW", "Megawatt", "power"), (2, "EUR", "Euro", "money")]), "a").values())
    with pytest.raises(checked.Refused) as e:
        checked.load(t, frame([(3, None, "x", "y"), (3, "b", "x", "y"), (2, "c", "x", "y"), (None, "d", "x", "y"), (None, "e", "x", "y"), (4, "f", "x", "y")]), "b")
    assert {k: n for k, n in e.value.verdict.items() if n} == {("key", "_id"): 1, ("key is there", "_id"): 1, ("not null", "unit_short"): 1, ("not null", "_id"): 2}
    assert spark.table(t.name).count() == 2  # nothing of the bad load is visible
    checked.load(t, frame([(3, "MWH", "Megawatt hour", "energy")]), "c")
    assert sorted(r._id for r in spark.table(t.name).collect()) == [1, 2, 3]
    got = {(r.load, r.check, r.column): (r.violations, r.accepted) for r in spark.table(t.verdicts).collect()}
    assert got[("b", "not null", "_id")] == (2, False) and got[("c", "key", "_id")] == (0, True)
    assert {k[0] for k, v in got.items() if v[1]} == {"a", "c"}


def test_load_is_scanned_once(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    spark.range(1000).selectExpr("id AS _id", "'u' AS unit_short", "'l' AS unit_long", "'c' AS unit_class").write.parquet(src)
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    df = spark.read.parquet(src)
    t = checked.create_checked(spark, f"unit_{uuid.uuid4().hex[:8]}", DIM_DDL["unit_DIMEN"], ["_id"], os.path.join(tmp_dir, "t"))
    checked.load(t, df.mapInArrow(count, df.schema))
    assert reads.value == 1000 and spark.table(t.name).count() == 1000


def hours(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)


def test_gaps_against_hours(spark):
    rng = random.Random(7)
    want = [(rng.choice(["a", "b", None]), a, a + rng.randint(-3, 90)) for a in (rng.randint(0, 300) for _ in range(25))]
    have = [(rng.choice(["a", "b", None]), a, a + rng.randint(-2, 40)) for a in (rng.randint(0, 300) for _ in range(40))]
    df = lambda rows: spark.createDataFrame([(k, hours(a), hours(b)) for k, a, b in rows], "k string, start timestamp_ntz, end timestamp_ntz")
    got = sorted(((r.k or "", r.start, r.end) for r in coverage.gaps(df(want), df(have), ["k"]).collect()))
    expected = []
    for k in ("a", "b", None):
        cells = {h for x, a, b in want if x == k for h in range(a, b)} - {h for x, a, b in have if x == k for h in range(a, b)}
        for h in sorted(cells):
            if h - 1 in cells:
                expected[-1] = (k or "", expected[-1][1], hours(h + 1))
            else:
                expected.append((k or "", hours(h), hours(h + 1)))
    assert got == sorted(expected)
    assert coverage.gaps(df(want).limit(0), df(have), ["k"]).count() == 0
    assert coverage.gaps(df([("a", 0, 30)]), df([]), ["k"]).collect()[0][1:] == (hours(0), hours(30))


def test_named_files_are_pruned_before_they_are_opened(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "landed")
    docs = weather_documents(fx.weather_data(fx.read_events(spark, SF)))
    named.write_named(docs, folder)
    some = named.read_named(spark, folder, zones=["SE1", "NO2"], start="2024-01-05", end="2024-01-06", whole=False)
    want = docs.where(F.col("bzn").isin("SE1", "NO2") & F.col("window_start").between("2024-01-05", "2024-01-06"))
    assert sorted((r.bzn, r.window_start, r.body) for r in some.collect()) == sorted((r.bzn, r.window_start, r.body) for r in want.collect())
    # files of other names hold what can't be read as documents: they are never opened
    plan = some._jdf.queryExecution().executedPlan()
    some._jdf.queryExecution().toRdd().count()
    leaf = plan.collectLeaves().head()
    names = want.select("bzn", "window_start").distinct().count()
    files = sum(len([f for f in fs if f.endswith(".txt")]) for _, _, fs in os.walk(folder))
    assert names <= leaf.metrics().apply("numFiles").value() < files / 4


def test_named_files_as_the_feed_lands_them(spark, tmp_dir):
    for zone, day in (("se1", "2024-01-01"), ("dk1", "2024-01-03")):
        with open(os.path.join(tmp_dir, f"weather_{zone}_{day}_to_{day}.json"), "w") as f:
            f.write('{\n "a": 1\n}')
    with open(os.path.join(tmp_dir, "notes.json"), "w") as f:
        f.write("something else")
    got = {r.bzn: (r.window_start, r.body) for r in named.read_named(spark, tmp_dir).collect()}
    assert got == {"SE1": ("2024-01-01", '{\n "a": 1\n}'), "DK1": ("2024-01-03", '{\n "a": 1\n}')}


def test_joins_of_marts_need_no_exchange(spark):
    tables = marts.write_marts(fx.feeds(spark, SF), f"mart_{uuid.uuid4().hex[:8]}", buckets=4)
    fact = marts.fact_from_marts(spark, tables)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 3 and "Exchange" not in plan
    from voltlake.plans.catalogue import measurements_fact
    full = measurements_fact(spark, SF)
    assert fact.exceptAll(full).count() == 0 and fact.count() == full.count()
