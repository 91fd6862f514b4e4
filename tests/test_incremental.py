"""The fact by change, streams with late rows."""

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from voltlake.plans import fact as fact_plan
from voltlake.plans import incremental as inc
from voltlake.sources import fixtures as fx
from voltlake.sources import lake
from voltlake.streaming import late

SF = "/root/testdata/sf0.001"


def feeds_of(events):
    return {"production": fx.production_data(events), "consumption": fx.consumption_data(events),
            "price": fx.price_data(events), "weather": fx.weather_cleaned(events)}


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fact_by_change_equals_full_build(spark):
    events = fx.read_events(spark, SF).where("user_id % 17 < 4").cache()
    store = inc.Store(f"inc_{uuid.uuid4().hex[:8]}")
    day = F.dayofmonth("ts")
    parts = [events.where((day < 9) & (F.col("event_id") % 3 > 0)), events.where(day.between(12, 14)), events.where((day == 20) & (F.col("event_id") % 2 == 0)),
             events.where((day < 9) & (F.col("event_id") % 3 == 0)), events.where(day.between(9, 11)), events.where("false")]
    so_far = None
    for p in parts:
        so_far = p if so_far is None else so_far.unionByName(p)
        changed = inc.deliver(spark, store, feeds_of(p))
        f = feeds_of(so_far)
        full = fact_plan.build_fact(f["consumption"], f["production"], f["price"], f["weather"])
        assert same(spark.table(store.fact).drop("day"), full)
    assert changed == []
    again = inc.deliver(spark, store, feeds_of(parts[1]))  # a delivery that arrives twice
    assert again and same(spark.table(store.fact).drop("day"), full)


def test_late_row_reads_and_writes_its_days_alone(spark):
    events = fx.read_events(spark, SF)
    store = inc.Store(f"inc_{uuid.uuid4().hex[:8]}")
    inc.deliver(spark, store, feeds_of(events))
    one = events.where("event_type = 'purchase'").orderBy("ts").limit(1)
    before = {r.f: r.t for r in spark.table(store.fact).select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_modification_time").alias("t")).distinct().collect()}
    feeds = feeds_of(one)
    changed = inc.deliver(spark, store, {"price": feeds["price"]})
    every = spark.table(store.fact).select("day").distinct().count()
    assert 0 < len(changed) < every / 2
    after = {r.f: r.t for r in spark.table(store.fact).select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_modification_time").alias("t")).distinct().collect()}
    kept = {f for f in before if not any(f"day={d}" in f for d in changed)}
    assert kept and all(after.get(f) == before[f] for f in kept)
    plan = inc.fact_of_days(spark, store, changed, changed)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("PartitionFilters: [day#" in line or "PartitionFilters: [isnotnull(day" in line for line in scans)


def price_rows(spark, rows):
    return spark.createDataFrame([(z, p, "EUR", "MWH", at, i) for z, p, at, i in rows], lake.PRICE_SCHEMA)


def run(spark, folder, table, ckpt, **options):
    q = late.ingest_late(spark, folder, lake.PRICE_SCHEMA, table, ["eic_code"], checkpoint=ckpt, delay="1 day", **options)
    q.awaitTermination(120)
    return q


def test_late_rows_are_kept_and_state_is_bounded(spark, tmp_dir):
    folder, ckpt, table = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "ckpt"), f"late_{uuid.uuid4().hex[:8]}"
    start = dt.datetime(2024, 1, 1)
    hour = lambda h: start + dt.timedelta(hours=h)
    price_rows(spark, [("Z", float(h), hour(h), h) for h in range(0, 24 * 30, 2)]).coalesce(1).write.parquet(f"{folder}/a")
    run(spark, folder, table, ckpt)
    # three weeks late and new; three weeks late and known; on time and known; on time and new, delivered twice
    price_rows(spark, [("Z", -1.0, hour(24 * 8 + 1), 1000), ("Z", -2.0, hour(24 * 8), 1001), ("Z", -3.0, hour(24 * 30 - 2), 1002),
                       ("Z", 7.5, hour(24 * 30), 1003), ("Z", -4.0, hour(24 * 30), 1004), ("Z", 8.0, hour(24 * 8 + 1), 1005)]).coalesce(1).write.parquet(f"{folder}/b")
    run(spark, folder, table, ckpt)
    got = {r.datetime: r.price for r in spark.table(table).collect()}
    assert spark.table(table).count() == len(got) == 24 * 15 + 2
    assert got[hour(24 * 8 + 1)] == -1.0 and got[hour(24 * 8)] == 24.0 * 8 and got[hour(24 * 30 - 2)] == 24.0 * 30 - 2 and got[hour(24 * 30)] == 7.5
    for week in range(1, 5):  # the state holds the last day, however long the stream runs
        price_rows(spark, [("Z", 1.0, hour(24 * (30 + 7 * week) + h), 2000 + 100 * week + h) for h in range(24)]).coalesce(1).write.parquet(f"{folder}/w{week}")
        run(spark, folder, table, ckpt)
    state = spark.read.format("statestore").load(ckpt)
    held = state.select(F.sum(F.size("value.groupState.times"))).first()[0]
    assert state.count() <= late.BUCKETS and held <= 24 * 7
    assert spark.table(table).count() == 24 * 15 + 2 + 24 * 4


def test_batch_written_twice(spark, tmp_dir):
    table = f"late_{uuid.uuid4().hex[:8]}"
    late.create_table(spark, table, lake.PRICE_SCHEMA)
    at = dt.datetime(2024, 1, 1, 5)
    rows = price_rows(spark, [("Z", 1.0, at, 1), ("Z", 2.0, at + dt.timedelta(hours=1), 2)]).withColumn("_late", F.col("price") == 2.0)
    for _ in range(2):
        late.write_batch(rows, 3, table, ["eic_code"], "datetime")
    assert spark.table(table).count() == 2
    late.write_batch(rows.withColumn("_late", F.lit(True)), 4, table, ["eic_code"], "datetime")
    assert spark.table(table).count() == 2
