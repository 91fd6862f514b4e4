"""Documents to lake to star, deliveries, staging, strict readers, and the plans of the fact and its reports."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from voltlake.plans import fact as fact_plan
from voltlake.plans import reports, sql_reports
from voltlake.sources import breakdown, lake, landing
from voltlake.sources import fixtures as fx
from voltlake.sources.market_xml import document_order, parse_generation, parse_price, read_documents
from voltlake.sources.weather_json import missing_zones, parse_weather, quarantine
from voltlake.sources.zones import read_zones, zone_rows

SF = "/root/testdata/sf0.001"
STAR = ["unit_DIMEN", "weather_condition_DIMEN", "energy_type_DIMEN", "bidding_zone_DIMEN", "timestamp_DIMEN", "measurements_FACT"]


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


# --- documents -> lake -> star ----------------------------------------------------

def test_star_from_documents(spark):
    from voltlake.plans.feeds import feeds_from_documents
    from voltlake.plans.star import build_star
    for t in STAR:
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    added = build_star(spark, feeds_from_documents(spark, SF))
    assert added["unit_DIMEN"] == 14 and added["energy_type_DIMEN"] == 5
    adapter = fx.feeds(spark, SF)
    want = fact_plan.build_fact(adapter["consumption"], adapter["production"], adapter["price"], adapter["weather"])
    assert added["measurements_FACT"] == want.count()


def test_parsed_feeds_fit_the_lake(spark):
    ev = fx.read_events(spark, SF)
    parsed = parse_generation(landing.generation_documents(ev))
    assert dict(parsed.dtypes)["ingest_order"] == "bigint"
    spark.sql("DROP TABLE IF EXISTS lake_parsed")
    lake.append_lake(parsed, "lake_parsed", lake.PRODUCTION_SCHEMA)
    lake.append_lake(parsed, "lake_parsed")
    t = spark.table("lake_parsed")
    assert t.count() == 2 * parsed.count() and t.where("ingest_order IS NULL").count() == 0
    plan = t.where("day = DATE '2024-01-05'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    # every point has an order key of its own
    assert parsed.select("ingest_order").distinct().count() == parsed.count()


def test_order_key_is_checked(spark):
    one = spark.range(1).select(document_order(F.lit(3).cast("long"), F.lit(5)).alias("o")).first().o
    assert one == 3 * (1 << 20) + 5
    for seq, ix in ((0, 1 << 20), (1 << 43, 0), (-1, 0)):
        with pytest.raises(Exception, match="no order key"):
            spark.range(1).select(document_order(F.col("id") * 0 + F.lit(seq).cast("long"), F.lit(ix))).collect()


def test_landed_files_are_numbered_by_arrival(spark, tmp_dir):
    doc = ("<Publication_MarketDocument><TimeSeries><currency_Unit.name>EUR</currency_Unit.name><out_Domain.mRID>Z</out_Domain.mRID>"
           "<Period><timeInterval><start>2024-01-01T00:00Z</start></timeInterval><resolution>PT60M</resolution>"
           "<Point><position>1</position><price.amount>{}</price.amount></Point></Period></TimeSeries></Publication_MarketDocument>")
    for n, name in enumerate(("b.xml", "a.xml", "c.xml")):
        path = os.path.join(tmp_dir, name)
        with open(path, "w") as f:
            f.write(doc.format(n))
        os.utime(path, (1_700_000_000 + n * 100_000, 1_700_000_000 + n * 100_000))
    docs = read_documents(spark, tmp_dir)
    assert [os.path.basename(r.file_path) for r in docs.orderBy("doc_seq").collect()] == ["b.xml", "a.xml", "c.xml"]
    from voltlake.operators.dedupe import keep_first
    first = keep_first(parse_price(docs).drop("position"), ["eic_code", "datetime"]).collect()
    assert [r.price for r in first] == [0.0]  # the first delivery wins


# --- deliveries, staging, tables by day -----------------------------------------------

def test_newest_delivery_is_whole(spark, tmp_dir):
    import time
    spark.range(7).write.parquet(os.path.join(tmp_dir, "run1"))
    time.sleep(1.1)
    spark.range(300_000).repartition(6).write.parquet(os.path.join(tmp_dir, "run2"))
    assert lake.read_latest_parquet(spark, tmp_dir).count() == 300_000
    time.sleep(1.1)
    spark.range(11).repartition(3).write.mode("append").parquet(os.path.join(tmp_dir, "run1"))  # beside the oldest one
    assert lake.read_latest_parquet(spark, tmp_dir).count() == 11


def test_staging_loses_nothing(spark, tmp_dir):
    rows = [(1, "", dt.datetime(2024, 1, 1, 0, 0, 0, 123456), 0.1), (2, None, None, None), (3, ' a "b",\n\\c ', dt.datetime(1999, 12, 31, 23, 59, 59, 999999), 1e-300)]
    df = spark.createDataFrame(rows, "i int, s string, t timestamp_ntz, d double")
    back = lake.stage(df, os.path.join(tmp_dir, "staged"))
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == rows and back.dtypes == df.dtypes


def test_second_run_rewrites_changed_days_only(spark):
    f = fx.feeds(spark, SF)
    fact = fact_plan.build_fact(f["consumption"], f["production"], f["price"], f["weather"]).cache()
    spark.sql("DROP TABLE IF EXISTS fact_days")
    lake.write_fact(fact, "fact_days")
    files = lambda: {r.f for r in spark.table("fact_days").select(F.input_file_name().alias("f")).distinct().collect()}
    before, n = files(), fact.count()
    one_day = fact.where(F.to_date("datetime") == F.lit("2024-01-10").cast("date"))
    lake.write_fact(one_day.withColumn("price", F.col("price") + 1), "fact_days")
    after = files()
    assert {f.split("/")[-2] for f in before ^ after} == {"day=2024-01-10"}
    assert spark.table("fact_days").count() == n
    plan = sql_reports.green_share(spark.table("fact_days"), "2024-01-05 10:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert not spark.catalog.listTables() or not [t for t in spark.catalog.listTables() if t.name.startswith("fact_") and t.isTemporary]
    fact.unpersist()


# --- strict readers ------------------------------------------------------------------------

def test_broken_weather_documents(spark):
    good = '{"locations": {"1,2": {"values": [{"datetime": 0, "temp": 1.5}]}}}'
    docs = spark.createDataFrame([("EE", good, 1), ("EE", good[:-9], 2), ("FR", good, 3), ("EE", None, 4), ("LV", '{"locations": {}}', 5)],
                                 "bzn string, body string, doc_seq long")
    with pytest.raises(Exception, match="broken body|unknown zone"):
        parse_weather(docs).collect()
    with pytest.raises(Exception, match="unknown zone"):
        parse_weather(docs.where("doc_seq = 3")).collect()
    assert parse_weather(docs, on_bad="skip").count() == 1
    assert {(r.doc_seq, r.reason) for r in quarantine(docs).collect()} == {
        (2, "broken body"), (3, "unknown zone"), (4, "broken body"), (5, "broken body")}


def test_zones_come_from_the_mapper(spark, tmp_dir):
    path = os.path.join(tmp_dir, "zones.csv")
    with open(path, "w") as f:
        f.write("Country,EIC,BZN,Latitude,Longitude\nFrance,10YFR-RTE------C,FR,48.85,2.35\nEstonia,10Y1001A1001A39I,EE,59.35,24.8\n")
    zones = read_zones(spark, path)
    good = '{"locations": {"1,2": {"values": [{"datetime": 0, "temp": 1.5}]}}}'
    docs = spark.createDataFrame([("FR", good, 1)], "bzn string, body string, doc_seq long")
    row = parse_weather(docs, zones=zones).first()
    assert (row.BZN, row.EIC, row.Country) == ("FR", "10YFR-RTE------C", "France")
    assert [r.bzn for r in missing_zones(docs, zones).collect()] == ["EE"]
    from voltlake.operators.manifest import request_manifest
    window = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 2))], "start_date date, end_date date")
    assert {r.bzn for r in request_manifest(window, zone_rows(zones)).collect()} == {"FR", "EE"}


def test_broken_breakdown_documents(spark):
    good = '{"zone": "EE", "history": [{"datetime": "2024-01-01T00:00:00.000Z", "powerProductionBreakdown": {"solar": 1.0}}]}'
    docs = spark.createDataFrame([(good,), (good[:-4],), (None,)], "body string")
    with pytest.raises(Exception, match="can't be read"):
        breakdown.history(docs).collect()
    assert breakdown.history(docs, on_bad="skip").count() == 1 and breakdown.quarantine(docs).count() == 2


def test_type_without_a_column_is_an_error(spark):
    p = fx.production_data(fx.read_events(spark, SF))
    with pytest.raises(Exception, match="without a column"):
        fact_plan.production_wide(p.withColumn("produced_energy_type", F.lit("Fusion"))).collect()
    odd = p.withColumn("produced_energy_type", F.when(F.col("ingest_order") % 2 == 0, "Fusion").otherwise(F.col("produced_energy_type")))
    assert fact_plan.production_wide(odd, on_unmatched="ignore").count() == fact_plan.production_wide(p).count()


# --- plans ------------------------------------------------------------------------------------

@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _fact(spark, feeds=None):
    f = feeds or fx.feeds(spark, SF)
    return fact_plan.build_fact(f["consumption"], f["production"], f["price"], f["weather"])


def test_fact_reads_each_feed_once(spark, no_broadcast):
    plan = _final_plan(_fact(spark).drop("conditions"))
    assert plan.count("FileScan") <= 4, plan
    assert plan.count("Exchange hash") <= 12, plan  # reused ones print theirs too


@pytest.mark.parametrize("report", [reports.green_share_country, reports.sampling_interval])
def test_reports_plan_the_fact_once(spark, no_broadcast, report):
    plan = report(_fact(spark))._jdf.queryExecution().optimizedPlan().toString()
    own = _fact(spark)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= own.count("Relation [")


def test_no_job_and_no_cache_while_plans_are_built(spark):
    from voltlake.plans.clean import add_bzn
    sc = spark.sparkContext
    f = fx.feeds(spark, SF)
    price, weather = f["price"], f["weather"]
    _fact(spark, f)  # reads the table's schema
    before = len(sc._jsc.getPersistentRDDs())
    sc.setJobGroup("plans", "none expected")
    add_bzn(price, weather)
    _fact(spark, f)
    assert not sc.statusTracker().getJobIdsForGroup("plans")
    sc.setJobGroup("", "")
    assert len(sc._jsc.getPersistentRDDs()) == before


def test_grid_fill_over_empty_days_and_single_rows(spark):
    from voltlake.operators.asof import ffill_grid
    at = [dt.datetime(2024, 1, 1, 23, 50), dt.datetime(2024, 1, 4, 0, 10), dt.datetime(2024, 1, 4, 0, 40), dt.datetime(2024, 1, 4, 0, 50)]
    df = spark.createDataFrame([("a", t, float(n)) for n, t in enumerate(at)] + [("b", at[0], 9.0)], "k string, datetime timestamp_ntz, v double")
    got = {}
    for r in ffill_grid(df, ["k"]).collect():
        got.setdefault(r.k, {})[r.datetime] = r.v
    slot, want = dt.datetime(2024, 1, 2), {}
    while slot <= dt.datetime(2024, 1, 4, 0, 45):
        want[slot] = max((t, float(n)) for n, t in enumerate(at) if t <= slot)[1]
        slot += dt.timedelta(minutes=15)
    assert got["a"] == want and "b" not in got


def test_documents_appended_twice_are_parsed_once(spark, monkeypatch):
    import datetime

    from voltlake.plans import lifecycle
    parsed = spark.sparkContext.accumulator(0)

    def parse(n):
        parsed.add(1)
        return float(n)

    price = spark.range(40).select(
        F.lit("zone").alias("eic_code"), F.udf(parse, "double").asNondeterministic()("id").alias("price"), F.lit("EUR").alias("currency_unit"),
        F.lit("MWH").alias("price_measure_unit"), F.lit(datetime.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("datetime"), F.col("id").alias("ingest_order"))
    monkeypatch.setattr(lifecycle, "_documents", lambda spark, sf_dir: {"price": price})
    back = lifecycle._lake(spark, SF)["price"].groupBy("ingest_order", "price").count().collect()
    assert sorted((r["ingest_order"], r["price"], r["count"]) for r in back) == [(n, float(n), 2) for n in range(40)]
    assert parsed.value == 40
