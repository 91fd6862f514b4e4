"""Incremental ingest (ST1/ST2), dashboard parameters (B3-B8), features."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from voltlake.sources import fixtures as fx
from voltlake.sources import lake
from voltlake.streaming.ingest import ingest_stream

SF = "/root/testdata/sf0.001"


def test_ingest_each_file_once(spark, tmp_dir):
    src = os.path.join(tmp_dir, "landing")
    price = fx.price_data(fx.read_events(spark, SF))
    price.filter("ingest_order % 2 = 0").coalesce(1).write.parquet(os.path.join(src, "run1"))
    spark.sql("DROP TABLE IF EXISTS stream_price")
    ckpt = os.path.join(tmp_dir, "ckpt")
    q = ingest_stream(spark, src, lake.PRICE_SCHEMA, "stream_price", checkpoint=ckpt)
    q.awaitTermination(120)
    n1 = spark.table("stream_price").count()
    assert n1 == price.filter("ingest_order % 2 = 0").count()
    # a second run with no new file adds nothing; a new file is read once
    ingest_stream(spark, src, lake.PRICE_SCHEMA, "stream_price", checkpoint=ckpt).awaitTermination(120)
    assert spark.table("stream_price").count() == n1
    price.filter("ingest_order % 2 = 1").coalesce(1).write.parquet(os.path.join(src, "run2"))
    ingest_stream(spark, src, lake.PRICE_SCHEMA, "stream_price", checkpoint=ckpt).awaitTermination(120)
    assert spark.table("stream_price").count() == price.count()


def test_ingest_drops_repeated_deliveries(spark, tmp_dir):
    src = os.path.join(tmp_dir, "landing")
    rows = [("Z", 1.0, "EUR", "MWH", dt.datetime(2024, 1, 1, 1), 1),
            ("Z", 2.0, "EUR", "MWH", dt.datetime(2024, 1, 1, 2), 2)]
    df = spark.createDataFrame(rows, lake.PRICE_SCHEMA)
    df.coalesce(1).write.parquet(os.path.join(src, "a"))
    spark.sql("DROP TABLE IF EXISTS stream_price_dedup")
    ckpt = os.path.join(tmp_dir, "ckpt")
    ingest_stream(spark, src, lake.PRICE_SCHEMA, "stream_price_dedup", dedupe_keys=["eic_code"],
                  checkpoint=ckpt).awaitTermination(120)
    # the same point delivered again (a revision) is dropped: first delivery wins
    again = spark.createDataFrame([("Z", 9.0, "EUR", "MWH", dt.datetime(2024, 1, 1, 1), 3)], lake.PRICE_SCHEMA)
    again.coalesce(1).write.parquet(os.path.join(src, "b"))
    ingest_stream(spark, src, lake.PRICE_SCHEMA, "stream_price_dedup", dedupe_keys=["eic_code"],
                  checkpoint=ckpt).awaitTermination(120)
    got = sorted((r.datetime.hour, r.price) for r in spark.table("stream_price_dedup").collect())
    assert got == [(1, 1.0), (2, 2.0)]


def _fact(spark):
    from voltlake.plans.catalogue import measurements_fact
    return measurements_fact(spark, SF)


def test_dashboard_parameters(spark):
    from voltlake.plans import reports
    fact = _fact(spark).cache()
    zones = [r.bzn for r in reports.zone_list(fact).collect()]
    assert zones == sorted(zones)
    z = zones[0]
    hours = [r.hourly_datetime for r in reports.available_hours(fact).collect()]
    assert hours == sorted(hours)
    s = reports.zone_series(fact, z, hours[0], hours[-1] + dt.timedelta(minutes=45))
    allz = reports.zone_series(fact, order=False).filter(F.col("bzn") == z)
    assert s.count() == allz.count()
    assert "bzn" not in s.columns and s.filter("consumption_quantity <= 0").count() == 0
    one = reports.green_share(fact, hour=hours[3]).collect()
    full = reports.green_share(fact).filter(F.col("hourly_datetime") == F.lit(hours[3])).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, full))
    ov = reports.overlay(fact, z, ["Temperature", "price"])
    assert {r.measure for r in ov.collect()} == {"Temperature", "Price"}
    assert {r.unit for r in ov.collect()} == {"°C", "EUR/MWH"}
    gs = reports.green_series(fact, z).first()
    assert gs.green_energy == sum(gs[c] or 0 for c in [
        "production_quantity_solar", "production_quantity_wind_onshore",
        "production_quantity_hydro_run_of_river_and_poundage"] if c in gs.asDict())
    parity = reports.green_series(fact, z, parity=True).first()
    assert parity.green_energy == gs.green_energy - (gs.production_quantity_hydro_run_of_river_and_poundage or 0)
    si = {r.bzn: r for r in reports.sampling_interval(fact).collect()}
    assert all(r.interval_hours is None or r.interval_hours > 0 for r in si.values())
    fact.unpersist()


def test_sampling_interval_single_row(spark):
    from voltlake.plans import reports
    fact = _fact(spark)
    z = fact.select("bzn").first().bzn
    first = fact.filter((F.col("bzn") == z) & (F.col("consumption_quantity") > 0)).agg(F.min("datetime")).first()[0]
    r = reports.sampling_interval(fact, z, first, first).first()
    assert r.first_datetime == first and r.interval_hours is None and r.quarter_hourly is None


def test_country_map_and_features(spark, tmp_dir):
    from voltlake.plans import reports
    from voltlake.sources.geojson import attach_features, map_countries, read_features
    fact = _fact(spark)
    hour = reports.available_hours(fact).first().hourly_datetime
    avg = reports.green_share_country(fact, hour=hour).collect()
    assert len(avg) == 9 and all(0 <= r.green_proportion <= 1 for r in avg)
    fan = reports.green_share_country(fact, hour=hour, fanout=True).collect()
    assert len(fan) >= 17
    gj = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "id": "EST", "properties": {"name": "Estonia"},
         "geometry": {"type": "Polygon", "coordinates": [[[24.0, 59.0], [25.0, 59.0], [24.5, 60.0]]]}},
        {"type": "Feature", "id": "FRA", "properties": {"name": "France"},
         "geometry": {"type": "Polygon", "coordinates": [[[2.0, 46.0], [3.0, 46.0], [2.5, 47.0]]]}}]}
    p = os.path.join(tmp_dir, "countries.geo.json")
    with open(p, "w") as fh:
        json.dump(gj, fh)
    feats = map_countries(read_features(spark, p))
    assert [r.name for r in feats.collect()] == ["Estonia"]
    country = spark.createDataFrame([(r.country, r.green_proportion) for r in avg],
                                    "country string, green_proportion double")
    j = attach_features(feats, country).collect()
    assert len(j) == 1 and j[0].name == "Estonia" and '"Polygon"' in j[0].geometry


def test_second_application_reads_only_new_files(tmp_dir):
    """Two applications share a stream root: the second one starts with a new file and loads it once."""
    import subprocess
    import sys
    src, root, wh = (os.path.join(tmp_dir, x) for x in ("landing", "root", "warehouse"))
    code = """
import sys
sys.path.insert(0, {repo!r})
import datetime as dt
from voltlake.session import build_session
from voltlake.sources import lake
from voltlake.streaming.ingest import ingest_stream
spark = build_session("local[2]", shuffle_partitions=2, extra={{"spark.sql.warehouse.dir": {wh!r}, "voltlake.stream.root": {root!r},
                      "spark.checkpoint.dir": {wh!r} + "-ckpt"}})
n = int(sys.argv[1])
rows = [("Z", float(n), "EUR", "MWH", dt.datetime(2024, 1, n, h), n * 10 + h) for h in range(n)]
spark.createDataFrame(rows, lake.PRICE_SCHEMA).coalesce(1).write.mode("append").parquet({src!r} + "/run" + str(n))
for how, keys in (("plain", None), ("merged", ["eic_code"])):
    path = {wh!r} + "/" + how
    if keys:
        spark.sql("CREATE TABLE t_" + how + " (eic_code string, price double, currency_unit string, price_measure_unit string, "
                  "datetime timestamp_ntz, ingest_order bigint, day date) USING parquet PARTITIONED BY (day) LOCATION '" + path + "'")
        spark.sql("MSCK REPAIR TABLE t_" + how) if n > 1 and spark.conf.get("spark.sql.catalogImplementation") == "hive" else None
        ingest_stream(spark, {src!r}, lake.PRICE_SCHEMA, "t_" + how, dedupe_keys=keys).awaitTermination()
    else:
        from voltlake.streaming.ingest import read_new_files, checkpoint_location
        read_new_files(spark, {src!r}, lake.PRICE_SCHEMA).writeStream.format("parquet").option(
            "checkpointLocation", checkpoint_location(spark, "t_" + how)).trigger(availableNow=True).start(path).awaitTermination()
    print("ROWS", how, spark.read.parquet(path).count())
"""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    seen = []
    for n in (1, 2):
        out = subprocess.run([sys.executable, "-c", code.format(repo=repo, wh=wh, root=root, src=src), str(n)],
                             capture_output=True, text=True, timeout=300, check=False)
        seen.append([x for x in out.stdout.splitlines() if x.startswith("ROWS")])
        assert seen[-1], out.stderr[-2000:]
    assert seen == [["ROWS plain 1", "ROWS merged 1"], ["ROWS plain 3", "ROWS merged 3"]]


def test_stream_root_has_no_default(spark):
    import pytest

    from voltlake.streaming.ingest import checkpoint_location
    with pytest.raises(ValueError, match="shared folder"):
        checkpoint_location(spark, "x")
    assert checkpoint_location(spark, "x", "/shared/") == "/shared/streams/x"


def test_backfill_of_any_age_is_kept(spark, tmp_dir):
    src = os.path.join(tmp_dir, "landing")
    table = "stream_price_backfill"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    ckpt = os.path.join(tmp_dir, "ckpt")

    def deliver(name, rows):
        spark.createDataFrame(rows, lake.PRICE_SCHEMA).coalesce(1).write.parquet(os.path.join(src, name))
        ingest_stream(spark, src, lake.PRICE_SCHEMA, table, dedupe_keys=["eic_code"], checkpoint=ckpt).awaitTermination(120)

    deliver("late", [("Z", 1.0, "EUR", "MWH", dt.datetime(2024, 1, 31, 5), 1)])
    deliver("old", [("Z", 2.0, "EUR", "MWH", dt.datetime(2024, 1, 3, 1), 2), ("Z", 3.0, "EUR", "MWH", dt.datetime(2024, 1, 4, 1), 3),
                    ("Z", 9.0, "EUR", "MWH", dt.datetime(2024, 1, 31, 5), 4)])
    deliver("older", [("Z", 4.0, "EUR", "MWH", dt.datetime(2024, 1, 5, 1), 5), ("Z", 8.0, "EUR", "MWH", dt.datetime(2024, 1, 5, 1), 6)])
    assert sorted(r.price for r in spark.table(table).collect()) == [1.0, 2.0, 3.0, 4.0]
