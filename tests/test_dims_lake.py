"""Dimensions (D1-D5, J4, A10), lake lifecycle (S1-S26) and the star build."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from voltlake.constants import ZONES
from voltlake.operators.checks import assert_empty, assert_no_nulls, duplicate_keys
from voltlake.plans import dims
from voltlake.sources import lake
from voltlake.sources.zones import coordinates, read_run_window, read_zones

SF = "/root/testdata/sf0.001"


def test_calendar_invariants(spark):
    bounds = dims.calendar_bounds(spark, "2024-12-01 00:00:00", "2024-12-31 23:59:00")
    cal = dims.build_timestamp_dim(bounds)
    agg = cal.agg(F.count(F.lit(1)).alias("n"), F.sum("weekend").alias("we"), F.sum("holiday").alias("ho"),
                  F.sum("workingday").alias("wd"), F.min("_id").alias("lo"), F.max("_id").alias("hi"),
                  F.countDistinct("_id").alias("d")).first()
    assert (agg.n, agg.we, agg.ho, agg.wd) == (2976, 864, 288, 1824)
    assert (agg.lo, agg.hi, agg.d) == (1, 2976, 2976)
    first = cal.filter("_id = 1").first()
    assert first.datetime == dt.datetime(2024, 12, 1) and first.weekday == "Sunday" and first.weekend == 1
    # ids follow time order
    from pyspark.sql import Window
    ranked = cal.withColumn("_rn", F.row_number().over(Window.orderBy("datetime")))
    assert ranked.filter(F.col("_id") != F.col("_rn")).count() == 0
    # rebuild against itself adds nothing; partial existing continues the ids
    assert dims.build_timestamp_dim(bounds, existing=cal).count() == 0
    part = cal.filter(F.col("datetime") < F.lit("2024-12-10").cast("timestamp_ntz"))
    rest = dims.build_timestamp_dim(bounds, existing=part)
    assert rest.agg(F.min("_id")).first()[0] == part.count() + 1


def _feeds(spark):
    from voltlake.sources import fixtures as fx
    return fx.feeds(spark, SF)


def test_unit_dim_order_and_rebuild(spark):
    f = _feeds(spark)
    u = dims.build_unit_dim(f["consumption"], f["price"], f["production"])
    rows = [tuple(r) for r in u.orderBy("_id").collect()]
    assert [r[1] for r in rows] == ["MAW", "EUR", "MWH", "%", "°C", "mm", "cm", "km", "kph", "m/s",
                                    "mb", "mmHg", "W/m²", "J/m²"]
    assert rows[0] == (1, "MAW", "Mega Active Wat", "electricity")
    again = dims.build_unit_dim(f["consumption"], f["price"], f["production"], existing=u)
    assert again.count() == 0


def test_condition_dim_collisions(spark):
    rows = [("Heavy Rain And Snow", 1), ("Clear, Unknown thing", 2), ("Snow", 3), (None, 4), ("Odd", 5)]
    w = spark.createDataFrame(rows, "conditions string, ingest_order long")
    d = dims.build_condition_dim(w, headers=["temperature", "snowdepth"])
    got = [(r.condition_short, r.condition_long) for r in d.orderBy("_id").collect()]
    # "Clear" shares "clr" with the first-seen "Heavy Rain And Snow"; "Unknown thing" and "Odd" share ''
    assert got == [("clr", "Heavy Rain And Snow"), ("", ""), ("snow", "Snow"),
                   ("temp", "temperature"), ("snowdepth", "snow depth")]


def test_energy_and_zone_dims(spark):
    f = _feeds(spark)
    e = dims.build_energy_dim(f["production"])
    types = {r.energy_type_x: (r.energy_type_class, r.renewable, r.carbon) for r in e.collect()}
    assert types["Solar"] == ("green", 1, 0) and types["Fossil Gas"] == ("fossil", 0, 1)
    assert types["Nuclear"] == ("other", 0, 0)
    z = dims.build_zone_dim(spark)
    zr = {r.bzn: r for r in z.collect()}
    assert len(zr) == 17 and zr["PL"].data_resolution == 15 and zr["NO1"].data_resolution == 60
    assert zr["NO1"].eu_member == 1 and zr["EE"]._id == 1 and zr["PL"]._id == 17
    assert dims.build_zone_dim(spark, existing=z).count() == 0
    assert_empty(duplicate_keys(z, ["_id"]), "zone ids")
    assert_no_nulls(z, ["_id", "bzn", "country"], "zone dim")


def test_read_zones_and_run_window(spark, tmp_dir):
    p = os.path.join(tmp_dir, "zones.csv")
    with open(p, "w") as fh:
        fh.write("Country,EIC,BZN,Latitude,Longitude\n")
        for country, eic, bzn, lat, lon in ZONES:  # the mapper file has a TAB after the Polish code
            fh.write(f'{country},"{eic}\t",{bzn},{lat},{lon}\n' if bzn == "PL" else f"{country},{eic},{bzn},{lat},{lon}\n")
        fh.write(",,XX,1.0,2.0\n")
    z = read_zones(spark, p)
    rows = {r.bzn: r for r in z.collect()}
    assert len(rows) == 17 and rows["PL"].eic_code == "10YPL-AREA-----S"
    assert rows["PL"].eic_raw.endswith("\t")
    coords = {r.bzn: r.coordinates for r in coordinates(z).collect()}
    assert coords["EE"] == "59.35,24.8"
    j = os.path.join(tmp_dir, "dates.json")
    with open(j, "w") as fh:
        fh.write('{\n  "start_date": "2024-12-05",\n  "end_date": "2024-12-06"\n}')
    w = read_run_window(spark, j).first()
    assert (w.start_date, w.end_date) == (dt.date(2024, 12, 5), dt.date(2024, 12, 6))


def test_request_manifest_shipped_window(spark):
    from voltlake.operators.manifest import request_manifest
    run = spark.createDataFrame([(dt.date(2024, 12, 5), dt.date(2024, 12, 6))], "start_date date, end_date date")
    m = request_manifest(run).cache()
    assert m.count() == 17 * 4
    prod = m.filter("feed = 'production' AND bzn = 'EE'").first()
    assert (prod.period_start, prod.period_end) == ("202412050000", "202412070000")
    price = m.filter("feed = 'price' AND bzn = 'EE'").first()
    assert (price.period_start, price.period_end) == ("202412050000", "202412060000")
    w = m.filter("feed = 'weather' AND bzn = 'PL'").first()
    assert (w.zone_value, w.period_start, w.period_end) == ("52.24,20.97", "2024-12-05T00:00:00",
                                                             "2024-12-06T23:59:59")
    long = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 3, 15))], "start_date date, end_date date")
    lm = request_manifest(long)
    starts = sorted({r.period_start for r in lm.filter("feed = 'production' AND bzn = 'EE'").collect()})
    assert starts == ["202401010000", "202402010000", "202403030000"]
    wl = lm.filter("feed = 'weather' AND bzn = 'EE'").first()
    assert wl.period_start == "2024-03-13T00:00:00"          # clamped to 48 h (F10)
    m.unpersist()


def test_lake_lifecycle(spark, tmp_dir):
    f = _feeds(spark)
    spark.sql("DROP TABLE IF EXISTS lake_production")
    lake.append_lake(f["production"], "lake_production", lake.PRODUCTION_SCHEMA)
    lake.append_lake(f["production"].withColumn("extra", F.lit("x")), "lake_production")
    t = spark.table("lake_production")
    assert "extra" in t.columns and t.count() == 2 * f["production"].count()
    assert t.filter("extra IS NULL").count() == f["production"].count()
    # supported types
    odd = spark.range(2).select(F.col("id").cast("int").alias("i"), F.lit(1.5).cast("float").alias("fl"),
                                F.array(F.lit(1)).alias("arr"), F.lit(True).alias("b"))
    s = lake.supported_columns(odd)
    assert s.columns == ["i", "fl"] and dict(s.dtypes) == {"i": "bigint", "fl": "double"}
    # staging round trip
    st = lake.stage(f["price"], os.path.join(tmp_dir, "stage"))
    assert st.count() == f["price"].count() and st.dtypes == f["price"].dtypes
    assert lake.drop_matching(spark.range(1).select(F.lit(1).alias("Unnamed: 0"), "id")).columns == ["id"]
    # newest file only
    d = os.path.join(tmp_dir, "landing")
    f["price"].limit(5).coalesce(1).write.parquet(os.path.join(d, "a"))
    import time
    time.sleep(1.1)
    f["price"].limit(3).coalesce(1).write.parquet(os.path.join(d, "b"))
    assert lake.read_latest_parquet(spark, d).count() == 3
    with pytest.raises(Exception):
        lake.require_input(spark, os.path.join(tmp_dir, "nothing"))
    # create-like + positional append + combine + refresh
    spark.sql("DROP TABLE IF EXISTS mart_price")
    lake.append_mart("mart_price", f["price"])
    lake.append_mart("mart_price", f["price"])
    assert spark.table("mart_price").count() == 2 * f["price"].count()
    spark.sql("DROP TABLE IF EXISTS mart_all_price")
    assert lake.combine_marts(spark, {"mart_price": "mart_all_price", "no_such": "x"}) == ["mart_all_price"]
    lake.refresh(spark, "mart_price")
    assert spark.table("mart_price").count() == 0
    assert lake.columns_like(spark, "mart_all_price", "price%") == ["price", "price_measure_unit"]


def test_write_documents_partitioned(spark, tmp_dir):
    from voltlake.sources import fixtures as fx
    from voltlake.sources.landing import weather_documents
    from voltlake.sources.weather_json import parse_weather
    docs = weather_documents(fx.weather_data(fx.read_events(spark, SF))).withColumn("feed", F.lit("weather"))
    path = os.path.join(tmp_dir, "landed")
    lake.write_documents(docs, path)
    back = lake.read_landed(spark, path)
    assert set(back.columns) >= {"feed", "bzn", "window_start", "body"}
    assert parse_weather(back).count() == fx.weather_data(fx.read_events(spark, SF)).count()


def test_build_star_twice(spark):
    from voltlake.plans.star import build_star
    from voltlake.sources import fixtures as fx
    for t in ["unit_DIMEN", "weather_condition_DIMEN", "energy_type_DIMEN", "bidding_zone_DIMEN",
              "timestamp_DIMEN", "measurements_FACT"]:
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    f = fx.feeds(spark, SF)
    first = build_star(spark, f)
    assert first["timestamp_DIMEN"] == 2976 and first["bidding_zone_DIMEN"] == 17
    assert first["unit_DIMEN"] == 14
    second = build_star(spark, f)
    assert {k: v for k, v in second.items() if k != "measurements_FACT"} == \
        {k: 0 for k in second if k != "measurements_FACT"}
    assert second["measurements_FACT"] == first["measurements_FACT"]
    for t, key in [("unit_DIMEN", "_id"), ("timestamp_DIMEN", "_id"), ("weather_condition_DIMEN", "_id")]:
        assert_empty(duplicate_keys(spark.table(t), [key]), t)
    assert lake.columns_like(spark, "measurements_FACT", "production_quantity_%")[0] == \
        "production_quantity_biomass"


def test_clean_layer_tables_and_previous_day(spark):
    from voltlake.functions.timefn import previous_day_bounds
    from voltlake.plans.star import build_clean_layer
    from voltlake.sources import fixtures as fx
    f = fx.feeds(spark, SF)
    counts = build_clean_layer(spark, f)
    assert counts["price_cleaned"] == f["price"].count()
    assert spark.table("price_cleaned").filter("bzn IS NULL").count() == 0
    s, e = previous_day_bounds("2024-12-06")
    r = spark.range(1).select(s.alias("s"), e.alias("e")).first()
    assert (r.s, r.e) == (dt.datetime(2024, 12, 5), dt.datetime(2024, 12, 5, 23))


def test_fact_table_day_partitions_are_pruned(spark):
    import datetime as _dt

    from voltlake.plans import reports
    from voltlake.plans.catalogue import measurements_fact
    spark.sql("DROP TABLE IF EXISTS fact_pruned")
    fact = measurements_fact(spark, SF)
    lake.write_fact(fact, "fact_pruned")
    t = spark.table("fact_pruned")
    assert "day" in t.columns and t.count() == fact.count()
    start, end = _dt.datetime(2024, 1, 3, 0, 0), _dt.datetime(2024, 1, 4, 23, 45)
    s = reports.zone_series(t, "EE", start, end, order=False)
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "day#" in plan.split("PartitionFilters:")[1]
    assert "PushedFilters: [IsNotNull(bzn)" in plan
    base = reports.zone_series(fact, "EE", start, end, order=False)
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, base.collect()))
    h = reports.available_hours(t).collect()[7].hourly_datetime
    assert sorted(map(tuple, reports.green_share(t, hour=h).drop("hourly_datetime").collect())) == \
        sorted(map(tuple, reports.green_share(fact, hour=h).drop("hourly_datetime").collect()))
