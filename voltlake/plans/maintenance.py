"""Registered queries of tables that are kept up to date: widening appends,
numbering and filling over ranges, the fact by change, streams with late rows,
checked loads, gaps in what was delivered, documents by name, bucketed marts,
partial sums for the dashboard, map features.
All start from ``events``; what they write lies under the shared checkpoint
folder or in the warehouse.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from voltlake.constants import BZN_TO_COUNTRY, ZONES
from voltlake.operators import coverage, ranges
from voltlake.operators.manifest import data_run_window, request_manifest
from voltlake.plans import fact as fact_plan
from voltlake.plans import incremental, marts, partials, reports
from voltlake.plans.catalogue import DECIMALS, measurements_fact, register
from voltlake.plans.clean import clean_weather
from voltlake.plans.lifecycle import _table, scratch
from voltlake.sources import checked, geojson, lake, landing, named
from voltlake.sources import fixtures as fx
from voltlake.sources.weather_json import parse_weather
from voltlake.streaming.late import ingest_late


@register("weather_appended_widening")
def q_widening(spark, sf_dir):
    """Whole numbers first, then decimals, then texts beside a new column."""
    e = fx.read_events(spark, sf_dir).withColumn("datetime", F.col("ts").cast("timestamp_ntz"))
    table, place = _table("lake_widening"), scratch(spark, "lake-widening")
    humidity, wind, third = F.col("value"), F.col("value") / 4, F.col("event_id") % 3
    for rows in (e.where(third == 0).select("event_id", "datetime", humidity.cast("int").alias("humidity"), wind.cast("long").alias("wind")),
                 e.where(third == 1).select("event_id", "datetime", humidity.alias("humidity"), wind.cast("int").alias("wind")),
                 e.where(third == 2).select("event_id", "datetime", humidity.cast("int").alias("humidity"),
                                            F.col("event_type").alias("wind"), F.concat(F.lit("st_"), "user_id").alias("station"))):
        lake.append_lake(rows, table, location=place)
    return spark.table(table).drop("day")


@register("user_event_ids")
def q_user_event_ids(spark, sf_dir):
    """A10/W6 without a bucket: dense ids over every distinct user and time."""
    scratch(spark, "ids")  # names the checkpoint folder where a local session has none
    pairs = fx.read_events(spark, sf_dir).select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts")).distinct()
    return ranges.dense_ids(pairs, ["user_id", "ts"])


@register("price_filled_long")
def q_price_filled(spark, sf_dir):
    """W4 over each zone's whole series of events: the last price and its unit at every event."""
    scratch(spark, "fill")
    e = fx.read_events(spark, sf_dir)
    points = fx.landed_points(e).select("eic_code", F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("ingest_order").alias("event_id"),
                                        F.when(F.col("event_type") == "purchase", F.col("value")).alias("price"),
                                        F.when(F.col("event_type") == "signup", F.col("event_type")).alias("mark"))
    return ranges.fill_forward(points, ["price", "mark"], ["eic_code"], ["ts", "event_id"])


def _by_change(spark, sf_dir) -> incremental.Store:
    e = fx.read_events(spark, sf_dir)
    late, first = (F.col("event_id") % 97 == 0) & (F.col("user_id") % 17 == 3), F.dayofmonth("ts") <= 15
    store = incremental.Store(_table("by_change"))
    for part in (e.where(first & ~late), e.where(~first & ~late), e.where(late)):
        changed = incremental.deliver(spark, store, {"production": fx.production_data(part), "consumption": fx.consumption_data(part),
                                                     "price": fx.price_data(part), "weather": fx.weather_cleaned(part)})
        partials.refresh(spark, store.fact, partials.table_of(store.fact), changed)
    return store


@register("green_share_from_partials")
def q_share_partials(spark, sf_dir):
    """B6 from the sums of zone and hour that were kept up to date by change."""
    return partials.green_share(spark.table(partials.table_of(_by_change(spark, sf_dir).fact)), decimals=DECIMALS)


@register("green_share_country_from_partials")
def q_country_partials(spark, sf_dir):
    """B7 from the same sums."""
    return partials.green_share_country(spark.table(partials.table_of(_by_change(spark, sf_dir).fact)), decimals=DECIMALS)


@register("map_features")
def q_map_features(spark, sf_dir):
    """Feature documents of the nations (a box each, some with a hole, some in two parts, some left open), read back,
    with each country's hours on the map."""
    box = lambda x, y: [(x, y), (x + 4, y), (x + 4, y + 2), (x, y + 2)]
    k = F.col("n_nationkey")
    x, y = (k * 7 - 90).cast("double"), (k * 3 - 30).cast("double")
    text = lambda corners: F.concat(F.lit("["), F.concat_ws(",", *[F.format_string("[%s,%s]", a, b) for a, b in corners]))
    shut = lambda a, b, open_=F.lit(False): F.when(open_, F.lit("]")).otherwise(F.format_string(",[%s,%s]]", a, b))
    ring = F.concat(text(box(x, y)), shut(x, y, k % 6 == 5))
    hole = F.when(k % 3 == 0, F.concat(F.lit(","), text([(x + 1, y + 0.5), (x + 2, y + 0.5), (x + 2, y + 1)]), shut(x + 1, y + 0.5))).otherwise("")
    polygon = F.concat(F.lit("["), ring, hole, F.lit("]"))
    second = F.concat(F.lit("["), text(box(x + 5, y)), shut(x + 5, y), F.lit("]"))
    geometry = F.when(k % 4 == 1, F.concat(F.lit('{"type":"MultiPolygon","coordinates":['), polygon, F.lit(","), second, F.lit("]}"))) \
        .otherwise(F.concat(F.lit('{"type":"Polygon","coordinates":'), polygon, F.lit("}")))
    names = list(dict.fromkeys(c for _, c in BZN_TO_COUNTRY))
    name = F.coalesce(F.get(F.array(*[F.lit(n) for n in names]), k), F.col("n_name"))
    feature = F.concat(F.lit('{"type":"Feature","properties":{"name":"'), name, F.lit('"},"geometry":'), geometry, F.lit("}"))
    docs = fx.read_table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.concat_ws(",", F.sort_array(F.collect_list(feature))).alias("f")) \
        .select(F.concat(F.lit('{"type":"FeatureCollection","features":['), "f", F.lit("]}")).alias("value"))
    folder = scratch(spark, "features")
    docs.write.text(folder)
    found = geojson.shapes(geojson.features_of(spark.read.text(folder), "value"))
    hours = reports.green_share_country(measurements_fact(spark, sf_dir), decimals=DECIMALS) \
        .groupBy("country").agg(F.count("*").alias("n_hours"), F.max("green_proportion").alias("most_green"))
    return found.join(hours, found["name"] == hours["country"], "left").select(
        "name", "kind", "n_polygons", "n_rings", "n_positions", "closed", "west", "south", "east", "north", "area",
        F.coalesce("n_hours", F.lit(0)).alias("n_hours"), F.coalesce("most_green", F.lit(0.0)).alias("most_green"))


@register("fact_updated_by_change")
def q_fact_by_change(spark, sf_dir):
    """The fact after three deliveries: the first half of the month, the second, and late rows of one zone."""
    return spark.table(_by_change(spark, sf_dir).fact).drop("day")


@register("stream_late_price")
def q_stream_late(spark, sf_dir):
    """ST2 with event-time state: the first half of the month, the second, and then rows of any age, some of them weeks late."""
    price = fx.price_data(fx.read_events(spark, sf_dir))
    late, first = F.col("ingest_order") % 5 == 0, F.dayofmonth("datetime") <= 15
    folder, table, ckpt, place = scratch(spark, "landing"), _table("stream_late"), scratch(spark, "stream-checkpoint"), scratch(spark, "stream")
    for i, part in enumerate((price.where(first & ~late), price.where(~first & ~late), price.where(late))):
        lake.conform(part, lake.PRICE_SCHEMA).write.parquet(f"{folder}/run{i}")
        ingest_late(spark, folder, lake.PRICE_SCHEMA, table, ["eic_code"], checkpoint=ckpt, location=place).awaitTermination()
    return spark.table(table).select("eic_code", "datetime", "price", "currency_unit", "price_measure_unit")


def _loads(spark, sf_dir) -> checked.CheckedTable:
    """S24 with enforced keys: a load of the first half of the month, a bad one (rows as they came, every seventh without a zone),
    the second half, and the first once more."""
    e = fx.read_events(spark, sf_dir)
    first = F.dayofmonth("datetime") <= 15
    raw = fx.consumption_data(e)
    good = fact_plan.consumption_keyed(raw).select("eic_code", "datetime", F.col("consumption_quantity").alias("quantity"))
    bad = raw.select(F.when(F.col("ingest_order") % 7 != 0, F.col("eic_code")).alias("eic_code"), "datetime", "quantity").where(first)
    t = checked.create_checked(spark, _table("checked_load"), "eic_code STRING NOT NULL, datetime TIMESTAMP_NTZ NOT NULL, quantity DOUBLE",
                               ["eic_code", "datetime"], scratch(spark, "checked"))
    for name, rows in (("1", good.where(first)), ("2", bad), ("3", good.where(~first)), ("4", good.where(first))):
        with contextlib.suppress(checked.Refused):
            checked.load(t, rows, name)
    return t


@register("checked_load_verdicts")
def q_verdicts(spark, sf_dir):
    """Q1-Q3 at write: what each load broke."""
    return spark.table(_loads(spark, sf_dir).verdicts).select("load", "check", "column", "violations", F.col("accepted").cast("int").alias("accepted"))


@register("checked_load_rows")
def q_checked_rows(spark, sf_dir):
    """The rows of accepted loads alone."""
    return spark.table(_loads(spark, sf_dir).name)


@register("price_request_gaps")
def q_request_gaps(spark, sf_dir):
    """What is missing of the weekly price requests, where some documents never came, some were refused and some hold half a day."""
    e = fx.read_events(spark, sf_dir)
    stamp = lambda c: F.to_timestamp_ntz(c, F.lit("yyyyMMddHHmm"))
    requested = request_manifest(data_run_window(e), days=7).where("feed = 'price'") \
        .select(F.col("zone_value").alias("eic_code"), stamp(F.col("period_start")).alias("start"), stamp(F.col("period_end")).alias("end"))
    day = F.dayofmonth("period_start")
    docs = landing.price_documents(e).withColumn("status", F.when(day % 7 == 2, 503).otherwise(200)).where(day % 5 != 1)
    half = F.when(day % 3 == 0, F.expr("INTERVAL 12 HOURS")).otherwise(F.expr("INTERVAL 24 HOURS"))
    landed = docs.where("status = 200").select("eic_code", F.col("period_start").alias("start"), (F.col("period_start") + half).alias("end"))
    return coverage.gaps(requested, landed, ["eic_code"])


@register("weather_from_named_files")
def q_named(spark, sf_dir):
    """The northern zones' documents of one week, chosen by file names."""
    folder = scratch(spark, "named")
    named.write_named(landing.weather_documents(fx.weather_data(fx.read_events(spark, sf_dir))), folder)
    north = [z[2] for z in ZONES if z[2].startswith(("NO", "SE"))]
    docs = named.read_named(spark, folder, zones=north, start="2024-01-08", end="2024-01-14", whole=False)
    return clean_weather(parse_weather(docs)).drop("ingest_order")


@register("fact_from_bucketed_marts")
def q_fact_bucketed(spark, sf_dir):
    """The fact from marts bucketed by the joins' keys."""
    f = fx.feeds(spark, sf_dir)
    return marts.fact_from_marts(spark, marts.write_marts(f, _table("mart"), location=scratch(spark, "marts")))
