"""Registered queries that write, read again and merge: streams, documents to
lake to star, staging, quarantine. All of them start from the ``events``
table; what they write lies under the shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.constants import ENERGY_TYPES
from voltlake.operators.checks import duplicate_keys
from voltlake.operators.dedupe import unmatched_values
from voltlake.operators.keys import insert_if_absent, sequential_ids
from voltlake.operators.manifest import data_run_window, request_manifest
from voltlake.plans import dims, reports
from voltlake.plans import fact as fact_plan
from voltlake.plans.catalogue import DECIMALS, measurements_fact, register
from voltlake.plans.clean import clean_weather
from voltlake.plans.feeds import feeds_from_documents
from voltlake.sources import breakdown, lake, landing
from voltlake.sources import fixtures as fx
from voltlake.sources.market_xml import parse_price
from voltlake.sources.weather_json import missing_zones, parse_weather, quarantine
from voltlake.streaming.ingest import ingest_stream


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder name under the shared checkpoint folder; a local session without one gets a scratch folder."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile
        root = tempfile.mkdtemp(prefix="voltlake-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def _table(what: str) -> str:
    return f"{what}_{uuid.uuid4().hex}"


# --- streams (ST1, ST2) --------------------------------------------------------------

def _streamed(spark: SparkSession, sf_dir: str, dedupe: bool) -> DataFrame:
    """The price feed in three deliveries, the latest days first, read by three runs of one stream."""
    price = fx.price_data(fx.read_events(spark, sf_dir)).withColumn("_part", F.col("ingest_order") % 3)
    folder, table = scratch(spark, "landing"), _table("stream_price")
    spark.sql(f"CREATE TABLE {table} ({', '.join(f'{f.name} {f.dataType.simpleString()}' for f in lake.PRICE_SCHEMA)}, day DATE) "
              f"USING parquet PARTITIONED BY (day) LOCATION '{scratch(spark, 'stream')}'") if dedupe else \
        spark.createDataFrame([], lake.PRICE_SCHEMA).write.format("parquet").option("path", scratch(spark, "stream")).saveAsTable(table)
    ckpt = scratch(spark, "stream-checkpoint")
    for part in (2, 0, 1):
        lake.conform(price.where(F.col("_part") == part), lake.PRICE_SCHEMA).write.parquet(f"{folder}/run{part}")
        ingest_stream(spark, folder, lake.PRICE_SCHEMA, table, dedupe_keys=["eic_code"] if dedupe else None, checkpoint=ckpt).awaitTermination()
    return spark.table(table)


@register("stream_ingest_price")
def q_stream_ingest(spark, sf_dir):
    return _streamed(spark, sf_dir, False).drop("ingest_order")


@register("stream_dedupe_price")
def q_stream_dedupe(spark, sf_dir):
    return _streamed(spark, sf_dir, True).select("eic_code", "datetime", "price", "currency_unit", "price_measure_unit")


# --- documents -> lake -> star ---------------------------------------------------------

def _documents(spark, sf_dir):
    return feeds_from_documents(spark, sf_dir)


@register("unit_dim_from_documents")
def q_unit_dim_docs(spark, sf_dir):
    f = _documents(spark, sf_dir)
    return dims.build_unit_dim(f["consumption"], f["price"], f["production"])


@register("energy_type_dim_from_documents")
def q_energy_dim_docs(spark, sf_dir):
    return dims.build_energy_dim(_documents(spark, sf_dir)["production"])


@register("condition_dim_from_documents")
def q_condition_dim_docs(spark, sf_dir):
    return dims.build_condition_dim(_documents(spark, sf_dir)["weather"])


def _lake(spark, sf_dir, twice: bool = True) -> dict[str, DataFrame]:
    """The parsed feeds appended to lake tables (twice: the second run repeats the first) and read back. What is appended
    twice is parsed once, documents are most of the work."""
    out = {}
    schemas = {"production": lake.PRODUCTION_SCHEMA, "price": lake.PRICE_SCHEMA, "consumption": lake.CONSUMPTION_SCHEMA, "weather": None}
    for name, df in _documents(spark, sf_dir).items():
        table, place = _table(f"lake_{name}"), scratch(spark, f"lake-{name}")
        if twice:
            parsed = scratch(spark, f"parsed-{name}")
            df.write.parquet(parsed)
            df = spark.read.schema(df.schema).parquet(parsed)
        for _ in range(1 + twice):
            lake.append_lake(df, table, schemas[name], location=place, ts="date_time" if name == "weather" else "datetime")
        out[name] = spark.table(table).drop("day")
    return out


@register("fact_from_lake")
def q_fact_from_lake(spark, sf_dir):
    f = _lake(spark, sf_dir)
    return fact_plan.build_fact(f["consumption"], f["production"], f["price"], f["weather"])


@register("lake_production_duplicates")
def q_lake_duplicates(spark, sf_dir):
    """Q1 on a lake table that was appended to twice: every point is there twice at least."""
    f = fx.production_data(fx.read_events(spark, sf_dir))
    table, place = _table("lake_production"), scratch(spark, "lake-production")
    for _ in range(2):
        lake.append_lake(f, table, lake.PRODUCTION_SCHEMA, location=place)
    return duplicate_keys(spark.table(table), ["eic_code", "datetime", "produced_energy_type"])


@register("mart_price_appended")
def q_mart_price(spark, sf_dir):
    """A mart created like the feed and filled by position."""
    price = fx.price_data(fx.read_events(spark, sf_dir)).drop("ingest_order")
    table = _table("mart_price")
    price.limit(0).write.format("parquet").option("path", scratch(spark, "mart")).saveAsTable(table)
    for part in (0, 1):
        lake.append_mart(table, price.where(F.pmod(F.hash("eic_code"), F.lit(2)) == part))
    return spark.table(table)


@register("fact_written_by_days")
def q_fact_written(spark, sf_dir):
    """The fact written, its first half written again, read back."""
    fact = measurements_fact(spark, sf_dir)
    table = _table("fact")
    spark.sql(f"CREATE TABLE {table} ({', '.join(f'`{n}` {t}' for n, t in fact.dtypes)}, day DATE) USING parquet "
              f"PARTITIONED BY (day) LOCATION '{scratch(spark, 'fact')}'")
    lake.write_fact(fact, table)
    middle = spark.table(table).agg(F.percentile_approx(F.unix_date("day"), 0.5)).first()[0]
    lake.write_fact(fact.where(F.unix_date(F.to_date("datetime")) <= middle), table)
    return spark.table(table).drop("day")


@register("price_staged")
def q_price_staged(spark, sf_dir):
    """Staged as text and read back, with nulls, empty texts and microseconds."""
    price = fx.read_events(spark, sf_dir).select(
        "event_id", F.when(F.col("event_id") % 3 == 0, None).when(F.col("event_id") % 3 == 1, "").otherwise(F.lit(' a "b", \n c ')).alias("note"),
        (F.col("ts") + F.expr("INTERVAL 123 MICROSECOND")).cast("timestamp_ntz").alias("ts"), "value")
    back = lake.stage(price, scratch(spark, "staged"))
    return back.groupBy("note").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.sum(F.col("value").cast("decimal(30,6)")).cast("double").alias("total"))


@register("price_latest_delivery")
def q_latest_delivery(spark, sf_dir):
    """Of two deliveries the newer one, with all its part files."""
    import time
    price = fx.price_data(fx.read_events(spark, sf_dir)).drop("ingest_order")
    folder = scratch(spark, "deliveries")
    price.limit(1).write.parquet(f"{folder}/run1")
    time.sleep(1.1)  # file times may be whole seconds
    price.repartition(6).write.mode("append").parquet(f"{folder}/run1")
    return lake.read_latest_parquet(spark, folder)


# --- quarantine and missing data -----------------------------------------------------------

def _weather_documents(spark, sf_dir) -> DataFrame:
    docs = landing.weather_documents(fx.weather_data(fx.read_events(spark, sf_dir)))
    broken = F.when(F.col("doc_seq") % 5 == 0, F.left("body", F.length("body") - 7)).otherwise(F.col("body"))
    return docs.withColumn("body", broken).withColumn("bzn", F.when(F.col("doc_seq") % 5 == 1, "FR").otherwise(F.col("bzn")))


@register("weather_quarantine")
def q_weather_quarantine(spark, sf_dir):
    """Every fifth document is cut short, every fifth from a zone that the mapper doesn't have."""
    return quarantine(_weather_documents(spark, sf_dir)).select("bzn", "window_start", "doc_seq", "reason")


@register("weather_without_quarantined")
def q_weather_rest(spark, sf_dir):
    return clean_weather(parse_weather(_weather_documents(spark, sf_dir), on_bad="skip")).drop("ingest_order")


@register("breakdown_quarantine")
def q_breakdown_quarantine(spark, sf_dir):
    f = fx.feeds(spark, sf_dir)
    docs = landing.breakdown_documents(fact_plan.production_wide(f["production"]), fact_plan.consumption_keyed(f["consumption"]))
    cut = docs.withColumn("body", F.when(F.day("day") % 2 == 0, F.left("body", F.length("body") - 3)).otherwise(F.col("body")))
    return breakdown.quarantine(cut).select("zone", "day")


@register("production_unmatched_types")
def q_unmatched(spark, sf_dir):
    """Types outside a column list that lacks the fossil ones."""
    known = [t for t in ENERGY_TYPES if not t.startswith("Fossil")]
    return unmatched_values(fx.production_data(fx.read_events(spark, sf_dir)), "produced_energy_type", known)


@register("weather_zones_without_documents")
def q_zones_without(spark, sf_dir):
    """S9 where zones really are missing: only the northern zones' documents landed."""
    docs = landing.weather_documents(fx.weather_data(fx.read_events(spark, sf_dir)))
    return missing_zones(docs.where(F.col("bzn").startswith("NO") | F.col("bzn").startswith("SE")))


@register("price_prefixed_and_rejected")
def q_price_prefixed(spark, sf_dir):
    """Documents with prefixed tags, every third with another status than 200."""
    docs = landing.price_documents(fx.read_events(spark, sf_dir))
    prefixed = F.regexp_replace(F.regexp_replace(F.col("xml"), r"<(/?)([A-Za-z])", "<$1n:$2"), "xmlns=", "xmlns:n=")
    mixed = docs.withColumn("xml", prefixed).withColumn("status", F.when(F.col("doc_seq") % 3 == 0, 503).otherwise(200))
    return parse_price(mixed, ignore_namespace=True).drop("ingest_order", "position")


@register("weather_incomplete_columns")
def q_weather_incomplete(spark, sf_dir):
    """A column with a null in a document is null in the whole document."""
    raw = fx.weather_data(fx.read_events(spark, sf_dir))
    holed = raw.withColumn("temp", F.when(F.col("ingest_order") % 50 != 0, F.col("temp")))
    return clean_weather(parse_weather(landing.weather_documents(holed))).select("eic_code", "date_time", "temperature", "dew_point")


@register("request_manifest_weekly")
def q_manifest_weekly(spark, sf_dir):
    """X6 with windows of a week: a month of events needs several."""
    return request_manifest(data_run_window(fx.read_events(spark, sf_dir)), days=7)


# --- calendar, keys and dashboard parameters ---------------------------------------------------

@register("timestamp_dim_holidays")
def q_timestamp_holidays(spark, sf_dir):
    """X9/F7 with holidays inside the data: its first and eighth day."""
    bounds = dims.data_calendar_bounds(fx.read_events(spark, sf_dir))
    first = bounds.select(F.to_date("start")).first()[0]
    days = [str(first), str(spark.range(1).select(F.date_add(F.lit(first), 7)).first()[0])]
    return dims.build_timestamp_dim(bounds, holidays=days)


@register("energy_type_dim_in_two_runs")
def q_energy_two_runs(spark, sf_dir):
    """J4 + A10: built from the feed without two of its types, then those inserted."""
    feed = fx.production_data(fx.read_events(spark, sf_dir))
    rare = feed.where(~F.col("produced_energy_type").isin("Solar", "Nuclear"))
    first = dims.build_energy_dim(rare)
    return first.unionByName(dims.build_energy_dim(feed, existing=first))


@register("zone_days_in_two_runs")
def q_zone_days(spark, sf_dir):
    """J4 + A10 over data: (zone, day) keys numbered by day, the later days inserted in a second run."""
    days = fx.consumption_data(fx.read_events(spark, sf_dir)).select("eic_code", F.to_date("datetime").alias("day")).distinct()
    early = days.where(F.day("day") <= 10)
    first = sequential_ids(early, ["day", "eic_code"], bucket=F.col("day"))
    new = insert_if_absent(days, first, ["eic_code", "day"])
    return first.unionByName(sequential_ids(new, ["day", "eic_code"], bucket=F.col("day"), offset=first.count()))


@register("zone_series_first_zone")
def q_series_one_zone(spark, sf_dir):
    """one zone (the first by name) and the first week of the data."""
    fact = measurements_fact(spark, sf_dir)
    zone, start = fact.agg(F.min("bzn"), F.min("datetime")).first()
    end = spark.range(1).select(F.lit(start).cast("timestamp_ntz") + F.expr("INTERVAL 7 DAYS")).first()[0]
    return reports.zone_series(fact, zone, start, end, order=False)


@register("green_share_last_hour")
def q_share_one_hour(spark, sf_dir):
    """the last hour of the data."""
    fact = measurements_fact(spark, sf_dir)
    last = fact.agg(F.date_trunc("hour", F.max("datetime"))).first()[0]
    return reports.green_share(fact, hour=last, decimals=DECIMALS)


