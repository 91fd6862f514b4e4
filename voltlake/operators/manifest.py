"""Request planning.

The reference loops zones x 31-day windows and issues one HTTP request per
pair. Network I/O is not rebuilt; the plan of requests is: one row per feed,
zone and window with the request parameters (credentials are never part of
it). Windows come from ``sequence`` over the run window; the fixed zone list
is a literal array exploded per window (a constant fan-out of 17, no join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.constants import REQUEST_FIELDS, REQUEST_WINDOW_DAYS, WEATHER_MAX_HOURS, ZONES
from voltlake.functions import timefn as T
from voltlake.operators.lookup import sql_literal

MANIFEST_COLUMNS = ["feed", "bzn", "zone_param", "zone_value", "document_type", "process_type",
                    "contract_type", "period_start", "period_end"]

# --- fixed values: per-feed end handling (price excludes the end day, T17) ---
INCLUSIVE_END = {"production": True, "price": False, "consumption": True}


def window_starts(start: Column, end_exclusive: Column, days: int = REQUEST_WINDOW_DAYS) -> Column:
    """Window starts start, start + days, ... while < end (dates at
    midnight as TIMESTAMP_NTZ); empty when start >= end."""
    last = end_exclusive - F.expr("INTERVAL 1 DAY")
    return F.when(start <= last, F.sequence(start, last, F.expr(f"INTERVAL {days} DAYS"))) \
        .otherwise(F.array().cast("array<timestamp_ntz>"))


def _zone_array(zones: Sequence[tuple]) -> Column:
    items = ", ".join(
        f"named_struct('bzn', {sql_literal(z[2])}, 'eic', {sql_literal(z[1])}, "
        f"'coords', {sql_literal(f'{z[3]},{z[4]}')})" for z in zones)
    return F.expr(f"array({items})")


def request_manifest(run_window: DataFrame, zones: Sequence[tuple] = ZONES,
                     days: int = REQUEST_WINDOW_DAYS, weather_hours: int = WEATHER_MAX_HOURS) -> DataFrame:
    """Market requests (feed x zone x window) plus one weather request per
    zone over the clamped range (F10; one clamped window serves both the
    request and the file name, T10). ``run_window`` has one row
    (start_date, end_date) of DATE."""
    start = F.col("start_date").cast("timestamp_ntz")
    end = F.col("end_date").cast("timestamp_ntz")
    feeds = F.expr("array(" + ", ".join(
        f"named_struct('feed', {sql_literal(feed)}, 'document_type', {sql_literal(f['documentType'])}, "
        f"'process_type', CAST({sql_literal(f.get('processType'))} AS STRING), "
        f"'contract_type', CAST({sql_literal(f.get('contract_MarketAgreement.type'))} AS STRING), "
        f"'zone_param', {sql_literal(f['zone_param'])}, 'incl', {1 if INCLUSIVE_END[feed] else 0})"
        for feed, f in REQUEST_FIELDS.items()) + ")")
    per_feed = run_window.select(start.alias("s"), end.alias("e"), F.explode(feeds).alias("f"))
    per_feed = per_feed.withColumn("e_ex", F.col("e") + T.minutes(F.col("f.incl") * 1440))
    win = per_feed.select("f", "e_ex", F.explode(window_starts(F.col("s"), F.col("e_ex"), days)).alias("ws"))
    market = win.select("f", "e_ex", "ws", F.explode(_zone_array(zones)).alias("z")).select(
        F.col("f.feed").alias("feed"), F.col("z.bzn").alias("bzn"), F.col("f.zone_param").alias("zone_param"),
        F.col("z.eic").alias("zone_value"), F.col("f.document_type").alias("document_type"),
        F.col("f.process_type").alias("process_type"), F.col("f.contract_type").alias("contract_type"),
        T.request_stamp("ws").alias("period_start"),
        T.request_stamp(F.least(F.col("ws") + F.expr(f"INTERVAL {days} DAYS"), F.col("e_ex"))).alias("period_end"))
    w_start = F.to_date(T.clamp_start(start, end, weather_hours))
    weather = run_window.select(w_start.alias("ws"), F.col("end_date").alias("we"),
                                F.explode(_zone_array(zones)).alias("z")).select(
        F.lit("weather").alias("feed"), F.col("z.bzn").alias("bzn"), F.lit("locations").alias("zone_param"),
        F.col("z.coords").alias("zone_value"), F.lit(None).cast("string").alias("document_type"),
        F.lit(None).cast("string").alias("process_type"), F.lit(None).cast("string").alias("contract_type"),
        F.concat(F.date_format("ws", "yyyy-MM-dd"), F.lit("T00:00:00")).alias("period_start"),
        F.concat(F.date_format("we", "yyyy-MM-dd"), F.lit("T23:59:59")).alias("period_end"))
    return market.unionByName(weather)


def data_run_window(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Run window spanning a table's timestamps (first and last day)."""
    return df.agg(F.min(F.to_date(ts)).alias("start_date"), F.max(F.to_date(ts)).alias("end_date"))
