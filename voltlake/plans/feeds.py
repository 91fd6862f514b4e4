"""Feeds read back from landed documents (S3-S8 end to end).

``landed_documents`` produces the four document tables from the driver
tables; ``feeds_from_documents`` parses them into the lake-table shapes the
fact and dimension builders take. The keep-first order after parsing is the
document order (document sequence, series, period, point).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.constants import ZONES
from voltlake.operators.asof import forward_fill, hourly_grid
from voltlake.operators.dedupe import keep_first
from voltlake.operators.lookup import lookup
from voltlake.plans.clean import clean_weather
from voltlake.sources import fixtures as fx
from voltlake.sources import landing
from voltlake.sources.market_xml import parse_generation, parse_load, parse_price
from voltlake.sources.weather_json import parse_weather


def landed_documents(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    ev = fx.read_events(spark, sf_dir)
    return {
        "production": landing.generation_documents(ev),
        "price": landing.price_documents(ev),
        "consumption": landing.load_documents(ev),
        "weather": landing.weather_documents(fx.weather_data(ev)),
    }


def feeds_from_documents(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    docs = landed_documents(spark, sf_dir)
    price = parse_price(docs["price"]).drop("position")
    return {
        "production": parse_generation(docs["production"]),
        "consumption": parse_load(docs["consumption"]),
        "price": price,
        "weather": clean_weather(parse_weather(docs["weather"])),
    }


def price_day_report(price_docs: DataFrame) -> DataFrame:
    """Per zone and document day, the 24 hourly prices of that UTC day.

    W2 (every position one hour) -> keep first per hour -> J6 reindex onto
    00:00..23:00 (points outside the day are dropped, missing hours null) ->
    W4 forward fill (leading nulls stay) -> zone code as ``country`` (P11).
    The window is per (zone, day): 24 rows each.
    """
    pts = parse_price(price_docs, hourly_positions=True, keep=["period_start"])
    pts = pts.select("eic_code", F.col("period_start").alias("day"), "datetime", "price", "ingest_order")
    firsts = keep_first(pts, ["eic_code", "day", "datetime"])
    # where the documents' table names the zone, no document is parsed for the days
    own = price_docs.withColumnRenamed("period_start", "day") if "eic_code" in price_docs.columns else pts
    days = own.select("eic_code", "day").distinct()
    grid = hourly_grid(days, "day", ["eic_code"])
    j = grid.join(firsts, ["eic_code", "day", "datetime"], "left")
    filled = forward_fill(j, ["price"], ["eic_code", "day"], "datetime")
    return filled.select(lookup("eic_code", [(z[1], z[2]) for z in ZONES]).alias("country"),
                         "datetime", "price")
