"""Marts that are laid out for their joins.

The feeds of the fact are kept as tables bucketed and sorted by (eic_code,
datetime). A bucket of one meets the same bucket of the others, so the three
joins of the fact read, sort and merge without an exchange, each time it is
built. Every bucket is one file: rows are dealt by the key before they are
written, and a zone with a third of all rows is spread by its times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.constants import ENERGY_TYPES, production_column
from voltlake.operators.joins import merge_feeds
from voltlake.plans import fact as fact_plan

BUCKETS = 16


def bucketed(df: DataFrame, table: str, keys=tuple(fact_plan.KEYS), buckets: int = BUCKETS, location: str | None = None) -> None:
    """Write ``df`` as a table bucketed and sorted by its keys, a file a bucket."""
    w = df.repartition(buckets, *keys).write.format("parquet").mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (w.option("path", location) if location else w).saveAsTable(table)


def write_marts(feeds, prefix: str, buckets: int = BUCKETS, location: str | None = None) -> dict[str, str]:
    """The four sides of the fact as bucketed tables; returns their names."""
    sides = {"weather": fact_plan.weather_grid(feeds["weather"]), "consumption": fact_plan.consumption_keyed(feeds["consumption"]),
             "production": fact_plan.production_wide(feeds["production"]), "price": fact_plan.price_grid(feeds["price"])}
    for name, df in sides.items():
        bucketed(df, f"{prefix}_{name}", buckets=buckets, location=f"{location}/{name}" if location else None)
    return {name: f"{prefix}_{name}" for name in sides}


def fact_from_marts(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """D7 from the marts: left joins from the weather side, bucket by bucket (J3), N1 and F1."""
    sides = {k: spark.table(t).hint("merge") for k, t in tables.items()}
    merged = merge_feeds(spark.table(tables["weather"]), [sides["consumption"], sides["production"], sides["price"]], fact_plan.KEYS)
    merged = fact_plan.fill_defaults(merged).filter(F.col("bzn").isNotNull() & (F.col("bzn") != ""))
    return merged.select("eic_code", "datetime", "consumption_quantity", "electricity_unit", *[production_column(t) for t in ENERGY_TYPES],
                         "price", "currency_unit", "price_measure_unit", *fact_plan.WEATHER_FACT_COLUMNS)
