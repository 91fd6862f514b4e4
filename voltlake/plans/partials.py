"""Dashboard sums that are kept, not recomputed.

A table with the energy sums of every zone and hour, by day. Sums of an hour
depend on that day's fact rows alone, so after a change only the days it
touched are read from the fact and replaced here. The dashboard's hours, shares
and country map are answered from this table, some hundred times smaller than
the fact.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.functions import timefn as T
from voltlake.plans import reports
from voltlake.sources.lake import DAY, _overwrite_partitions


def table_of(fact_table: str) -> str:
    return f"{fact_table}_hourly"


def refresh(spark: SparkSession, fact_table: str, table: str, days: Sequence[dt.date] | None = None) -> None:
    """Bring the sums of some days (by default all) up to date with the fact."""
    fact = spark.table(fact_table)
    if days is not None:
        if not days:
            return
        fact = fact.where(F.col(DAY).isin(list(days)))
    sums = reports.green_sums(fact).withColumn(DAY, F.to_date("hourly_datetime")).repartition(DAY)
    if spark.catalog.tableExists(table):
        _overwrite_partitions(sums, table)
    else:
        sums.write.format("parquet").partitionBy(DAY).saveAsTable(table)


def available_hours(partials: DataFrame) -> DataFrame:
    """B2."""
    return partials.select("hourly_datetime").distinct().where("hourly_datetime IS NOT NULL").orderBy("hourly_datetime")


def _of_hour(partials: DataFrame, hour) -> DataFrame:
    if hour is None:
        return partials
    at = F.lit(str(hour)).cast("timestamp_ntz")
    return partials.where((F.col("hourly_datetime") == T.trunc_hour(at)) & (F.col(DAY) == F.to_date(at)))


def green_share(partials: DataFrame, hour=None, decimals: int | None = None) -> DataFrame:
    """Of one hour, or of all."""
    return reports.shares(_of_hour(partials, hour), decimals)


def green_share_country(partials: DataFrame, hour=None, decimals: int | None = None, fanout: bool = False) -> DataFrame:
    """Of one hour, or of all."""
    return reports.country_map(reports.shares(_of_hour(partials, hour)), decimals, fanout)
