"""The fact kept up to date by change.

A delivery of feed rows, late ones included, changes the fact only where its
observations reach: load and production on their own day; price and weather
from their slot up to the next observation, and, where they end a series, from
the observation before. A carry table, the first and last observation of each
feed, zone and day, tells which days those are, so a delivery reads and
rewrites only them:

1. the delivery's rows are appended to the lake tables (by day) and its first
   and last observations to the carry table;
2. affected days: each touched day up to the next day with an observation of
   its series, and from the day before it if the series ended there so far;
3. needed days: for price and weather also the day with the last observation
   before an affected one and the first behind it, which carry into it;
4. the fact is built from the needed days and replaces the affected ones.

Everything is repeatable: a delivery that is appended twice changes nothing,
as the first row of a point counts and the carry table is a minimum and a
maximum. What reaches the driver are lists of days.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltlake.plans import fact as fact_plan
from voltlake.sources import lake

_TIME = {"production": "datetime", "consumption": "datetime", "price": "datetime", "weather": "date_time"}
_SCHEMA = {"production": lake.PRODUCTION_SCHEMA, "consumption": lake.CONSUMPTION_SCHEMA, "price": lake.PRICE_SCHEMA, "weather": None}
#: Feeds whose observations hold until the next one.
CARRIED = ("price", "weather")


@dataclass(frozen=True)
class Store:
    """Names of the tables: one lake table a feed, the carry table, the fact."""

    prefix: str

    def lake(self, feed: str) -> str:
        return f"{self.prefix}_{feed}"

    @property
    def carry(self) -> str:
        return f"{self.prefix}_carry"

    @property
    def fact(self) -> str:
        return f"{self.prefix}_fact"


def observations(delivery: Mapping[str, DataFrame]) -> DataFrame:
    """First and last observation of each feed, zone and day of a delivery."""
    parts = [df.select(F.lit(feed).alias("feed"), "eic_code", F.col(_TIME[feed]).alias("at")) for feed, df in delivery.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("at IS NOT NULL").groupBy("feed", "eic_code", F.to_date("at").alias("day")) \
        .agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"))


def carried_days(spark: SparkSession, store: Store, delivery_id: str) -> DataFrame:
    """The carry table by feed, zone and day: whether this delivery touched the day, whether earlier ones have observations
    there or later, and the series' neighbouring days with observations."""
    mine = F.col("delivery") == delivery_id
    days = spark.table(store.carry).groupBy("feed", "eic_code", "day").agg(F.bool_or(mine).alias("touched"), F.bool_or(~mine).alias("old"))
    series = Window.partitionBy("feed", "eic_code")  # one row a day
    in_order = series.orderBy("day")
    return days.select("*", F.lag("day").over(in_order).alias("before"), F.lead("day").over(in_order).alias("behind"),
                       F.coalesce(F.max(F.when(F.col("old"), F.col("day"))).over(series) >= F.col("day"), F.lit(False)).alias("went_on"))


def affected_days(days: DataFrame) -> list[dt.date]:
    """Days whose fact rows a delivery may change."""
    held = F.col("feed").isin(*CARRIED)
    start = F.when(held & ~F.col("went_on"), F.coalesce("before", "day")).otherwise(F.col("day"))
    end = F.when(held, F.coalesce("behind", "day")).otherwise(F.col("day"))
    out = days.where("touched").select(F.explode(F.sequence(start, end)).alias("day")).distinct()
    return sorted(r["day"] for r in out.collect())


def needed_days(days: DataFrame, affected: list[dt.date]) -> list[dt.date]:
    """Days with observations of carried feeds that the affected days' slots can take."""
    changed = F.array(*[F.lit(d) for d in affected])

    def some(low: Column, high: Column) -> Column:
        return F.exists(changed, lambda d: (d >= low) & (d <= high))

    here = F.col("day")
    use = some(here, here) | some(F.date_add(here, 1), F.col("behind")) | some(F.col("before"), F.date_sub(here, 1))
    out = days.where(F.col("feed").isin(*CARRIED) & F.coalesce(use, F.lit(False))).select("day").distinct()
    return sorted(r["day"] for r in out.collect())


def fact_of_days(spark: SparkSession, store: Store, affected: list[dt.date], needed: list[dt.date]) -> DataFrame:
    """The fact's rows of the affected days, from the needed days' folders alone."""
    def rows(feed):
        own = needed if feed in CARRIED else affected
        return spark.table(store.lake(feed)).where(F.col(lake.DAY).isin(own)).drop(lake.DAY)

    built = fact_plan.build_fact(rows("consumption"), rows("production"), rows("price"), rows("weather"))
    return built.where(F.to_date("datetime").isin(affected))


def deliver(spark: SparkSession, store: Store, delivery: Mapping[str, DataFrame]) -> list[dt.date]:
    """Take a delivery in and bring the fact up to date; returns the days that were rewritten. All four feeds have to be
    there, if empty, in the first one."""
    delivery_id = uuid.uuid4().hex
    for feed, df in delivery.items():
        lake.append_lake(df, store.lake(feed), _SCHEMA[feed], ts=_TIME[feed])
    lake.append_mart(store.carry, observations(delivery).withColumn("delivery", F.lit(delivery_id)), by_name=True)
    days = carried_days(spark, store, delivery_id)
    affected = affected_days(days)
    if affected:
        lake.write_fact(fact_of_days(spark, store, affected, needed_days(days, affected)), store.fact)
    return affected
