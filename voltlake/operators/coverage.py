"""Which parts of the requested windows have landed.

``gaps`` subtracts the union of the landed intervals from that of the
requested ones, per key, as half-open intervals. Both are cut at midnight, so
every window over intervals is one of a key's day, however long a series is or
how many documents a zone has; equal starts of a day are combined before they
are shuffled. Only the gaps, which are cut again at midnight alone, meet in a
window over the key, where those that touch are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = "_day"


def _next_day(midnight: Column) -> Column:
    return midnight + F.expr("INTERVAL 1 DAY")


def by_day(intervals: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """(keys, _day, s, e): intervals cut at midnight, the longest of each start; empty and open ones are left out."""
    own = intervals.where(F.col(start) < F.col(end)).select(*keys, F.col(start).cast("timestamp_ntz").alias("s"), F.col(end).cast("timestamp_ntz").alias("e"))
    days = F.sequence(F.to_date("s"), F.to_date(F.col("e") - F.expr("INTERVAL 1 MICROSECOND")))
    cut = own.select("*", F.explode(days).alias(DAY)).withColumn("_from", F.col(DAY).cast("timestamp_ntz"))
    return cut.select(*keys, DAY, F.greatest("s", "_from").alias("s"), F.least("e", _next_day(F.col("_from"))).alias("e")) \
        .groupBy(*keys, DAY, "s").agg(F.max("e").alias("e"))


def union(pieces: DataFrame, group: Sequence[str]) -> DataFrame:
    """Disjoint intervals that cover the same; those that touch are one."""
    order = Window.partitionBy(*group).orderBy("s")
    reach = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = pieces.withColumn("_head", F.coalesce(F.col("s") > reach, F.lit(True)).cast("int"))
    island = F.sum("_head").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("_island", island).groupBy(*group, "_island").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("_island")


def _free(landed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a key's day has left between disjoint intervals, from midnight to midnight."""
    group = [*keys, DAY]
    order = Window.partitionBy(*group).orderBy("s")
    midnight = F.col(DAY).cast("timestamp_ntz")
    before = landed.select(*group, F.coalesce(F.lag("e").over(order), midnight).alias("s"), F.col("s").alias("e"))
    after = landed.groupBy(*group).agg(F.max("e").alias("s")).select(*group, "s", _next_day(midnight).alias("e"))
    return before.unionByName(after).where("s < e")


def gaps(requested: DataFrame, landed: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """(keys, start, end) of every requested stretch that didn't land, as long as possible."""
    keys = list(keys)
    group = [*keys, DAY]
    want = union(by_day(requested, keys, start, end), group)
    have = union(by_day(landed, keys, start, end), group)
    free = _free(have, keys).select(*[F.col(g).alias(f"_f{g}") for g in group], F.col("s").alias("_fs"), F.col("e").alias("_fe"))
    touched = have.select(*group).distinct().select(*[F.col(g).alias(f"_t{g}") for g in group])
    same = lambda p: [F.col(g).eqNullSafe(F.col(f"{p}{g}")) for g in group]
    whole = want.join(touched, same("_t"), "left_anti").select(*keys, "s", "e")
    part = want.join(free, [*same("_f"), F.col("s") < F.col("_fe"), F.col("_fs") < F.col("e")]) \
        .select(*keys, F.greatest("s", "_fs").alias("s"), F.least("e", "_fe").alias("e"))
    return union(whole.unionByName(part), keys).select(*keys, F.col("s").alias(start), F.col("e").alias(end))
