"""Last-observation grid fill (J5 / W3), calendar reindex (J6), column fill.

``ffill_grid`` is the as-of-backward join of a regular grid onto a series:
each grid slot between the first and last observation of a key takes the whole
latest row at or before it (nulls included, T3). Instead of building the grid
and range-joining it, every observation emits the slots it covers, from its
own time up to the next observation: ``lead`` + ``explode(sequence(..))``.

Scale: a window over the zone alone would put one zone (possibly a third of
all rows) in one task. All windows but one are keyed by (key, day chunk). The
last observation of every chunk (one row per key and day) looks for the next
chunk's first one in a window over the key, so chunk edges are exact even
across empty days. Both kinds of rows come from the same window, so the source
is read and shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltlake.functions import timefn as T


def ffill_grid(df: DataFrame, keys: Sequence[str], ts: str = "datetime",
               step_minutes: int = 15) -> DataFrame:
    """Upsample ``df`` (unique per keys + ts) to a ``step_minutes`` grid.

    Grid per key: floor(first) ... floor(last); a slot before the first
    observation has no row (the reference's all-null leading slot is dropped
    later anyway). Output has the same columns as ``df``, ``ts`` = slot.
    """
    keys = list(keys)
    chunk = "_chunk"
    q = f"`{ts}`"
    own = df.filter(F.col(ts).isNotNull()).select(*df.columns, F.to_date(ts).alias(chunk))
    in_chunk = Window.partitionBy(*keys, chunk)
    obs = own.withColumns({"_next": F.lead(ts).over(in_chunk.orderBy(ts)), "_first": F.min(ts).over(in_chunk)})
    inner = obs.filter(F.col("_next").isNotNull()).drop("_first")
    last = obs.filter(F.col("_next").isNull()) \
        .withColumn("_next", F.lead("_first").over(Window.partitionBy(*keys).orderBy(chunk))).drop("_first")
    start = T.sql_ceil_minutes(q, step_minutes)
    end = (f"CASE WHEN _next IS NULL THEN {T.sql_floor_minutes(q, step_minutes)} "
           f"ELSE {T.sql_ceil_minutes('_next', step_minutes)} - {T.sql_minutes(int(step_minutes))} END")
    slots = F.expr(f"explode(CASE WHEN {start} <= {end} THEN "
                   f"sequence({start}, {end}, INTERVAL {int(step_minutes)} MINUTES) END)")
    return inner.unionByName(last).select(*[slots.alias(c) if c == ts else F.col(c) for c in df.columns])


def forward_fill(df: DataFrame, cols: Sequence[str], partition: Sequence[str], order: str) -> DataFrame:
    """Fill nulls in ``cols`` from the previous non-null value in order;
    leading nulls stay null."""
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def hourly_grid(days: DataFrame, day_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """J6 grid: one row per hour 00:00..23:00 of each day (``day_col`` is a
    TIMESTAMP_NTZ midnight). The fan-out is a fixed 24 per input row."""
    start = F.col(day_col)
    end = start + F.expr("INTERVAL 23 HOURS")
    return days.select(*keys, day_col,
                       F.explode(F.sequence(start, end, F.expr("INTERVAL 1 HOUR"))).alias("datetime"))


def reindex(grid: DataFrame, df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join the series onto the grid (missing slots null, rows off
    the grid dropped)."""
    return grid.join(df, on=list(on), how="left")

