"""Order over a whole table without one task for it: sampled ranges, local
numbers and prefixes over one row a range (A10/W6, W4).

Rows are dealt to ranges of the order by sampled bounds (Spark's range
partitioning), sorted inside each, and numbered there: ``monotonically_increasing_id``
holds the range in its upper bits and the place in its lower 33. A checkpoint
in the shared folder fixes both, so that a recomputed task can't deal anew.
What has to cross ranges (counts, last known values) is one row a range and
key; only those rows meet in a window.

Ranges are even as long as the order has no value that many rows share; rows
of one value stay in one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltlake.session import ensure_checkpoint_dir

RANGE, PLACE = "_range", "_place"


def in_ranges(df: DataFrame, order: Sequence[Column | str], ranges: int | None = None) -> DataFrame:
    """``df`` with the number of its range (rising along ``order``) and its place there, fixed by a checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    own = F.monotonically_increasing_id()
    return dealt.sortWithinPartitions(*order).withColumn(PLACE, own).select(
        *[F.col(f"`{c}`") for c in df.columns], F.shiftright(PLACE, 33).alias(RANGE),
        F.col(PLACE).bitwiseAND(F.lit((1 << 33) - 1)).alias(PLACE)).checkpoint(eager=True)


def dense_ids(df: DataFrame, order: Sequence[Column | str], offset: int = 0, name: str = "_id", ranges: int | None = None) -> DataFrame:
    """``name`` = offset + 1..n along ``order``, which has to be unique for ids that don't depend on the run."""
    dealt = in_ranges(df, order, ranges)
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    bases = dealt.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_n")) \
        .select(RANGE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return dealt.join(F.broadcast(bases), RANGE).withColumn(name, F.col("_base") + F.col(PLACE) + F.lit(offset + 1)) \
        .drop(RANGE, PLACE, "_base")


def fill_forward(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """W4 over series of any length: nulls in ``cols`` take the key's last non-null value before them in ``order``.

    Three steps: the last non-null value of each key and range, what earlier ranges hand on to each
    (a window over one row a key and range), and a fill inside key and range that starts from there.
    """
    keys, order = list(keys), list(order)
    dealt = in_ranges(df, [*keys, *order], ranges)
    last = dealt.groupBy(*keys, RANGE).agg(*[
        F.max_by(F.struct(F.col(c).alias("v")), F.when(F.col(c).isNotNull(), F.col(PLACE))).alias(f"_last_{c}") for c in cols])
    earlier = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    handed = last.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.col(RANGE).alias("_key_range"),
                         *[F.last(f"_last_{c}", ignorenulls=True).over(earlier).getField("v").alias(f"_carry_{c}") for c in cols])
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys] + [F.col(RANGE) == F.col("_key_range")]
    inside = Window.partitionBy(*keys, RANGE).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
    joined = dealt.join(handed, same, "left")
    filled = {c: F.coalesce(F.last(c, ignorenulls=True).over(inside), F.col(f"_carry_{c}")) for c in cols}
    return joined.select(*[filled[c].alias(c) if c in filled else F.col(f"`{c}`") for c in df.columns])
