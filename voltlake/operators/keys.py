"""Insert-if-absent (J4) and dense surrogate keys (A10).

``sequential_ids`` numbers rows 1..n (plus an offset) in a total order
without a single global sort of the rows: rows are ranked inside coarse
buckets (``bucket`` must be a monotone prefix of the order, e.g. the day of a
timestamp), and each bucket's base comes from a running sum over the small
per-bucket count table. For tiny dimensions the bucket is a constant and this
is a plain ordered ``row_number`` over a few dozen distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def insert_if_absent(candidates: DataFrame, existing: DataFrame | None, key: Sequence[str] | str) -> DataFrame:
    """Candidates whose natural key is not yet in ``existing``."""
    if existing is None:
        return candidates
    key = [key] if isinstance(key, str) else list(key)
    # fresh aliases: the existing table may share lineage with the candidates
    ex = existing.select(*[F.col(k).alias(f"_ex_{k}") for k in key]).distinct()
    cond = [candidates[k].eqNullSafe(ex[f"_ex_{k}"]) for k in key]
    return candidates.join(ex, on=cond, how="left_anti")


def existing_count(existing: DataFrame | None) -> int:
    """The count-based offset of the reference (``COUNT(*) + 1``)."""
    return 0 if existing is None else existing.count()


def sequential_ids(df: DataFrame, order: Sequence[Column | str], bucket: Column | None = None,
                   offset: int = 0, name: str = "_id") -> DataFrame:
    """Add ``name`` = offset + 1..n following ``order``; ``bucket`` (optional)
    must be non-decreasing along ``order``."""
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    if bucket is None:
        w = Window.orderBy(*order_cols)
        return df.withColumn(name, (F.row_number().over(w) + F.lit(offset)).cast("long"))
    b = df.withColumn("_bucket", bucket)
    counts = b.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    wb = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_bucket", F.coalesce(F.sum("_n").over(wb), F.lit(0)).alias("_base"))
    wr = Window.partitionBy("_bucket").orderBy(*order_cols)
    ranked = b.withColumn("_rn", F.row_number().over(wr))
    out = ranked.join(bases, "_bucket")
    out = out.withColumn(name, (F.col("_base") + F.col("_rn") + F.lit(offset)).cast("long"))
    return out.drop("_bucket", "_base", "_rn")
