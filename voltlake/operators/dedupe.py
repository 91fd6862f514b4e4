"""Keep-first dedupe (A4) and pivot (A5).

Both are written as aggregations, not as ``row_number`` windows: an aggregate
is combined map-side before the shuffle, so a key that holds a third of all
rows is collapsed in every input task instead of being sorted in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INGEST_ORDER = "ingest_order"


def keep_first(df: DataFrame, keys: Sequence[str], order: str = INGEST_ORDER,
               keep: str = "first", keep_order: bool = False) -> DataFrame:
    """One row per ``keys``: the row with the smallest (``keep='last'``:
    largest) ``order`` value, like ``drop_duplicates(subset=keys)`` on a table
    stored in ingest order. Column order of ``df`` is preserved; ``order`` is
    dropped unless ``keep_order``.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys and c != order]
    pick = F.min_by if keep == "first" else F.max_by
    agg_order = F.min if keep == "first" else F.max
    aggs = [pick(F.struct(*others), F.col(order)).alias("_row")] if others else []
    aggs.append(agg_order(order).alias(order))
    out = df.groupBy(*keys).agg(*aggs)
    cols = [F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns if c != order]
    if keep_order:
        cols.append(F.col(order))
    return out.select(*cols)


def pivot_first(df: DataFrame, index: Sequence[str], pivot_col: str, value: str,
                pivot_values: Sequence[str], names: Sequence[str] | None = None,
                order: str = INGEST_ORDER, on_unmatched: str = "ignore") -> DataFrame:
    """A4 + A5 in one aggregation: long rows -> one column per pivot value,
    holding the first-ingested ``value`` of that (index, pivot value).

    Written as conditional ``min_by`` aggregates rather than ``.pivot()``: one
    shuffle on ``index`` with map-side partial aggregation, and a static
    output schema from the explicit value list (missing values -> null). A
    value outside the list has no column: ``on_unmatched='error'`` fails on one,
    'ignore' leaves it out (``unmatched_values`` lists such rows). A null value
    names no column and is left out.
    """
    from voltlake.operators.lookup import sql_literal
    names = list(names) if names is not None else list(pivot_values)
    aggs = []
    for v, n in zip(pivot_values, names):
        hit = f"`{pivot_col}` = {sql_literal(v)}"
        aggs.append(F.expr(f"min_by(CASE WHEN {hit} THEN `{value}` END, "
                           f"CASE WHEN {hit} THEN `{order}` END) AS `{n}`"))
    index = list(index)
    if on_unmatched == "ignore":
        return df.groupBy(*index).agg(*aggs)
    odd = F.max(F.when(~F.col(pivot_col).isin(list(pivot_values)), F.lit(1)).otherwise(F.lit(0)))
    out = df.groupBy(*index).agg(*aggs, odd.alias("_odd"))
    # a filter, so that the keys stay what the rows are partitioned by
    sound = F.when(F.col("_odd") == 0, F.lit(True)).otherwise(F.raise_error(F.lit(
        f"{pivot_col} has values without a column of their own; unmatched_values() lists them")).cast("boolean"))
    return out.where(sound).select(*index, *names)


def unmatched_values(df: DataFrame, col: str, known: Sequence[str]) -> DataFrame:
    """Values of ``col`` outside ``known`` (null among them) with their number of rows."""
    return df.where(F.col(col).isNull() | ~F.col(col).isin(list(known))).groupBy(col).agg(F.count("*").alias("n_rows"))
