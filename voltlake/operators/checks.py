"""Quality checks (Q1-Q3, S18): constraint violations as DataFrames.

Each check returns the offending rows (empty = pass) or a one-row summary, so
it runs distributed like any query; ``assert_empty`` turns it into an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q1/Q3: key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q2: one row, the number of nulls per column (``<col>_nulls``)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in cols])


def assert_empty(check: DataFrame, what: str) -> None:
    bad = check.limit(5).collect()
    if bad:
        raise ValueError(f"{what}: {len(bad)}+ violating rows, e.g. {bad[:3]}")


def assert_no_nulls(df: DataFrame, cols: Sequence[str], what: str) -> None:
    row = null_counts(df, cols).first()
    bad = {k: v for k, v in row.asDict().items() if v}
    if bad:
        raise ValueError(f"{what}: null values {bad}")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail when an input turned out empty."""
    if df.limit(1).count() == 0:
        raise ValueError(f"{what}: no input rows")
    return df
