"""Clean layer (D8): weather projection (P1), zone enrichment (J1). The
complete-column projection (P8) is part of the weather reader.

The superseded enrichment without DISTINCT (J2) is not provided: it joins
every row to every weather row of its zone, i.e. emits all pairs inside a
zone group; J1 is the enrichment the reference settled on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.constants import POLAND_EIC, WEATHER_RENAMES

WEATHER_CLEAN_COLUMNS = [new for _, new in WEATHER_RENAMES]


def clean_weather(weather_data: DataFrame, keep_extra: Sequence[str] = ("ingest_order",)) -> DataFrame:
    """The 19-column rename/select of the weather feed. Raw fields that
    are absent (dropped as incomplete upstream) come back as typed nulls."""
    present = set(weather_data.columns)
    cols = []
    for old, new in WEATHER_RENAMES:
        if old in present:
            cols.append(F.col(old).alias(new))
        else:
            kind = "string" if new in ("station_info", "contributing_stations", "conditions",
                                       "country", "eic_code", "bzn") else "double"
            cols.append(F.lit(None).cast(kind).alias(new))
    cols += [F.col(c) for c in keep_extra if c in present]
    return weather_data.select(*cols)


def zone_pairs(weather_cleaned: DataFrame) -> DataFrame:
    """A3: distinct (eic_code, bzn) of the cleaned weather feed."""
    return weather_cleaned.select("eic_code", "bzn").distinct()


def add_bzn(df: DataFrame, weather_cleaned: DataFrame) -> DataFrame:
    """Left join to the distinct zone pairs, Poland forced to 'PL'.

    The pairs are the weather feed's own, so their number isn't known before:
    adaptive execution broadcasts them by their measured bytes or shuffles.
    """
    pairs = zone_pairs(weather_cleaned).withColumnRenamed("bzn", "_w_bzn")
    out = df.join(pairs, on="eic_code", how="left")
    bzn = F.when(F.col("eic_code") == F.lit(POLAND_EIC), F.lit("PL")).otherwise(F.col("_w_bzn"))
    return out.select(*[F.col(c) for c in df.columns], bzn.alias("bzn"))


def all_null_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: for each column, whether it has no non-null value."""
    return df.agg(*[(F.count(c) == 0).alias(c) for c in cols])
