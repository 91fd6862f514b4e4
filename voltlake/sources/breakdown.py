"""Power-breakdown JSON reader (S8) and its range report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BREAKDOWN_SCHEMA = (
    "zone STRING, history ARRAY<STRUCT<datetime: STRING, "
    "powerConsumptionBreakdown: MAP<STRING, DOUBLE>, powerProductionBreakdown: MAP<STRING, DOUBLE>>>"
)


def _read(docs: DataFrame, body_col: str) -> DataFrame:
    """docs with ``_d`` (the parsed body) and ``_broken``: no JSON of the expected shape, or no history in it."""
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    d = docs.withColumn("_d", F.from_json(F.col(body_col), BREAKDOWN_SCHEMA + ", _corrupt STRING", opts))
    return d.withColumn("_broken", F.col("_d").isNull() | F.col("_d._corrupt").isNotNull() | F.col("_d.history").isNull())


def quarantine(docs: DataFrame, body_col: str = "body") -> DataFrame:
    """The documents that ``history(on_bad='skip')`` leaves out."""
    return _read(docs, body_col).where("_broken").select(*docs.columns)


def history(docs: DataFrame, body_col: str = "body", on_bad: str = "error") -> DataFrame:
    """One row per history entry: zone, datetime (NTZ, UTC), both maps. A
    broken body is an error; ``on_bad='skip'`` leaves such documents out, and
    ``quarantine`` returns them."""
    d = _read(docs, body_col)
    if on_bad == "skip":
        d = d.where(~F.col("_broken"))
    else:
        d = d.withColumn("_d", F.when(~F.col("_broken"), F.col("_d")).otherwise(F.raise_error(F.concat(
            F.lit("breakdown document can't be read: "), F.left(F.coalesce(F.col(body_col), F.lit("null")), F.lit(80))))))
    h = d.select(F.col("_d.zone").alias("zone"), F.explode("_d.history").alias("_h"))
    text = F.regexp_replace(F.col("_h.datetime"), "Z$", "")
    ntz = F.to_timestamp_ntz(F.substring(text, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    return h.select("zone", ntz.alias("datetime"),
                    F.col("_h.powerConsumptionBreakdown").alias("consumption"),
                    F.col("_h.powerProductionBreakdown").alias("production"))


def breakdown_frame(docs: DataFrame, which: str, keys: Sequence[str], prefix: str = "",
                    on_bad: str = "error") -> DataFrame:
    """The wide consumption or production frame: one column per map key of
    ``keys`` (static schema; a key absent from an entry is null)."""
    h = history(docs, on_bad=on_bad)
    return h.select("zone", "datetime",
                    *[F.try_element_at(F.col(which), F.lit(k)).alias(prefix + k) for k in keys])


def breakdown_range(frame: DataFrame) -> DataFrame:
    """Data range per zone (first/last timestamp, number of entries)."""
    return frame.groupBy("zone").agg(F.min("datetime").alias("start_datetime"),
                                     F.max("datetime").alias("end_datetime"),
                                     F.count(F.lit(1)).alias("n_entries"))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows (a preview is the feature here)."""
    return df.limit(n)
