"""Documents by the names of their files.

A landed file is named for its zone and window,
``weather_<zone>_<start>_to_<end>.json``, and so is the folder where Spark
wrote it. Zone and window are taken from the path, and a filter on them is one
on the file's metadata: Spark drops the other files while it lists, before any
is opened.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.constants import ZONES
from voltlake.functions.textfn import weather_file_name
from voltlake.operators.lookup import lookup

_NAME = r"weather_([^/]+?)_(\d{4}-\d{2}-\d{2})_to_(\d{4}-\d{2}-\d{2})\.json"


def name_parts(path: Column) -> dict[str, Column]:
    """Zone (lower-case), first and last day of a path; empty where the name isn't one of these."""
    return {k: F.regexp_extract(path, _NAME, i) for i, k in enumerate(("zone", "window_start", "window_end"), 1)}


def write_named(docs: DataFrame, folder: str, body_col: str = "body") -> None:
    """Land documents (``bzn``, ``window_start``, ``window_end``) in folders of their names, one document a line."""
    docs.select(weather_file_name("bzn", "window_start", "window_end").alias("name"), F.col(body_col).alias("value")) \
        .repartition("name").write.mode("append").partitionBy("name").text(folder)


def read_named(spark: SparkSession, folder: str, zones: Sequence[str] | None = None, start: str | None = None,
               end: str | None = None, whole: bool = True) -> DataFrame:
    """(bzn, window_start, window_end, body) of the documents of some zones whose window meets [start, end] (days).
    ``whole``: a file is one document; otherwise each line is."""
    path = F.col("_metadata.file_path")
    part = name_parts(path)
    files = spark.read.text(folder, wholetext=whole, recursiveFileLookup=True).where(part["zone"] != "")
    if zones is not None:
        files = files.where(part["zone"].isin([z.lower() for z in zones]))
    if start is not None:
        files = files.where(part["window_end"] >= str(start))
    if end is not None:
        files = files.where(part["window_start"] <= str(end))
    bzn = F.coalesce(lookup(part["zone"], [(z[2].lower(), z[2]) for z in ZONES]), F.upper(part["zone"]))
    return files.select(bzn.alias("bzn"), part["window_start"].alias("window_start"), part["window_end"].alias("window_end"), F.col("value").alias("body"))
