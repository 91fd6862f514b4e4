"""Zone mapper and run-window config (S1, S2, F2, X13, J11 zone lookups)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.constants import ZONES
from voltlake.functions.textfn import py_strip

ZONE_CSV_SCHEMA = "Country STRING, EIC STRING, BZN STRING, Latitude DOUBLE, Longitude DOUBLE"


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Mapper CSV with header; rows without EIC dropped (F2); EIC
    stripped of all surrounding whitespace, TAB included (T12)."""
    raw = spark.read.schema(ZONE_CSV_SCHEMA).option("header", True).csv(path)
    return raw.dropna(subset=["EIC"]).select(
        F.col("Country").alias("country"), py_strip("EIC").alias("eic_code"),
        F.col("EIC").alias("eic_raw"), F.col("BZN").alias("bzn"),
        F.col("Latitude").alias("latitude"), F.col("Longitude").alias("longitude"))


def zones_frame(spark: SparkSession) -> DataFrame:
    """The shipped 17 zones as a tiny frame (``eic_raw`` keeps the TAB of the
    Polish code as in the file)."""
    rows = [(c, e, e + ("\t" if b == "PL" else ""), b, la, lo) for c, e, b, la, lo in ZONES]
    return spark.createDataFrame(
        rows, "country string, eic_code string, eic_raw string, bzn string, latitude double, longitude double")


def coordinates(zones: DataFrame) -> DataFrame:
    """zone -> "lat,lon" request parameter."""
    return zones.select("bzn", F.concat_ws(",", F.col("latitude").cast("string"),
                                           F.col("longitude").cast("string")).alias("coordinates"))


def read_run_window(spark: SparkSession, path: str) -> DataFrame:
    """{"start_date": "yyyy-MM-dd", "end_date": ...} -> one row of dates."""
    j = spark.read.option("multiLine", True).schema("start_date STRING, end_date STRING").json(path)
    return j.select(F.to_date("start_date", "yyyy-MM-dd").alias("start_date"),
                    F.to_date("end_date", "yyyy-MM-dd").alias("end_date"))


def zone_rows(zones: DataFrame) -> list[tuple]:
    """The mapper's zones as the tuples that the request planner takes (a config file's rows)."""
    return [(r.country, r.eic_code, r.bzn, r.latitude, r.longitude)
            for r in zones.select("country", "eic_code", "bzn", "latitude", "longitude").orderBy("bzn").collect()]
