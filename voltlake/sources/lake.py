"""Lake and mart table lifecycle.

Catalog tables (Parquet; Iceberg or another table format when its jar is on
the classpath) replace the reference's lake files plus per-feed mart files.
Every write is a Spark job writing from executors; nothing is collected.
"""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlake.sources import evolve

log = logging.getLogger(__name__)

# --- table contracts -------------------------------------------
PRODUCTION_SCHEMA = T.StructType([
    T.StructField("eic_code", T.StringType()), T.StructField("quantity", T.DoubleType()),
    T.StructField("unit", T.StringType()), T.StructField("produced_energy_type", T.StringType()),
    T.StructField("datetime", T.TimestampNTZType()), T.StructField("ingest_order", T.LongType())])
PRICE_SCHEMA = T.StructType([
    T.StructField("eic_code", T.StringType()), T.StructField("price", T.DoubleType()),
    T.StructField("currency_unit", T.StringType()), T.StructField("price_measure_unit", T.StringType()),
    T.StructField("datetime", T.TimestampNTZType()), T.StructField("ingest_order", T.LongType())])
CONSUMPTION_SCHEMA = T.StructType([
    T.StructField("eic_code", T.StringType()), T.StructField("quantity", T.DoubleType()),
    T.StructField("unit", T.StringType()), T.StructField("datetime", T.TimestampNTZType()),
    T.StructField("ingest_order", T.LongType())])

DIM_DDL: dict[str, str] = {
    "bidding_zone_DIMEN": "_id BIGINT NOT NULL, bzn STRING NOT NULL, country STRING NOT NULL, "
                          "eu_member INT NOT NULL, data_resolution INT NOT NULL, geometry STRING",
    "energy_type_DIMEN": "_id BIGINT NOT NULL, energy_type_x STRING NOT NULL, energy_type_class STRING NOT NULL, "
                         "renewable INT NOT NULL, carbon INT NOT NULL",
    "weather_condition_DIMEN": "_id BIGINT NOT NULL, condition_short STRING NOT NULL, condition_long STRING NOT NULL, "
                               "condition_type STRING NOT NULL, numerical INT NOT NULL",
    "unit_DIMEN": "_id BIGINT NOT NULL, unit_short STRING NOT NULL, unit_long STRING NOT NULL, "
                  "unit_class STRING NOT NULL",
    "timestamp_DIMEN": "_id BIGINT NOT NULL, datetime TIMESTAMP_NTZ NOT NULL, weekday STRING NOT NULL, "
                       "workingday INT NOT NULL, weekend INT NOT NULL, holiday INT NOT NULL",
}


# --- S11 / S12: landed documents and staging ---------------------------------

def write_documents(docs: DataFrame, path: str, partition_by: Sequence[str] = ("feed", "bzn", "window_start"),
                    mode: str = "append") -> None:
    """Land documents partitioned by feed, zone and window; the read
    side takes zone and window from the partition columns (X20)."""
    docs.write.mode(mode).partitionBy(*partition_by).json(path)


def read_landed(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


#: How a staged null is written; a text that is just this can't be staged.
STAGED_NULL = "\u0001null\u0001"
_STAGE_OPTIONS = {
    "header": "true", "nullValue": STAGED_NULL, "emptyValue": "", "quote": '"', "escape": '"',
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "multiLine": "true", "mode": "FAILFAST",
}


def stage(df: DataFrame, path: str) -> DataFrame:
    """CSV hand-off (header, no index column) read back with the
    frame's own schema: microseconds stay, and so does the difference between
    null and an empty text. Optional: lineage is normally passed on directly."""
    df.write.mode("overwrite").options(**_STAGE_OPTIONS, quoteAll="true").csv(path)
    return df.sparkSession.read.schema(df.schema).options(**_STAGE_OPTIONS).csv(path)


def drop_matching(df: DataFrame, pattern: str = r"^Unnamed") -> DataFrame:
    """Drop columns whose name matches a regex."""
    rx = re.compile(pattern)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not rx.search(c)])


# --- S13-S16: lake append ------------------------------------------------------

def supported_columns(df: DataFrame) -> DataFrame:
    """Keep string, integral, floating and timestamp columns (ints widened
    to long, floats to double); others are skipped with a message."""
    keep = []
    for f in df.schema.fields:
        t = evolve.lake_type(f.dataType)
        if t is None or isinstance(t, T.NullType):
            log.warning("column %s has a type the lake does not take; it is left out", f.name)
        elif t == f.dataType:
            keep.append(F.col(f"`{f.name}`"))
        else:
            keep.append(F.col(f"`{f.name}`").cast(t).alias(f.name))
    return df.select(*keep)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto a fixed schema by name (missing -> typed null). A
    cast that would drop a part of a value is an error."""
    have = {f.name: f.dataType for f in df.schema.fields}
    for f in schema.fields:
        if f.name in have and evolve.loses(have[f.name], f.dataType):
            raise TypeError(f"column {f.name}: {have[f.name].simpleString()} doesn't fit {f.dataType.simpleString()} without loss")
    return df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


#: Partition column of lake tables and of the fact: the date of ``datetime``.
DAY = "day"


def balanced(df: DataFrame) -> DataFrame:
    """Rows of a day together, but in as many tasks as their bytes need: adaptive execution splits a
    day over ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` and joins small ones."""
    return df.hint("rebalance", DAY) if DAY in df.columns else df.hint("rebalance")


def append_lake(df: DataFrame, table: str, schema: T.StructType | None = None,
                location: str | None = None, ts: str = "datetime") -> None:
    """Append to ``table``, creating it first (with ``schema``, or
    the frame's supported columns) when missing. A frame with columns the
    table lacks adds them, and one with wider types widens the table
    (``evolve.append_widening``); nothing is narrowed. A table with a column
    ``ts`` is partitioned by its date, so that a daily build reads the days it
    needs; a day is written by as many tasks as its size asks for."""
    df = conform(df, schema) if schema is not None else supported_columns(df)
    dated = ts in df.columns
    if dated:
        df = df.withColumn(DAY, F.to_date(ts))
    evolve.append_widening(df, table, DAY if dated else None, location, balanced)


# --- S17-S23: mart loading --------------------------------------------------------

#: Part files of one write share the job's id in their names.
_JOB_ID = r"part-[0-9]+-([0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})"


def _delivery(path: Column) -> Column:
    """What a file was delivered with: its folder and the id of the write, or the file itself if its name has none."""
    folder, name = F.regexp_extract(path, r"^(.*)/[^/]*$", 1), F.regexp_extract(path, r"([^/]*)$", 1)
    job = F.regexp_extract(name, _JOB_ID, 1)
    return F.concat(folder, F.lit("/"), F.when(job != "", job).otherwise(name))


def read_latest_parquet(spark: SparkSession, path: str) -> DataFrame:
    """The newest delivery under ``path`` (recursive), whole: every
    part file of the write that the newest file belongs to.

    Files are listed with their times (metadata alone), one value comes to the
    driver, and the filter on the file's path prunes every other file.
    """
    files = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
             .parquet(path))
    own = _delivery(F.col("_metadata.file_path"))
    newest = files.select(F.col("_metadata.file_modification_time").alias("at"), own.alias("delivery")) \
        .agg(F.max(F.struct("at", "delivery")).alias("m")).first()["m"]
    if newest is None:
        raise FileNotFoundError(f"nothing was delivered under {path}")
    return files.filter(own == F.lit(newest["delivery"]))


def require_input(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet input that must exist and hold rows."""
    df = spark.read.option("recursiveFileLookup", True).parquet(path)
    if df.limit(1).count() == 0:
        raise FileNotFoundError(f"no rows under {path}")
    return df


def create_like(table: str, df: DataFrame) -> None:
    """``CREATE TABLE IF NOT EXISTS t AS SELECT ... LIMIT 0``."""
    df.limit(0).write.mode("ignore").format("parquet").saveAsTable(table)


def append_mart(table: str, df: DataFrame, by_name: bool = False) -> None:
    """Append (positional like ``INSERT INTO t SELECT *``, or by name).
    Not idempotent: re-running appends again (T8), keep-first resolves it."""
    create_like(table, df)
    if by_name:
        df.write.mode("append").format("parquet").saveAsTable(table)
    else:
        df.write.insertInto(table)


def combine_marts(spark: SparkSession, sources: Mapping[str, str]) -> list[str]:
    """Copy every existing source table to its target name (replace)."""
    done = []
    for src, dst in sources.items():
        if spark.catalog.tableExists(src):
            spark.table(src).write.mode("overwrite").format("parquet").saveAsTable(dst)
            done.append(dst)
    return done


def refresh(spark: SparkSession, table: str) -> None:
    """S22 (re-aimed): empty a table before a full reload."""
    if spark.catalog.tableExists(table):
        spark.sql(f"TRUNCATE TABLE {table}")


def read_mart(spark: SparkSession, table: str) -> DataFrame:
    """S23."""
    return spark.table(table)


# --- S24-S26: star schema tables -------------------------------------------------

def create_dims(spark: SparkSession, ddl: Mapping[str, str] = DIM_DDL) -> None:
    """``CREATE TABLE IF NOT EXISTS`` for the dimension contracts.
    Key uniqueness and NOT NULL are verified by the Q1/Q2 checks."""
    for name, cols in ddl.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet")


def _overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions that df has rows of; the mode is a session setting for catalog tables."""
    spark, key = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        df.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(key, before)


def write_fact(df: DataFrame, table: str = "measurements_FACT", replace: bool = False) -> None:
    """Register as a view, replace the table's days from it, drop the view.

    The table is partitioned by ``day`` (the date of ``datetime``). A run
    replaces the days it has rows of and leaves the others (dynamic partition
    overwrite), so readers of other days aren't disturbed and a daily run
    doesn't rewrite history. ``replace=True``, or other columns than the
    table's, replaces the whole table. The dashboard reports add a ``day``
    predicate derived from their time filter, so a time range reads only its
    day folders; rows are sorted by (bzn, datetime) within a day, whose number
    of rows the grid bounds, so ``bzn = ?`` skips row groups too.
    """
    spark = df.sparkSession
    view = f"fact_{uuid.uuid4().hex}"  # one per call: builds may run side by side
    df.createOrReplaceTempView(view)
    try:
        out = spark.table(view).withColumn(DAY, F.to_date("datetime"))
        sort = [DAY, *[c for c in ("bzn", "datetime") if c in out.columns]]
        out = out.repartition(DAY).sortWithinPartitions(*sort)
        same = spark.catalog.tableExists(table) and spark.table(table).dtypes == out.dtypes
        if same and not replace:
            _overwrite_partitions(out, table)
        else:
            out.write.mode("overwrite").format("parquet").partitionBy(DAY).saveAsTable(table)
    finally:
        spark.catalog.dropTempView(view)


def like_to_regex(pattern: str) -> str:
    return "^" + "".join(".*" if ch == "%" else "." if ch == "_" else re.escape(ch) for ch in pattern) + "$"


def columns_like(spark: SparkSession, table: str, pattern: str | None = None) -> list[str]:
    """Catalog columns of a table, optionally filtered by LIKE."""
    cols = [c.name for c in spark.catalog.listColumns(table)]
    if pattern is None:
        return cols
    rx = re.compile(like_to_regex(pattern))
    return [c for c in cols if rx.match(c)]
