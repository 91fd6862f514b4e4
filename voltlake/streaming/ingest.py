"""Incremental file ingest (ST1) with late and repeated rows (ST2).

Replaces the hand-off "load the newest file into the mart" (S17 + S20) with a
file-source stream: with ``trigger(availableNow=True)`` a scheduled run reads
the files that arrived since the last run and stops.

* The checkpoint names the files that were read, so it has to outlive the
  application: it lies under ``root``, a folder that the caller or the setting
  ``voltlake.stream.root`` names. There is no default; a folder of one
  application (such as Spark's own checkpoint folder) would forget every file.
* A micro-batch may be written twice if a run is lost between its write and
  its commit. With ``keys`` the write is idempotent: a batch keeps the first
  row of each key and adds those that the table's days it touches don't have.
  No row is too late: a backfill of any age is compared with its own days.
* Without ``keys`` the rows are appended as they are, each file once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from voltlake.operators.dedupe import INGEST_ORDER, keep_first

ROOT_CONF = "voltlake.stream.root"
DAY = "day"


def stream_root(spark: SparkSession, root: str | None = None) -> str:
    """The folder of stream checkpoints that all applications share."""
    named = root or spark.conf.get(ROOT_CONF, None)
    if not named:
        raise ValueError(f"name a lasting shared folder for stream checkpoints: pass root or set {ROOT_CONF}")
    return named.rstrip("/")


def checkpoint_location(spark: SparkSession, name: str, root: str | None = None) -> str:
    return f"{stream_root(spark, root)}/streams/{name}"


def read_new_files(spark: SparkSession, source_dir: str, schema: T.StructType,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).option("recursiveFileLookup", True) \
        .option("pathGlobFilter", "*.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(source_dir)


def merge_new(batch: DataFrame, table: str, keys: Sequence[str], ts: str = "datetime",
              order: str = INGEST_ORDER) -> None:
    """ST2: add the first row of every key that ``table`` doesn't have yet.

    ``keys`` with ``ts`` name a point. The table is partitioned by the day of
    ``ts`` and only the days of the batch are read (their list is one value a
    day of the batch). The new rows are computed before the write, in a
    checkpoint, as they depend on the table that is written.
    """
    spark = batch.sparkSession
    key = list(dict.fromkeys([*keys, ts]))
    first = keep_first(batch, key, order, keep_order=True).withColumn(DAY, F.to_date(ts))
    if not spark.catalog.tableExists(table):
        first.limit(0).write.format("parquet").partitionBy(DAY).saveAsTable(table)
    days = [r[0] for r in first.select(DAY).distinct().collect()]
    there = spark.table(table).where(F.col(DAY).isin(days) | F.col(DAY).isNull()).select(*[F.col(k).alias(f"_has_{k}") for k in key])
    absent = first.join(there, [F.col(k).eqNullSafe(F.col(f"_has_{k}")) for k in key], "left_anti")
    new = absent.checkpoint(eager=True)
    new.select(*spark.table(table).columns).write.mode("append").format("parquet").insertInto(table)


def ingest_stream(spark: SparkSession, source_dir: str, schema: T.StructType, table: str,
                  name: str | None = None, dedupe_keys: Sequence[str] | None = None,
                  ts: str = "datetime", root: str | None = None, checkpoint: str | None = None,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """ST1: bring every new file of ``source_dir`` into ``table``.
    Returns the started query (``availableNow``: it stops when caught up)."""
    from voltlake.session import ensure_checkpoint_dir
    s = read_new_files(spark, source_dir, schema, max_files_per_trigger)
    ckpt = checkpoint or checkpoint_location(spark, name or table, root)
    w = s.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True)
    if not dedupe_keys:
        return w.format("parquet").outputMode("append").toTable(table)
    ensure_checkpoint_dir(spark)
    keys = list(dedupe_keys)
    return w.foreachBatch(lambda batch, _: merge_new(batch, table, keys, ts)).start()
