"""Keep-first over a stream with bounded state, and nothing lost (ST2).

Rows within ``delay`` of the newest event time are on time: whether their point
was seen is kept as state, by key and a bucket of the time, so one zone's rows
are spread over BUCKETS tasks. The watermark prunes the state: a bucket holds
the times behind the watermark and no others. On-time rows are written without
looking at the table.

Rows older than the watermark, which stateful operators usually drop, are
handed on: their days, and only theirs, are read from the table, and points
that it doesn't have are added, however late.

Rows are written to folders of their day and batch, which a repeated batch
replaces, so a batch that is written twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from voltlake.operators.dedupe import INGEST_ORDER, keep_first
from voltlake.session import ensure_checkpoint_dir
from voltlake.sources.lake import _overwrite_partitions
from voltlake.streaming.ingest import DAY, checkpoint_location, read_new_files

BATCH = "batch"
BUCKETS = 16
_US, _EVENT, _BUCKET, _LATE = "_us", "_event", "_bucket", "_late"


def _splitter(order: str):
    """Rows of one key and bucket: late ones as they are, on-time ones if their time is new."""

    def split(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs() * 1000
        seen = {t for t in (state.get[0] if state.exists else []) if t >= mark}
        best = None
        for f in frames:
            f = f.drop(columns=[_EVENT])
            late = f[_US] < mark
            if late.any():
                yield f[late].assign(**{_LATE: True})
            new = f[~late & ~f[_US].isin(seen)]
            best = new if best is None else pd.concat([best, new])
            best = best.sort_values(order, kind="stable").drop_duplicates(_US)
        if best is not None and len(best):
            seen |= set(best[_US].tolist())
            yield best.assign(**{_LATE: False})
        if seen:
            state.update((sorted(seen),))
        elif state.exists:
            state.remove()
    return split


def with_lateness(stream: DataFrame, keys: Sequence[str], ts: str, delay: str, order: str = INGEST_ORDER) -> DataFrame:
    """The stream's rows that may be new, marked as late or not; points seen before within the delay are left out."""
    micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)")  # whatever the session's zone
    timed = stream.where(F.col(ts).isNotNull()).withColumn(_US, micros).withColumn(_EVENT, F.timestamp_micros(_US)) \
        .withColumn(_BUCKET, F.pmod(F.hash(_US), F.lit(BUCKETS))).withWatermark(_EVENT, delay)
    out = T.StructType([f for f in timed.schema.fields if f.name != _EVENT] + [T.StructField(_LATE, T.BooleanType())])
    return timed.groupBy(*keys, _BUCKET).applyInPandasWithState(_splitter(order), out, "times array<long>", "append", GroupStateTimeout.NoTimeout)


def create_table(spark: SparkSession, table: str, schema: T.StructType, location: str | None = None) -> None:
    if not spark.catalog.tableExists(table):
        w = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(DAY, T.DateType()), T.StructField(BATCH, T.LongType())])) \
            .write.format("parquet").partitionBy(DAY, BATCH)
        (w.option("path", location) if location else w).saveAsTable(table)


def write_batch(batch: DataFrame, number: int, table: str, keys: Sequence[str], ts: str, order: str = INGEST_ORDER) -> None:
    """On-time rows as they are, late ones that the table's days don't have."""
    spark, key = batch.sparkSession, list(dict.fromkeys([*keys, ts]))
    columns = spark.table(table).columns
    rows = batch.withColumn(DAY, F.to_date(ts)).withColumn(BATCH, F.lit(number).cast("long")).checkpoint(eager=True)  # the state is updated once
    late = rows.where(_LATE)
    days = [r[0] for r in late.select(DAY).distinct().collect()]
    out = rows.where(~F.col(_LATE)).select(*columns)
    if days:
        there = spark.table(table).where(F.col(DAY).isin(days) & (F.col(BATCH) != number)).select(*[F.col(k).alias(f"_has_{k}") for k in key])
        first = keep_first(late.select(*columns), key, order, keep_order=True)
        out = out.unionByName(first.join(there, [F.col(k).eqNullSafe(F.col(f"_has_{k}")) for k in key], "left_anti").select(*columns))
    _overwrite_partitions(out.repartition(DAY), table)


def ingest_late(spark: SparkSession, source_dir: str, schema: T.StructType, table: str, keys: Sequence[str], ts: str = "datetime",
                delay: str = "2 days", name: str | None = None, root: str | None = None, checkpoint: str | None = None,
                max_files_per_trigger: int | None = None, location: str | None = None) -> StreamingQuery:
    """Bring the new files of ``source_dir`` into ``table`` (partitioned by day and batch), the first row of each point once.
    Returns the started query (``availableNow``)."""
    ensure_checkpoint_dir(spark)
    create_table(spark, table, schema, location)
    marked = with_lateness(read_new_files(spark, source_dir, schema, max_files_per_trigger), keys, ts, delay)
    return marked.writeStream.outputMode("append").trigger(availableNow=True) \
        .option("checkpointLocation", checkpoint or checkpoint_location(spark, name or table, root)) \
        .foreachBatch(lambda batch, number: write_batch(batch, number, table, list(keys), ts)).start()
