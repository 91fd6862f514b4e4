"""Helpers shared by the operators of this package.

Operators read only the columns they are told to (``id_col``, ``text_col``),
so extra columns, whatever their names, never clash with their own. Null texts
count as empty ones.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes handed to Python at once; texts in them are cut into chunks of CHUNK_BYTES.
ARROW_ROWS = 1000
ARROW_BYTES = 4 << 20
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator works on, under fixed names."""
    bound_batches(df.sparkSession)
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def whole_rows(df: DataFrame, but: str | None = None) -> Column:
    """All columns of df, or all but one, as one, so that columns an operator adds can't clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c != but] or [F.lit(True)])


def rows_again(df: DataFrame, row: str, columns: list[str], changed: dict[str, Column] | None = None) -> DataFrame:
    """The columns of whole_rows(), some with other values."""
    return df.select(*[(changed or {}).get(c, F.col(row).getField(c)).alias(c) for c in columns])


def bound_batches(spark: SparkSession) -> None:
    """Hand smaller batches to Python than the defaults, unless the session asks for smaller ones still. Both are settings of
    the session that hold when a plan runs, so they stay."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)):
        now = re.fullmatch(r"(-?\d+)b?", spark.conf.get(key, None) or "0")
        if now and not 0 < int(now.group(1)) <= most:
            spark.conf.set(key, str(most))


def text_chunks(batches: Iterator[pa.RecordBatch], max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with at most max_bytes of text (one row at least), with their texts as strings."""
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(batch.schema.get_field_index("text"))
        sizes = pc.fill_null(pc.binary_length(text), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and held + n > max_bytes:
                part = batch.slice(start, i - start)
                yield part, [x or "" for x in text.slice(start, i - start).to_pylist()]
                start, held = i, 0
            held += n
        part = batch.slice(start)
        yield part, [x or "" for x in text.slice(start).to_pylist()]


def n_rows(df: DataFrame) -> int:
    return df.count()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a scratch folder only where none is named (local tests)."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    import tempfile
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="voltlake-llm-"))
    return sc.getCheckpointDir()


def saved(df: DataFrame, what: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and a lost executor costs nothing before it."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/voltlake-{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def read_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()
