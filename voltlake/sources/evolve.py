"""Tables whose column types widen as deliveries change.

An inferred feed may hold whole numbers first, decimals later and a text at
last. Types form a lattice, long -> double -> string and timestamp -> string,
and a column takes the least type that holds all deliveries, so no value is
ever narrowed: a later 3.7 makes a column of whole numbers one of doubles, and
whole numbers that a double can't hold exactly make it one of texts.

Files are never rewritten. A table of one type stays a plain table. When a
column widens, the table becomes a view over its versions, ``<table>__v1``,
``__v2`` and so on, each a table with the types of its time; the view casts
older versions up as they are read, and its filters on ``day`` still prune
their folders. New rows are written to the newest version before the view
shows it, so readers see a delivery whole or not at all.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REAL = (T.FloatType, T.DoubleType)
_TIME = (T.TimestampType, T.TimestampNTZType)
#: Whole numbers up to here are exact in a double.
EXACT = 1 << 53


def lake_type(t: T.DataType) -> T.DataType | None:
    """The lattice's type for a column's type; None where there is none."""
    if isinstance(t, (T.StringType, T.NullType)):
        return T.StringType() if isinstance(t, T.StringType) else t
    if isinstance(t, _WHOLE):
        return T.LongType()
    if isinstance(t, _REAL):
        return T.DoubleType()
    if isinstance(t, _TIME):
        return T.TimestampNTZType()
    return None


def join_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, (*_WHOLE, *_REAL)) and isinstance(b, (*_WHOLE, *_REAL)):
        return T.DoubleType() if isinstance(a, _REAL) or isinstance(b, _REAL) else T.LongType()
    return T.StringType()


def loses(source: T.DataType, target: T.DataType) -> bool:
    """Whether a cast may drop a part of a value without an error."""
    fraction = isinstance(source, (*_REAL, T.DecimalType))
    return (fraction and isinstance(target, _WHOLE)) or (isinstance(source, T.DoubleType) and isinstance(target, T.FloatType)) \
        or (isinstance(source, _TIME) and isinstance(target, T.DateType))


def _exact(df: DataFrame, name: str) -> bool:
    """Whether a double holds every whole number of a column."""
    low, high = df.agg(F.min(name), F.max(name)).first()
    return low is None or (low >= -EXACT and high <= EXACT)


def widened(there: DataFrame, new: DataFrame) -> T.StructType:
    """The columns of ``there``, each wide enough for ``new`` as well, and then the columns that only ``new`` has."""
    have, out = {f.name: f.dataType for f in new.schema.fields}, []
    for f in there.schema.fields:
        to = join_types(f.dataType, have.get(f.name, f.dataType))
        for df, t in ((there, f.dataType), (new, have.get(f.name))):
            if isinstance(to, T.DoubleType) and isinstance(t, T.LongType) and not _exact(df, f.name):
                to = T.StringType()
        out.append(T.StructField(f.name, to))
    known = set(there.columns)
    return T.StructType(out + [T.StructField(f.name, f.dataType) for f in new.schema.fields if f.name not in known])


def versions(spark: SparkSession, table: str) -> list[str]:
    """The versions of a table, oldest first; a plain table is its only one."""
    own = re.compile(re.escape(table.split(".")[-1].lower()) + r"__v(\d+)")
    prefix = table[:len(table) - len(table.split(".")[-1])]
    numbers = sorted(int(m.group(1)) for t in spark.catalog.listTables(prefix[:-1] or None) if (m := own.fullmatch(t.name.lower())))
    return [f"{table}__v{n}" for n in numbers] if numbers else [table]


def _as(df: DataFrame, f: T.StructField) -> Column:
    return (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)


def _show(spark: SparkSession, table: str, names: list[str], schema: T.StructType) -> None:
    """(Re)define the view over the versions."""
    parts = []
    for v in names:
        have = set(spark.table(v).columns)
        parts.append("SELECT " + ", ".join(
            f"CAST({f'`{f.name}`' if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields) + f" FROM {v}")
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS " + " UNION ALL ".join(parts))


def _create(df: DataFrame, table: str, partition: str | None, location: str | None) -> None:
    w = df.limit(0).write.format("parquet")
    if partition:
        w = w.partitionBy(partition)
    if location:
        w = w.option("path", location)
    w.saveAsTable(table)


def append_widening(df: DataFrame, table: str, partition: str | None = None, location: str | None = None, balance=lambda out: out) -> None:
    """Append ``df`` to ``table``, creating it if it is missing, adding columns it lacks and widening those whose type has
    changed. ``balance`` spreads the rows over the write tasks."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        _create(df, table, partition, location)
    names = versions(spark, table)
    there = spark.table(table)
    target = widened(there, df)
    newest = spark.table(names[-1])
    types = {f.name: f.dataType for f in newest.schema.fields}
    changed = any(f.name in types and types[f.name] != f.dataType for f in target.fields)
    if not changed:
        new = [f for f in target.fields if f.name not in types and f.name != partition]
        if new:
            spark.sql(f"ALTER TABLE {names[-1]} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
        out = balance(df.select(*[_as(df, f) for f in spark.table(names[-1]).schema.fields]))
        out.write.mode("append").format("parquet").insertInto(names[-1])
        if names != [table] and new:
            _show(spark, table, names, target)
        return
    number = 1 + int(names[-1].rsplit("__v", 1)[1]) if names != [table] else 2
    fields = [f for f in target.fields if f.name != partition] + [f for f in target.fields if f.name == partition]
    out = df.select(*[_as(df, f) for f in fields])
    version = f"{table}__v{number}"
    _create(out, version, partition, f"{location.rstrip('/')}__v{number}" if location else None)
    balance(out).write.mode("append").format("parquet").insertInto(version)
    if names == [table]:
        spark.sql(f"ALTER TABLE {table} RENAME TO {table}__v1")
    _show(spark, table, versions(spark, table), target)


def drop_versions(spark: SparkSession, table: str) -> None:
    """Drop a table with all its versions."""
    names = versions(spark, table)
    if names != [table]:
        spark.sql(f"DROP VIEW IF EXISTS {table}")
    for v in names:
        spark.sql(f"DROP TABLE IF EXISTS {v}")
