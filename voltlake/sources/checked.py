"""Tables whose keys and NOT NULL columns are enforced as rows are written.

A load is written to a folder of its own and checked by the job that writes
it: nulls, repeated keys and keys that the table already has are counted as
observed metrics of that one pass over the load. Only a load without
violations becomes a partition of the table, which is when its rows become
visible; another one is refused, and its verdict says why. The checks need one
exchange on the key (the written rows are sorted by it) and, of the rows that
are there, the key columns alone.

``<name>__loads`` holds the loads, the view ``<name>`` their columns, and
``<name>__verdicts`` one row for each load, check and column.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlake.sources.lake import conform

LOAD = "load"


class Refused(ValueError):
    """A load that breaks a declared constraint; ``verdict`` maps (check, column) to the number of rows."""

    def __init__(self, table: str, load: str, verdict: dict[tuple[str, str], int]):
        self.load, self.verdict = load, verdict
        super().__init__(f"{table}: load {load} refused: " + ", ".join(f"{c} {k}: {n} rows" for (c, k), n in verdict.items() if n))


@dataclass(frozen=True)
class CheckedTable:
    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    location: str

    @property
    def loads(self) -> str:
        return f"{self.name}__loads"

    @property
    def verdicts(self) -> str:
        return f"{self.name}__verdicts"

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


def create_checked(spark: SparkSession, name: str, ddl: str | T.StructType, keys: Sequence[str], location: str) -> CheckedTable:
    """A table by its declaration; columns declared NOT NULL and the keys are enforced by ``load``."""
    schema = ddl if isinstance(ddl, T.StructType) else T.StructType.fromDDL(ddl)
    t = CheckedTable(name, schema, tuple(keys), location.rstrip("/"))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {t.loads} ({columns}, {LOAD} STRING) USING parquet PARTITIONED BY ({LOAD}) LOCATION '{t.location}/loads'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {t.verdicts} ({LOAD} STRING, check STRING, column STRING, violations BIGINT, accepted BOOLEAN) "
              f"USING parquet LOCATION '{t.location}/verdicts'")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(f'`{f.name}`' for f in schema.fields)} FROM {t.loads}")
    return t


def load(t: CheckedTable, df: DataFrame, name: str | None = None) -> dict[tuple[str, str], int]:
    """Write a load, check it in the same job and make it visible if nothing is wrong; raises ``Refused`` if something is.
    The verdict is kept either way. A name is used once."""
    spark = df.sparkSession
    name = name or uuid.uuid4().hex
    keys, columns = list(t.keys), t.schema.fieldNames()
    new = conform(df, t.schema).withColumn("_new", F.lit(True))
    there = spark.table(t.loads).select(*keys, F.lit(False).alias("_new"))
    of_key = Window.partitionBy(*keys)
    seen = Window.partitionBy(*keys).orderBy(F.col("_new"))  # rows that are there come first
    both = new.unionByName(there, allowMissingColumns=True) \
        .withColumns({"_n": F.row_number().over(seen), "_there": F.max(~F.col("_new")).over(of_key)}).where("_new")
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    metrics = {("key", ",".join(keys)): F.count_if((F.col("_n") > 1) & ~F.col("_there") & ~null_key),
               ("key is there", ",".join(keys)): F.count_if(F.col("_there") & ~null_key),
               **{("not null", c): F.count_if(F.col(c).isNull()) for c in dict.fromkeys([*t.required, *keys])}}
    watch = Observation()
    checked = both.observe(watch, *[m.alias(f"m{i}") for i, m in enumerate(metrics.values())])
    place = f"{t.location}/loads/{LOAD}={name}"
    checked.select(*columns).write.parquet(place)
    got = watch.get
    verdict = {k: int(got[f"m{i}"] or 0) for i, k in enumerate(metrics)}
    accepted = not any(verdict.values())
    spark.createDataFrame([(name, check, column, n, accepted) for (check, column), n in verdict.items()],
                          spark.table(t.verdicts).schema).coalesce(1).write.insertInto(t.verdicts)
    if not accepted:
        raise Refused(t.name, name, verdict)
    spark.sql(f"ALTER TABLE {t.loads} ADD IF NOT EXISTS PARTITION ({LOAD} = '{name}') LOCATION '{place}'")
    return verdict
