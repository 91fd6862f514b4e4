"""Star-schema build (D6): five dimensions (insert-if-absent) and the fact
(replace), written as catalog tables.

Dimension rows are computed against the current table, checkpointed (a
reliable checkpoint in the shared ``spark.checkpoint.dir``) so the append does
not read the table it writes, then appended. The fact is written once with
``write_fact``; dashboards then read the table instead of re-running the
build.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltlake.plans import dims
from voltlake.plans.fact import build_fact
from voltlake.session import ensure_checkpoint_dir
from voltlake.sources import lake


def _existing(spark: SparkSession, table: str) -> DataFrame | None:
    if spark.catalog.tableExists(table):
        t = spark.table(table)
        return t if t.limit(1).count() else None
    return None


def _upsert(spark: SparkSession, table: str, rows: DataFrame) -> int:
    new = rows.checkpoint(eager=True)
    n = new.count()
    if n:
        new.write.mode("append").format("parquet").insertInto(table) \
            if spark.catalog.tableExists(table) else new.write.format("parquet").saveAsTable(table)
    return n


def build_star(spark: SparkSession, feeds: dict[str, DataFrame],
               calendar: tuple[str, str] = ("2024-12-01 00:00:00", "2024-12-31 23:59:00"),
               holidays=dims.DEFAULT_HOLIDAYS, parallel: bool = True) -> dict[str, int]:
    """Create the tables if missing, add new dimension rows, replace the fact.
    Returns the number of rows added per table (fact: rows written).

    The five dimensions are independent jobs; with ``parallel`` they are
    submitted from separate driver threads and run side by side with the
    fact, as the reference runs its feed chains in parallel.
    """
    from concurrent.futures import ThreadPoolExecutor

    ensure_checkpoint_dir(spark)
    lake.create_dims(spark)
    c, p, pr, w = feeds["consumption"], feeds["production"], feeds["price"], feeds["weather"]
    builders = {
        "unit_DIMEN": lambda ex: dims.build_unit_dim(c, pr, p, ex),
        "weather_condition_DIMEN": lambda ex: dims.build_condition_dim(w, ex),
        "energy_type_DIMEN": lambda ex: dims.build_energy_dim(p, ex),
        "bidding_zone_DIMEN": lambda ex: dims.build_zone_dim(spark, ex),
        "timestamp_DIMEN": lambda ex: dims.build_timestamp_dim(
            dims.calendar_bounds(spark, *calendar), holidays=holidays, existing=ex),
    }

    def run_dim(table: str) -> int:
        return _upsert(spark, table, builders[table](_existing(spark, table)))

    def run_fact() -> int:
        lake.write_fact(build_fact(c, p, pr, w))
        return spark.table("measurements_FACT").count()

    if not parallel:
        added = {t: run_dim(t) for t in builders}
        added["measurements_FACT"] = run_fact()
        return added
    with ThreadPoolExecutor(max_workers=len(builders) + 1) as pool:
        futures = {t: pool.submit(run_dim, t) for t in builders}
        futures["measurements_FACT"] = pool.submit(run_fact)
        return {t: f.result() for t, f in futures.items()}


def build_clean_layer(spark: SparkSession, feeds: dict[str, DataFrame]) -> dict[str, int]:
    """The clean layer as tables — ``weather_cleaned`` (P1, already the
    feed's shape) and the three zone-enriched feeds (J1), replaced per run."""
    from voltlake.plans.clean import add_bzn
    out = {"weather_cleaned": feeds["weather"]}
    for name in ("price", "production", "consumption"):
        out[f"{name}_cleaned"] = add_bzn(feeds[name], feeds["weather"])
    counts = {}
    for table, df in out.items():
        df.write.mode("overwrite").format("parquet").saveAsTable(table)
        counts[table] = spark.table(table).count()
    return counts
