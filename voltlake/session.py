"""Session settings the library relies on.

Timestamps are zone-less (TIMESTAMP_NTZ) end to end, and every time helper in
``voltlake.functions.timefn`` is written without session-zone conversions, so
results do not depend on the session zone; UTC is still set for readability.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings applied to sessions this package creates. On a cluster these belong
# in the submit configuration; ``configure`` applies only what is unset.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "voltlake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Set and return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    There is no fallback: a folder of one machine would lose the data with it,
    so a session without the setting is an error. Tests and the benchmark name
    a scratch folder of their own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
