"""A Spark session with the settings this package is tested under."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Static sizing (executors, memory, shuffle partitions) is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Recording the call site of every expression slows down planning.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(app: str = "mercastar", master: str | None = None, **extra: str) -> SparkSession:
    """Build (or reuse) a session; `extra` settings use `__` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
