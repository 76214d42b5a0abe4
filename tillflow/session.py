"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC makes DATE(timestamp) independent of the machine.  Adaptive execution
# picks broadcast joins from measured sizes, splits skewed join partitions and
# merges small shuffle partitions, so no operator hard-codes a strategy.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "tillflow", master: str | None = None,
                  **extra: str) -> SparkSession:
    """A session with the package defaults; ``extra`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in extra.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
