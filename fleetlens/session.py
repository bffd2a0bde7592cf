"""Spark settings the library is meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC fixes what "the date of a timestamp" means.  AQE sizes shuffle partitions, splits skewed join
# partitions and picks a broadcast only after it has seen the real size of a side.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Checkpoints of a job's intermediate tables go when the job no longer refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(app: str, cores: str = "*", memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
