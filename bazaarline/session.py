"""Session settings."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings the plans count on. Sizes (memory, partitions) are the cluster's where it names them.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot key's partition in a join even if the next step then needs a shuffle:
    # without this, a join followed by a grouping on the same key keeps the hot task.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Compressed columns grow several times in memory. Taking file sizes for row sizes lets
    # the optimizer broadcast a side that is well over its broadcast limit.
    "spark.sql.sources.fileCompressionFactor": "4.0",
}

# Sizes where the cluster names none. A task that sorts and groups what it reads after a shuffle
# holds about twelve times its compressed bytes; with Spark's 64 MB that is 0.8 GB.
TASK_SIZES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the plans count on to a session, and the sizes of tasks that it does not name."""
    for key, value in PLAN_SETTINGS.items():
        spark.conf.set(key, value)
    for key, value in TASK_SIZES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def local_session(name: str, cpus: int | None = None, **settings: str) -> SparkSession:
    """A session on this machine, for tests, checks and measurements."""
    cores = cpus or os.cpu_count() or 1
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
