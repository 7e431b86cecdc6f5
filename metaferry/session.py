"""Spark settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Run-time re-planning: skewed join partitions are split, small ones merged. The
# size of a broadcast side is left to Spark to check.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even if that costs one more shuffle behind the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # JSON objects with a repeated key are valid; the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(name: str, cpus: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in CLUSTER_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
