"""Session settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution starts from many small shuffle partitions and merges them to
# the advisory size, splits skewed join partitions, and picks broadcasts by the
# measured size of a side.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
}


def builder(app_name: str, shuffle_partitions: int | None = None) -> SparkSession.Builder:
    """A builder with these settings.

    On a cluster, give `shuffle_partitions` as the largest shuffle divided by the
    advisory size (100 TB: some hundred thousand); smaller shuffles are merged.
    """
    configured = SparkSession.builder.appName(app_name)
    for name, value in SETTINGS.items():
        configured = configured.config(name, value)
    if shuffle_partitions:
        configured = configured.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return configured
