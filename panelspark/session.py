"""Session settings sized from the data."""

from __future__ import annotations

from pyspark.sql import SparkSession

PARTITION_BYTES = 128 * 1024 * 1024


def scale_settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for reading ``input_bytes`` on ``cores``.

    Shuffles get enough partitions for about 128 MB each (at least two per core); adaptive
    execution merges those that turn out small and splits skewed ones.  Only sides measured
    below 64 MB are broadcast.
    """
    partitions = max(2 * cores, -(-input_bytes // PARTITION_BYTES))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.files.maxPartitionBytes": str(2 * PARTITION_BYTES),
        "spark.sql.shuffle.partitions": str(partitions),
    }


def apply_settings(spark: SparkSession, input_bytes: int, cores: int) -> SparkSession:
    """Set them on a running session; all are runtime settings."""
    for name, value in scale_settings(input_bytes, cores).items():
        spark.conf.set(name, value)
    return spark
