"""Session settings the operators are tuned for. Master, memory and cores are the caller's."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Calendar features and text timestamps are read in one zone everywhere.
    "spark.sql.session.timeZone": "UTC",
    # Partition sizes, join types and skewed partitions are settled at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The JVM does not compile methods beyond 8000 bytes of code. Wide projections (one-hot
    # columns, typed raw rows) pass that in one fused method; below the limit Spark splits them.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the settings to a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
