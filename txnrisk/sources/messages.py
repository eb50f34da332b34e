"""Message topics as streaming or batch frames of ``key`` and ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def topic_options(servers: str, topic: str, starting: str = "earliest", **extra: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, **extra}


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**options).load()


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish a batch of ``key``, ``value`` rows."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """A folder of files as a stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
