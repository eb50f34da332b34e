"""Delimited text and Parquet, with schemas given rather than inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from txnrisk.functions import text
from txnrisk.schemas import TS_FORMAT, WIRE_DDL, raw_schema


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Header CSV in the raw layout. Files stay splittable; a bad field becomes null."""
    reader = spark.read.schema(schema or raw_schema()).option("header", True)
    return reader.option("timestampFormat", TS_FORMAT).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode).option("header", True).option("timestampFormat", TS_FORMAT)
    writer.partitionBy(*partition_by).csv(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """With a schema no footer is read to plan the query."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode)
    writer.partitionBy(*partition_by).parquet(path)


def external_table(spark: SparkSession, name: str, path: str, ddl: str = WIRE_DDL) -> DataFrame:
    """Table over existing comma-delimited text whose first line in each file is a header.

    ``name`` may have parts separated by dots.
    """
    quoted = ".".join(text.name(part) for part in name.split("."))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted} ({ddl}) USING csv "
        f"OPTIONS (header 'true', sep ',', timestampFormat '{TS_FORMAT}') LOCATION {text.literal(path)}"
    )
    return spark.table(quoted)
