"""Tables that are replaced as one: written anew, then swapped by a single change of the catalog."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from txnrisk.functions import text
from txnrisk.sources.scratch import remove

MAIN, CURRENT, BEFORE = "table", "version", "version_before"


@dataclass(frozen=True)
class VersionedTable:
    """A catalog view over the current version: a folder of its own with the table and its companions.

    A version is complete before the view points to it, and the view changes in one statement. So readers
    see the old tables or the new ones, always of the same version, whichever write fails. The version
    before stays for readers that have begun; older ones go.
    """

    name: str
    root: str

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def newest(self, spark: SparkSession, column: str) -> DataFrame:
        return self.read(spark).select(column)

    def exists(self, spark: SparkSession) -> bool:
        return spark.catalog.tableExists(self.name)

    def version(self, spark: SparkSession, which: str = CURRENT) -> str | None:
        """Folder of a version, as the view has it."""
        if not self.exists(spark):
            return None
        rows = spark.sql(f"SHOW TBLPROPERTIES {self.quoted}").collect()
        return {r["key"]: r["value"] for r in rows}.get(which)

    def companion(self, spark: SparkSession, part: str) -> DataFrame:
        """A table that was published together with the current one."""
        return spark.read.parquet(f"{self.version(spark)}/{part}")

    def publish(self, parts: Mapping[str, DataFrame], partition_by: Sequence[str] = ()) -> None:
        """Write all parts (``table`` and any companions) as a new version and point to it."""
        spark = parts[MAIN].sparkSession
        before, oldest = self.version(spark), self.version(spark, BEFORE)
        folder = f"{self.root.rstrip('/')}/{uuid.uuid4().hex}"
        try:
            for part, df in parts.items():
                df.write.partitionBy(*(partition_by if part == MAIN else ())).parquet(f"{folder}/{part}")
            self.point(spark, folder, before)
        except BaseException:
            if self.version(spark) != folder:
                remove(spark, folder)
            raise
        if oldest and oldest not in (folder, before):
            remove(spark, oldest)

    def point(self, spark: SparkSession, folder: str, before: str | None) -> None:
        properties = f"{text.literal(CURRENT)} = {text.literal(folder)}"
        if before:
            properties += f", {text.literal(BEFORE)} = {text.literal(before)}"
        source = text.name(f"{folder}/{MAIN}")
        spark.sql(f"CREATE OR REPLACE VIEW {self.quoted} TBLPROPERTIES ({properties}) AS SELECT * FROM parquet.{source}")

    def overwrite(self, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        self.publish({MAIN: df}, partition_by)

    def append(self, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Add rows to the current version."""
        spark = df.sparkSession
        folder = self.version(spark)
        if folder is None:
            self.overwrite(df, partition_by)
            return
        df.write.mode("append").partitionBy(*partition_by).parquet(f"{folder}/{MAIN}")
        spark.catalog.refreshByPath(f"{folder}/{MAIN}")

    @property
    def quoted(self) -> str:
        return ".".join(text.name(part) for part in self.name.split("."))


@dataclass(frozen=True)
class Companion:
    """A companion as a table that jobs read; it is only ever written with its table."""

    table: VersionedTable
    part: str

    def read(self, spark: SparkSession) -> DataFrame:
        return self.table.companion(spark, self.part)
