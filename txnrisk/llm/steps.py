"""Tables of one run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnrisk.llm.common import remove, scratch_path


class Steps:
    """Named tables in the shared folder, removed as soon as they are no longer needed."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` as ``name`` and read it back; an earlier table of that name goes."""
        path = scratch_path(self.spark, f"{self.label}-{name}")
        df.write.parquet(path)
        old, self.paths[name] = self.paths.get(name), path
        if old:
            remove(self.spark, old)
        return self.get(name)

    def get(self, *names: str) -> DataFrame:
        """A table, or several of the same columns as one."""
        return self.spark.read.parquet(*(self.paths[n] for n in names))

    def drop(self, *names: str) -> None:
        remove(self.spark, *(self.paths.pop(n) for n in names if n in self.paths))
