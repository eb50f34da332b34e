"""What the operators share: shipping code, UDF columns, words, staged tables."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.sources.scratch import scratch_path, stage

__all__ = ["count_rows", "free_name", "remove", "scratch_path", "ship", "stage", "table", "with_fields"]

_SHIPPED: set[str] = set()


BATCH_ROWS = 1000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once for each application.

    Also lowers the session's rows in an Arrow batch: rows here are whole texts, and what is made
    of them is larger still.
    """
    if not 0 < int(spark.conf.get(BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="txnrisk-code-"), "txnrisk_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(application)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(columns: Iterable[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column has that name in any case."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def with_fields(df: DataFrame, fields: Column, names: Sequence[str]) -> DataFrame:
    """Append the named fields of a struct. Columns of ``df`` with such a name are replaced."""
    own = {n.lower() for n in names}
    packed = free_name([*df.columns, *names], "fields")
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in own]
    return df.withColumn(packed, fields).select(*kept, *(F.col(packed)[n].alias(n) for n in names))


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders of intermediate tables."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def count_rows(df: DataFrame) -> int:
    """Rows of a staged table, from the files' footers."""
    return df.agg(F.count(F.lit(1)).alias("n")).first()["n"]
