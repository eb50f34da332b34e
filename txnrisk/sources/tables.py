"""One interface for the tables that jobs read and write: a folder, a catalog name or a database."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.functions import text

MISSING = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}
NO_SUCH_OBJECT = "42"  # class of the SQL states for unknown tables and the like


def sql_state(error: BaseException) -> str:
    """SQL state of the database error behind a failed call; empty if there is none."""
    cause = getattr(error, "java_exception", None) or getattr(getattr(error, "_origin", None), "java_exception", None)
    while cause is not None:
        if hasattr(cause, "getErrorCode") and cause.getSQLState():
            return str(cause.getSQLState())
        cause = cause.getCause()
    return ""


NO_TIME = -(2**63)  # stands for null: row groups of nulls alone have no maximum, which the footer reader refuses


def footer_max(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row with the largest value of a whole-number column without nulls, from the statistics in the files' footers.

    No data page is read. It takes the newer Parquet reader, in a session of its own so that the caller's
    settings stay.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    return own.read.parquet(path).agg(F.max(column).alias(column))


@dataclass(frozen=True)
class PathTable:
    """A folder. ``micros`` names timestamp columns that are stored as whole microseconds, too: footers hold no
    usable maximum of a timestamp, but one of a number. Readers do not see those columns."""

    path: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    micros: Sequence[str] = ()

    def read(self, spark: SparkSession) -> DataFrame:
        return self._stored(spark).drop(*map(micros_of, self.micros))

    def _stored(self, spark: SparkSession) -> DataFrame:
        return spark.read.format(self.format).options(**self.options).load(self.path)

    def newest(self, spark: SparkSession, column: str) -> DataFrame:
        """Rows that hold the largest value of ``column``: one row from the footers where they know it, else
        all rows, read for that column only."""
        if self.format != "parquet" or column not in self.micros:
            return self._stored(spark).select(column)
        held = F.col(micros_of(column))
        return footer_max(spark, self.path, micros_of(column)).select(F.timestamp_micros(F.when(held > NO_TIME, held)).alias(column))

    def exists(self, spark: SparkSession) -> bool:
        """False for a missing or empty folder; any other failure is raised."""
        try:
            return bool(self.read(spark).columns)
        except AnalysisException as error:
            if error.getCondition() not in MISSING:
                raise
            return False

    def overwrite(self, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        self._write(df, "overwrite", partition_by)

    def append(self, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        self._write(df, "append", partition_by)

    def _write(self, df: DataFrame, mode: str, partition_by: Sequence[str]) -> None:
        stored = df.withColumns({micros_of(c): F.coalesce(F.unix_micros(c), F.lit(NO_TIME)) for c in self.micros})
        writer = stored.write.mode(mode).format(self.format).options(**self.options)
        writer.partitionBy(*partition_by).save(self.path)


def micros_of(column: str) -> str:
    return f"{column}__micros"


@dataclass(frozen=True)
class CatalogTable:
    name: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def newest(self, spark: SparkSession, column: str) -> DataFrame:
        return self.read(spark).select(column)

    def exists(self, spark: SparkSession) -> bool:
        return spark.catalog.tableExists(self.name)

    def overwrite(self, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        writer = df.write.mode("overwrite").format(self.format).options(**self.options)
        writer.partitionBy(*partition_by).saveAsTable(self.name)

    def append(self, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Append by column name: ``insertInto`` alone goes by position."""
        if not self.exists(df.sparkSession):
            self.overwrite(df, partition_by)
            return
        columns = self.read(df.sparkSession).columns
        df.select(*columns).write.insertInto(self.name)

    def add_partition(self, spark: SparkSession, values: Mapping[str, str], path: str | None = None) -> None:
        """Tell the catalog of a partition that another writer has finished. Only that one is looked at.

        A table whose partitions the catalog knows is read without listing its folder: a query lists
        the partitions that its filter leaves.
        """
        spec = ", ".join(f"{text.name(c)} = {text.literal(v)}" for c, v in values.items())
        at = f" LOCATION {text.literal(path)}" if path else ""
        spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS PARTITION ({spec}){at}")

    def recover_partitions(self, spark: SparkSession) -> None:
        """Take over all partitions that lie in the table's folder: one listing, after a backfill."""
        spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")


def partitioned_table(spark: SparkSession, name: str, path: str, ddl: str, partition_by: Sequence[str]) -> CatalogTable:
    """A Parquet table over a folder, without any partition yet."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet "
        f"PARTITIONED BY ({', '.join(map(text.name, partition_by))}) LOCATION {text.literal(path)}"
    )
    return CatalogTable(name)


@dataclass(frozen=True)
class BucketedTable:
    """A catalog table whose rows lie in ``buckets`` files by the hash of ``key``.

    Joins on the key read the buckets as they are: only the other side is shuffled, however long the
    history has grown.
    """

    name: str
    key: str
    buckets: int
    options: Mapping[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def newest(self, spark: SparkSession, column: str) -> DataFrame:
        return self.read(spark).select(column)

    def exists(self, spark: SparkSession) -> bool:
        return spark.catalog.tableExists(self.name)

    def overwrite(self, df: DataFrame) -> None:
        self._write(df, "overwrite")

    def append(self, df: DataFrame) -> None:
        """Append by column name. Rows are dealt by bucket first, so a run adds one file a bucket."""
        spark = df.sparkSession
        if self.exists(spark):
            df = df.select(*self.read(spark).columns)
        self._write(df.repartition(self.buckets, self.key), "append")

    def _write(self, df: DataFrame, mode: str) -> None:
        writer = df.write.mode(mode).format("parquet").options(**self.options)
        writer.bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(self.name)


@dataclass(frozen=True)
class JdbcTable:
    """A database table. Connection settings and the driver come from the caller."""

    url: str
    table: str
    options: Mapping[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("jdbc").options(**self.read_options()).load()

    def read_options(self) -> dict[str, str]:
        return {**self.options, "url": self.url, "dbtable": self.table}

    def range_options(self, column: str, lower: str, upper: str, partitions: int) -> dict[str, str]:
        """Options for a parallel read over ``lower..upper`` of ``column``.

        The bounds only set the strides. Starting them at the last loaded value keeps
        all partitions inside the new range.
        """
        return {
            **self.read_options(),
            "partitionColumn": column,
            "lowerBound": lower,
            "upperBound": upper,
            "numPartitions": str(partitions),
        }

    def read_newer(self, spark: SparkSession, column: str, last: str, upper: str, partitions: int = 8) -> DataFrame:
        """Rows above ``last``: the comparison is pushed to the database."""
        options = self.range_options(column, last, upper, partitions)
        rows = spark.read.format("jdbc").options(**options).load()
        return rows.where(F.col(column) > F.lit(last).cast("timestamp"))

    def max_options(self, column: str) -> dict[str, str]:
        """Options for reading only the largest value of ``column``: the database computes it."""
        query = f'SELECT MAX("{column}") AS "{column}" FROM {self.table}'
        return {**self.options, "url": self.url, "query": query}

    def newest(self, spark: SparkSession, column: str) -> DataFrame:
        return spark.read.format("jdbc").options(**self.max_options(column)).load()

    def exists(self, spark: SparkSession) -> bool:
        """False when the database says that there is no such table; an outage is raised."""
        try:
            return bool(self.read(spark).columns)
        except Exception as error:  # each database driver raises its own class for a missing table
            if not sql_state(error).startswith(NO_SUCH_OBJECT):
                raise
            return False

    def overwrite(self, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Replace the rows and keep the table definition."""
        self._write(df, "overwrite", truncate="true")

    def append(self, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        self._write(df, "append")

    def _write(self, df: DataFrame, mode: str, **extra: str) -> None:
        df.write.mode(mode).format("jdbc").options(**self.read_options(), **extra).save()


Table = PathTable | CatalogTable | BucketedTable | JdbcTable


def scan(spark: SparkSession, table: str, where: str | Column | None = None, columns: Sequence[str] = ()) -> DataFrame:
    """Catalog table by name with an optional SQL predicate and projection; both reach the scan."""
    df = spark.table(table)
    df = df.where(where) if where is not None else df
    return df.select(*columns) if columns else df
