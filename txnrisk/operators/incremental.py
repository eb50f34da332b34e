"""Finding the rows that are new since the last run."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.schemas import EPOCH

BATCH = 1000  # fixed value: rows per increment


def watermark(df: DataFrame, ts: str = "timestamp", name: str = "last_ts") -> DataFrame:
    """One row with the largest timestamp, or the epoch for an empty or all-null table."""
    return df.agg(F.coalesce(F.max(ts), F.lit(EPOCH).cast("timestamp")).alias(name))


def watermark_value(df: DataFrame, ts: str = "timestamp") -> Column:
    """The watermark as a literal, so that a filter on it can prune partitions and row groups.

    One number comes to the driver; microseconds avoid any time zone round trip.
    """
    micros = watermark(df, ts).select(F.unix_micros("last_ts")).first()[0]
    return F.timestamp_micros(F.lit(micros))


def newer_than(df: DataFrame, last: Column | datetime | str, ts: str = "timestamp") -> DataFrame:
    """Rows strictly after ``last``. The column stays bare, so the filter reaches the scan."""
    bound = last if isinstance(last, Column) else F.lit(last).cast("timestamp")
    return df.where(F.col(ts) > bound)


def oldest_batch(
    df: DataFrame,
    last: Column | datetime | str,
    limit: int = BATCH,
    ts: str = "timestamp",
    ties: Sequence[str] = ("transaction_id",),
    with_ties: bool = False,
) -> DataFrame:
    """The ``limit`` oldest rows after ``last``.

    ``with_ties`` adds the rows that share the last timestamp. Without it a later run
    that starts strictly after that timestamp would never load them.
    """
    fresh = newer_than(df, last, ts)
    top = fresh.orderBy(ts, *ties).limit(limit)
    if not with_ties:
        return top
    return fresh.where(F.col(ts) <= watermark_value(top, ts))


def not_processed(df: DataFrame, done: DataFrame, keys: Sequence[str] = ("transaction_id",)) -> DataFrame:
    """Rows whose key is not in ``done``: late rows are found too.

    Only the keys of ``done`` are read. Both sides are shuffled right under the join, so
    adaptive execution can split the rows of a hot key in ``df``; copies of a key in
    ``done`` do no harm to an anti join and are not combined first.
    """
    return df.join(done.select(*keys), list(keys), "left_anti")


def row_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in columns])


def hashed_rows(df: DataFrame, columns: Sequence[str], key: str = "transaction_id") -> DataFrame:
    """Key and ``row_hash`` in place of the row, for callers that only count or look up rows."""
    return df.select(key, row_hash(columns).alias("row_hash"))


def not_seen(df: DataFrame, seen: DataFrame, columns: Sequence[str], key: str = "transaction_id") -> DataFrame:
    """Rows that are not in ``seen`` with the same values of ``columns``: other rows of the same key stay.

    ``seen`` may have more columns. Rows are compared by key and a hash of their values, so nulls match too.
    """
    digest = row_hash(columns)
    known = seen.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("__key"), digest.alias("__hash"))
    marked = df.withColumns({"__key": F.coalesce(F.col(key).cast("string"), F.lit("")), "__hash": digest})
    return marked.join(known, ["__key", "__hash"], "left_anti").drop("__key", "__hash")
