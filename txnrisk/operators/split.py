"""Splits of a table into named parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.functions import hash_bucket
from txnrisk.operators.ordering import label_by_rank

# Shares of the load parts; the last part is the remainder.
TIME_PARTS = (("full", 0.60), ("incremental", 0.20), ("stream", None))


def time_split(
    df: DataFrame, keys: Sequence[str] = ("timestamp", "transaction_id"), name: str = "split", **options: int
) -> DataFrame:
    """Label rows full / incremental / stream by position in time.

    Cut positions are ``int(0.60 n)`` and ``int(0.20 n)`` rows later; null times come last.
    """
    total = df.count()
    cuts, at = [], 0
    for _, share in TIME_PARTS[:-1]:
        at += int(total * share)
        cuts.append(at)
    return label_by_rank(df, keys, cuts, [part for part, _ in TIME_PARTS], name, total, **options)


def hash_split(df: DataFrame, key: str = "transaction_id", train_percent: int = 70, name: str = "is_train") -> DataFrame:
    """Repeatable train/test flag from the id."""
    return df.withColumn(name, hash_bucket(key) < train_percent)


def random_split(df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int = 42) -> list[DataFrame]:
    """Spark's seeded random split. Its result depends on partitioning: prefer ``hash_split``."""
    return df.randomSplit(list(weights), seed=seed)
