"""Column expressions over a named column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from txnrisk.functions import text
from txnrisk.schemas import TS_FORMAT, USER_PREFIX


def strip_prefix(c: str, prefix: str = USER_PREFIX, anchored: bool = True) -> Column:
    """Remove ``prefix`` once at the start, or everywhere when not anchored."""
    return F.expr(text.strip_prefix(c, prefix, anchored))


def clean_user_id(c: str, prefix: str = USER_PREFIX, anchored: bool = True) -> Column:
    """Numeric user id; text that is no number becomes null instead of failing the job."""
    return F.expr(text.clean_user_id(c, prefix, anchored))


def normalize_category(c: str, collapse: bool = True) -> Column:
    """Lower case with blanks and hyphens as ``_``; runs become one ``_`` when collapsing."""
    return F.expr(text.normalize_category(c, collapse))


def parse_ts(c: str, fmt: str = TS_FORMAT) -> Column:
    """Timestamp from text; text in another format becomes null."""
    return F.expr(text.parse_ts(c, fmt))


def calendar_features(c: str) -> dict[str, Column]:
    """Hour, day of week (1 is Sunday) and day of month, by column name."""
    return {n: F.expr(sql) for n, sql in text.calendar_features(c).items()}


def round_array(c: str, digits: int = 2, is_vector: bool = True) -> Column:
    """Round each element of a vector (or array) column."""
    values = vector_to_array(c) if is_vector else F.col(c)
    return F.transform(values, lambda x: F.round(x, digits))


def hash_bucket(c: str, buckets: int = 100) -> Column:
    """Bucket in ``0..buckets-1`` from an md5 prefix.

    It depends on the value only, so a row keeps its bucket however the table is
    partitioned or recomputed after an executor loss.
    """
    return F.expr(text.hash_bucket(c, buckets))


def linear_score(coefficients: Mapping[str, float], intercept: float = 0.0) -> Column:
    """Logistic score ``1 / (1 + exp(-(intercept + sum(coefficient * column))))``."""
    return F.expr(text.linear_score(coefficients, intercept))
