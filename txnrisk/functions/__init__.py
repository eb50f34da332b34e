"""Column expressions. All are Spark built-ins: no Python runs per row."""

from txnrisk.functions import text
from txnrisk.functions.scalars import (
    calendar_features,
    clean_user_id,
    hash_bucket,
    linear_score,
    normalize_category,
    parse_ts,
    round_array,
    strip_prefix,
)

__all__ = [
    "calendar_features",
    "clean_user_id",
    "hash_bucket",
    "linear_score",
    "normalize_category",
    "parse_ts",
    "round_array",
    "strip_prefix",
    "text",
]
