"""SQL text of the column expressions.

A wide projection is sent to Spark as one list of texts (``selectExpr``), where
building each column object by object costs a round trip per node.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame

from txnrisk.schemas import TS_FORMAT, USER_PREFIX

# ``TS_FORMAT`` to the letter: no sign, no blank around it, no line end after it.
TS_PATTERN = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"


def name(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def strip_prefix(c: str, prefix: str = USER_PREFIX, anchored: bool = True) -> str:
    pattern = ("^" if anchored else "") + re.escape(prefix)
    return f"regexp_replace({name(c)}, {literal(pattern)}, '')"


def clean_user_id(c: str, prefix: str = USER_PREFIX, anchored: bool = True) -> str:
    return f"try_cast({strip_prefix(c, prefix, anchored)} AS int)"


def normalize_category(c: str, collapse: bool = True) -> str:
    if collapse:
        return f"regexp_replace(lower({name(c)}), {literal(r'[\s-]+')}, '_')"
    return f"translate(lower({name(c)}), ' -', '__')"


def parse_ts(c: str, fmt: str = TS_FORMAT) -> str:
    """Text in the default format goes through a cast, which is several times faster than a format; all other
    text, and what the cast refuses, through the format."""
    parsed = f"try_to_timestamp({name(c)}, {literal(fmt)})"
    if fmt != TS_FORMAT:
        return parsed
    return f"coalesce(CASE WHEN {name(c)} RLIKE {literal(TS_PATTERN)} THEN try_cast({name(c)} AS timestamp) END, {parsed})"


def calendar_features(c: str) -> dict[str, str]:
    return {f: f"{f}({name(c)})" for f in ("hour", "dayofweek", "dayofmonth")}


def hash_bucket(c: str, buckets: int = 100) -> str:
    prefix = f"substring(md5(cast({name(c)} AS string)), 1, 8)"
    return f"cast(cast(conv({prefix}, 16, 10) AS bigint) % {buckets} AS int)"


def hot(c: str, label: str, dtype: str = "int") -> str:
    """1 where the label matches, 0 for every other value and for null."""
    return f"cast(CASE WHEN {name(c)} = {literal(label)} THEN 1 ELSE 0 END AS {dtype})"


def linear_score(coefficients: Mapping[str, float], intercept: float = 0.0) -> str:
    terms = [f"{float(intercept)!r}D"]
    terms += [f"cast({name(c)} AS double) * {float(w)!r}D" for c, w in coefficients.items()]
    return f"1.0D / (1.0D + exp(-({' + '.join(terms)})))"


def with_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Replace or add columns given as SQL text, all in one projection."""
    kept = df.columns
    changed = [f"{columns[c]} AS {name(c)}" if c in columns else name(c) for c in kept]
    added = [f"{sql} AS {name(c)}" for c, sql in columns.items() if c not in kept]
    return df.selectExpr(*changed, *added)
