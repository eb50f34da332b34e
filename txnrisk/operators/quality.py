"""Row quality: header rows, duplicates, nulls, rejected values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnrisk.functions.text import literal, name, parse_ts
from txnrisk.schemas import HEADER_ID, RAW_FIELDS


def filter_header(df: DataFrame, column: str = "transaction_id", header: str = HEADER_ID) -> DataFrame:
    """Drop header lines that were read as data. Rows without an id go too."""
    return df.where(F.col(column) != F.lit(header))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Keep one of each set of identical rows.

    The aggregate combines copies before the shuffle, so a row that makes up a
    third of the table reaches its reducer once per map task.
    """
    return df.dropDuplicates()


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any column.

    One condition per column, where ``na.drop`` has a single one over all of them:
    these reach the scan, and planning time stays linear in the number of columns.
    """
    wanted = list(columns or df.columns)
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    tests = [f"{name(c)} IS NOT NULL" for c in wanted]
    tests += [f"NOT isnan({name(c)})" for c in wanted if c in floating]
    return df.where(" AND ".join(tests))


def clean_rows(df: DataFrame, column: str = "transaction_id", header: str = HEADER_ID) -> DataFrame:
    """Header filter, null drop and duplicate drop; the narrow steps run before the shuffle."""
    return drop_duplicate_rows(drop_null_rows(filter_header(df, column, header)))


def null_rejects(
    df: DataFrame, column: str = "transaction_id", header: str = HEADER_ID, extra: Sequence[Column] = ()
) -> DataFrame:
    """The distinct rows that ``clean_rows`` drops for a null (or NaN), with the columns as reason.

    ``extra`` are further reasons, null where they do not hold. Clean rows, rejects, header rows, rows without
    an id, and copies add up to the input.
    """
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    tests = []
    for c in df.columns:
        bad = f"{name(c)} IS NULL" + (f" OR isnan({name(c)})" if c in floating else "")
        tests.append(f"CASE WHEN {bad} THEN {literal('no ' + c)} END")
    reason = F.concat_ws("; ", *map(F.expr, tests), *extra)
    rows = filter_header(df, column, header).withColumn("reason", reason)
    return drop_duplicate_rows(rows.where("reason <> ''"))


def fill_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(defaults))


def null_profile(df: DataFrame) -> DataFrame:
    """One row with the number of nulls in each column."""
    return df.selectExpr(*[f"count_if({name(c)} IS NULL) AS {name(c)}" for c in df.columns])


def dup_profile(df: DataFrame) -> DataFrame:
    """Total, distinct and duplicate row counts from one grouping."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    total = F.coalesce(F.sum("copies"), F.lit(0))
    return groups.agg(
        total.alias("total_rows"),
        F.count("*").alias("distinct_rows"),
        (total - F.count("*")).alias("duplicate_rows"),
    )


def _typed(column: str, stored: str) -> str:
    if stored == "string":
        return name(column)
    if stored == "timestamp":
        return parse_ts(column)
    return f"try_cast({name(column)} AS {stored})"


def type_rows(df: DataFrame) -> DataFrame:
    """Landing text to the stored types. Values that do not parse become null."""
    present = set(df.columns)
    return df.selectExpr(
        *[f"{_typed(f.name, f.stored)} AS {name(f.name)}" for f in RAW_FIELDS if f.name in present]
    )


def type_rejects(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Landing rows whose text in ``columns`` is present but does not parse, with a reason each."""
    stored = {f.name: f.stored for f in RAW_FIELDS}
    tests = [
        f"CASE WHEN {name(c)} IS NOT NULL AND {_typed(c, stored[c])} IS NULL THEN {literal('bad ' + c)} END"
        for c in columns
    ]
    return df.selectExpr("*", f"concat_ws('; ', {', '.join(tests)}) AS reason").where("reason <> ''")
