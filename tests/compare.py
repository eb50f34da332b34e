"""Run a registered query and its SQL, and compare them as bags of rows."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def value(v: object) -> object:
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, Decimal)):
        return round(float(v), 6)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def rows_of(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(value(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, sf_dir: str, query, sql: str, con) -> str | None:
    """None when equal, else a description of the first differences."""
    df = query(spark, sf_dir)
    got_rows = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want_rows = cursor.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(set(df.columns) ^ set(columns))}"
    got, want = rows_of(df.columns, got_rows), rows_of(columns, want_rows)
    if got == want:
        return None if want_rows else "no rows on either side"
    more, less = list((got - want).items())[:2], list((want - got).items())[:2]
    return f"{len(got_rows)} rows, SQL {len(want_rows)}; only here {more}; only SQL {less}"
