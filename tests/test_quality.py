from __future__ import annotations

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txnrisk.functions import clean_user_id, normalize_category, parse_ts, strip_prefix, text
from txnrisk.operators import incremental, quality
from txnrisk.plans.fixtures import landing

DDL = "transaction_id string, x int, y double"
CELL = st.tuples(
    st.sampled_from(["a", "b", "Transaction_ID", None]), st.sampled_from([1, 2, None]), st.sampled_from([0.5, None])
)
RUNS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@RUNS
@given(rows=st.lists(CELL, max_size=30))
def test_cleaning_equals_plain_python(spark, rows):
    got = quality.clean_rows(spark.createDataFrame(rows, DDL)).collect()
    want = {r for r in rows if None not in r and r[0] != "Transaction_ID"}
    assert len(got) == len(want)
    assert {tuple(r) for r in got} == want


@RUNS
@given(rows=st.lists(CELL, max_size=30))
def test_profiles_equal_plain_python(spark, rows):
    df = spark.createDataFrame(rows, DDL)
    assert tuple(quality.dup_profile(df).first()) == (len(rows), len(set(rows)), len(rows) - len(set(rows)))
    assert tuple(quality.null_profile(df).first()) == tuple(sum(r[i] is None for r in rows) for i in range(3))


def test_nan_counts_as_null_when_dropping(spark):
    df = spark.createDataFrame([("a", 1, float("nan")), ("b", 1, 1.0)], DDL)
    assert [r[0] for r in quality.drop_null_rows(df).collect()] == ["b"]
    assert quality.drop_null_rows(df, ["x"]).count() == 2


def test_dropping_nulls_of_many_columns_plans_quickly(spark):
    """Planning must not grow exponentially with the number of typed columns."""
    wide = spark.range(5).selectExpr(*[f"cast(id + {i} AS string) AS c{i}" for i in range(40)])
    typed = wide.selectExpr(*[f"try_cast(c{i} AS int) AS c{i}" for i in range(40)])
    assert quality.drop_null_rows(typed).distinct().count() == 5


def test_user_ids(spark):
    df = spark.createDataFrame([("USER_7",), ("USER_USER_7",), ("x7",), ("7",), (None,)], "u string")
    got = df.select(strip_prefix("u"), clean_user_id("u"), clean_user_id("u", anchored=False)).collect()
    assert [tuple(r) for r in got] == [
        ("7", 7, 7),
        ("USER_7", None, 7),
        ("x7", None, None),
        ("7", 7, 7),
        (None, None, None),
    ]


def test_category_cleaning(spark):
    df = spark.createDataFrame([("ATM Withdrawal",), ("New - York",), ("Smart-TV",)], "c string")
    assert [r[0] for r in df.select(normalize_category("c")).collect()] == ["atm_withdrawal", "new_york", "smart_tv"]
    assert [r[0] for r in df.select(normalize_category("c", collapse=False)).collect()][1] == "new___york"


def test_literals_and_names_are_escaped(spark):
    odd = "it's a \\ `tick`"
    row = spark.range(1).selectExpr(f"{text.literal(odd)} AS {text.name(odd)}").first()
    assert row[odd] == odd


def test_fill_nulls(spark):
    df = spark.createDataFrame([(None, None, None)], DDL)
    assert tuple(quality.fill_nulls(df, {"transaction_id": "Unknown", "x": 0}).first()) == ("Unknown", 0, None)


def test_type_rejects_name_each_bad_column(spark):
    df = spark.createDataFrame([("t1", "2024-01-01T00:00:00Z", "x"), ("t2", "2024-01-01 00:00:00", None)],
                               "transaction_id string, timestamp string, card_age string")
    got = quality.type_rejects(df, ["timestamp", "card_age"]).collect()
    assert [(r["transaction_id"], r["reason"]) for r in got] == [("t1", "bad timestamp; bad card_age")]


def stamps(spark, *seconds):
    rows = [(f"t{i}", None if s is None else dt.datetime(2024, 1, 1, 0, 0, s)) for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, "transaction_id string, timestamp timestamp")


def test_watermark_of_nothing_is_the_epoch(spark):
    for df in (stamps(spark, 1).limit(0), stamps(spark, None, None)):
        assert incremental.watermark(df).selectExpr("unix_seconds(last_ts)").first()[0] == 0


def test_ties_at_the_cut_are_kept_or_cut(spark):
    df = stamps(spark, 5, 1, 2, 2, 2, 9)
    strict = incremental.oldest_batch(df, "2024-01-01 00:00:00", limit=2)
    whole = incremental.oldest_batch(df, "2024-01-01 00:00:00", limit=2, with_ties=True)
    assert sorted(r[0] for r in strict.collect()) == ["t1", "t2"]
    assert sorted(r[0] for r in whole.collect()) == ["t1", "t2", "t3", "t4"]


def test_newer_than_is_strict(spark):
    assert [r[0] for r in incremental.newer_than(stamps(spark, 1, 2), "2024-01-01 00:00:01").collect()] == ["t1"]


def test_not_processed_finds_late_rows_and_keeps_copies(spark):
    df, done = stamps(spark, 1, 2, 3), stamps(spark, 9)
    got = incremental.not_processed(df.union(df), done.union(done))
    assert sorted(r[0] for r in got.collect()) == ["t1", "t1", "t2", "t2"]


def test_parse_ts_by_cast_equals_the_format(spark):
    """The cast takes text in the format to the letter; its results are those of the format for any text."""
    texts = [
        "2024-01-05 10:20:30", "2024-02-29 00:00:00", "0001-01-01 00:00:00", "1582-10-10 01:02:03", "9999-12-31 23:59:59",
        "2024-01-05T10:20:30Z", "2024-01-05", "2024-1-5 1:2:3", "+12024-01-05 10:20:30",
        "24-01-05 10:20:30", "٢024-01-05 10:20:30", "", "Timestamp", None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(parse_ts("t").alias("got"), F.expr("try_to_timestamp(t, 'yyyy-MM-dd HH:mm:ss')").alias("want"))
    assert got.where("NOT got <=> want").count() == 0 and got.where("got IS NOT NULL").count() >= 5
    assert "try_cast" in text.parse_ts("t") and "try_cast" not in text.parse_ts("t", "yyyy/MM/dd")


def test_landing_formats_times_by_constant_formats(spark, sf):
    """A computed format is looked up for every row."""
    times = landing(spark, sf).select("timestamp")._jdf.queryExecution().optimizedPlan().toString()
    assert "date_format(" in times and not re.search(r"date_format\([^,]*, CASE", times)
