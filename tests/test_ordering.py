from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txnrisk.operators import ordering, split

# Few distinct values, so that one key often holds a third of the rows.
KEYS = st.tuples(st.none() | st.integers(0, 3), st.none() | st.sampled_from("abcdef"))
ROWS = st.lists(KEYS, min_size=1, max_size=40)
RUNS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def last(key):
    """Sort key: nulls last."""
    return [(k is None, k or 0) if k is None or isinstance(k, int) else (False, k) for k in key]


def frame(spark, rows):
    return spark.createDataFrame([(t, i, n) for n, (t, i) in enumerate(rows)], "t int, i string, n int")


def values(spark, key):
    return tuple(spark.range(1).select(*key.values).first())


@RUNS
@given(rows=ROWS, data=st.data())
def test_key_at_rank_equals_sorting(spark, rows, data):
    rank = data.draw(st.integers(0, len(rows) - 1))
    expected = sorted(rows, key=last)[rank]
    got = ordering.key_at_rank(frame(spark, rows), ["t", "i"], rank, small=2, pivots=3)
    assert values(spark, got) == expected
    assert got.before == sum(last(r) < last(expected) for r in rows)
    assert got.copies == rows.count(expected)


@RUNS
@given(rows=ROWS)
def test_ordered_index_numbers_every_row_once_and_in_order(spark, rows):
    got = ordering.ordered_index(frame(spark, rows), ["t", "i"]).orderBy("row_index").collect()
    assert [r["row_index"] for r in got] == list(range(len(rows)))
    assert [(r["t"], r["i"]) for r in got] == sorted(rows, key=last)
    assert sorted(r["n"] for r in got) == list(range(len(rows)))


@RUNS
@given(rows=ROWS, start=st.integers(-1, 45))
def test_rows_from_index_keeps_the_tail(spark, rows, start):
    got = ordering.rows_from_index(frame(spark, rows), ["t", "i"], start, small=2, pivots=3).collect()
    assert sorted(((r["t"], r["i"]) for r in got), key=last) == sorted(rows, key=last)[max(start, 0) :]


@RUNS
@given(rows=ROWS, offset=st.integers(0, 45), limit=st.integers(1, 10), small=st.sampled_from([0, 5, 1000]))
def test_pages_equal_slices(spark, rows, offset, limit, small):
    got = ordering.page_by_offset(frame(spark, rows), ["t", "i"], offset, limit, small=small).collect()
    assert [(r["t"], r["i"]) for r in got] == sorted(rows, key=last)[offset : offset + limit]


def test_keyset_pages_cover_the_table_once(spark):
    rows = [(n % 3, chr(97 + n)) for n in range(20)]
    df, last, seen = frame(spark, rows), None, []
    while page := ordering.page_after(df, ["t", "i"], last, 6).collect():
        seen += [(r["t"], r["i"]) for r in page]
        last = seen[-1]
    assert seen == sorted(rows)


@RUNS
@given(rows=ROWS, small=st.sampled_from([0, 1000]))
def test_time_split_sizes_with_ties(spark, rows, small):
    labelled = split.time_split(frame(spark, rows), ["t", "i"], small=small, pivots=3)
    parts = dict(labelled.groupBy("split").count().collect())
    n = len(rows)
    first, second = int(n * 0.6), int(n * 0.2)
    expected = {"full": first, "incremental": second, "stream": n - first - second}
    assert parts == {k: v for k, v in expected.items() if v}


def test_copies_of_one_key_spread_over_tasks(spark):
    """All rows tie: the input partition must still split them."""
    df = spark.range(0, 8000, 1, 8).selectExpr("1 AS k", "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        indexed = ordering.ordered_index(df, ["k"]).orderBy("row_index")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r["row_index"] for r in indexed.select("row_index").collect()] == list(range(8000))
    assert len(indexed.inputFiles()) >= 4


def test_many_ranks_share_one_search(spark):
    df = spark.range(5000).selectExpr("timestamp_seconds(id % 7) AS t", "id AS i")
    ranks = [0, 1, 713, 714, 4999]
    got = ordering.keys_at_ranks(df, ["t", "i"], ranks, small=10, pivots=5)
    keys = sorted((n % 7, n) for n in range(5000))
    for r in ranks:
        seconds, i = spark.range(1).select(got[r].values[0].cast("long"), got[r].values[1]).first()
        assert (seconds, i) == keys[r]
        assert got[r].before == r


SKETCHED = st.tuples(st.none() | st.integers(-3, 3), st.none() | st.integers(-(2**62), 2**62) | st.integers(0, 2))


@RUNS
@given(rows=st.lists(SKETCHED, min_size=1, max_size=60), data=st.data(), pivots=st.integers(1, 9))
def test_sketched_pivots_find_every_rank(spark, rows, data, pivots):
    """Ties, nulls and negative numbers, with both keys narrowed by their sketches."""
    ranks = data.draw(st.lists(st.integers(0, len(rows) - 1), min_size=1, max_size=4))
    df = spark.createDataFrame([(*r, "p") for r in rows], "a long, b long, p string")
    df = df.selectExpr("date_from_unix_date(cast(a AS int)) AS d", "b")
    ordered = sorted(rows, key=last)
    got = ordering.keys_at_ranks(df, ["d", "b"], ranks, small=1, pivots=pivots)
    for rank in ranks:
        day, number = got[rank].values
        assert tuple(spark.range(1).select(F.unix_date(day), number).first()) == ordered[rank]
        assert got[rank].before == sum(last(r) < last(ordered[rank]) for r in rows)


def test_one_count_narrows_a_table_to_fifty_rows(spark, monkeypatch):
    sketches, sketched = [], ordering._sketched

    def counted(span, rows, *others):
        sketches.append(rows)
        return sketched(span, rows, *others)

    monkeypatch.setattr(ordering, "_sketched", counted)
    df = spark.range(0, 100_000, 1, 8).selectExpr("timestamp_seconds(hash(id) % 1000000) AS t", "id AS i")
    wanted = sorted((r["s"], r["i"]) for r in df.selectExpr("unix_seconds(t) AS s", "i").collect())[60_000]
    found = ordering.key_at_rank(df, ["t", "i"], 60_000, small=50)
    assert tuple(spark.range(1).select(F.unix_seconds(found.values[0]), found.values[1]).first()) == wanted
    assert found.before == 60_000
    assert sketches == [100_000]


def test_rank_outside_the_table_is_refused(spark):
    with pytest.raises(ValueError, match="not all inside"):
        ordering.key_at_rank(spark.range(3), ["id"], 3)


def test_hash_split_ignores_partitioning(spark):
    df = spark.range(2000).selectExpr("concat('T', id) AS transaction_id")
    one = set(split.hash_split(df.coalesce(1)).where("is_train").toPandas()["transaction_id"])
    many = set(split.hash_split(df.repartition(16)).where("is_train").toPandas()["transaction_id"])
    assert one == many
    assert 0.65 < len(one) / 2000 < 0.75


def test_random_split_is_whole(spark):
    train, test = split.random_split(spark.range(1000))
    assert train.count() + test.count() == 1000
