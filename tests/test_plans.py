"""What the physical plans must and must not contain."""

from __future__ import annotations

import shutil

import pytest

import __spark_entry__ as entry
from txnrisk.operators import incremental, ordering, quality
from txnrisk.plans import jobs, queries
from txnrisk.sources.scratch import stage

# Building these runs jobs; their steps are covered by the tests of streams and jobs.
LAZY = [
    "score_landing", "filter_header", "clean_rows", "fill_nulls", "null_profile", "dup_profile", "clean_user",
    "calendar", "label_vocab", "onehot_fixed", "unseen_labels", "incr_newer_than", "incr_topn", "incr_left_anti",
    "json_encode", "json_decode", "score_pinned", "score_join_back", "metric_auc", "metrics_report", "hash_split",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(txn):
    return stage(txn, "stored")


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, sf, name):
    text = plan(entry.queries()[name](spark, sf))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Arrow"):
        assert word not in text


def test_new_row_filter_reaches_the_scan(stored):
    text = plan(incremental.newer_than(stored, "2024-01-20 12:00:00"))
    assert "GreaterThan(timestamp," in text and "Exchange" not in text


def test_row_index_and_page_filters_reach_the_scan(stored):
    keys = ("timestamp", "transaction_id")
    n = stored.count()
    assert "GreaterThanOrEqual(timestamp," in plan(ordering.rows_from_index(stored, keys, n // 2))
    page = plan(ordering.page_by_offset(stored, keys, n // 2, 10, small=5))
    assert "GreaterThanOrEqual(timestamp," in page and "LessThanOrEqual(timestamp," in page
    assert "TakeOrderedAndProject" in plan(ordering.page_by_offset(stored, keys, 100, 10))


def test_cut_search_reads_only_the_keys(spark, stored):
    span = stored.select("timestamp", "transaction_id").groupBy("timestamp", "transaction_id").count()
    assert "ReadSchema: struct<transaction_id:string,timestamp:timestamp>" in plan(span)


def test_oldest_batch_is_a_top_k(stored):
    text = plan(incremental.oldest_batch(stored, "2024-01-20 12:00:00"))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_null_drop_reaches_the_scan(stored):
    assert "IsNotNull(location)" in plan(quality.drop_null_rows(stored, ["location"]))


def test_anti_join_reads_only_ids_of_done_rows(stored):
    text = plan(incremental.not_processed(stored, stored))
    assert "ReadSchema: struct<transaction_id:string>" in text


def test_anti_join_pre_aggregates_and_shares_its_shuffle(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(incremental.not_processed(stored, stored))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2


def test_duplicates_combine_before_the_shuffle(stored):
    text = plan(quality.drop_duplicate_rows(stored))
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_hot_key_of_the_anti_join_is_split(spark, tmp_path):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        keys = "CASE WHEN id % 3 > 0 THEN 'hot' ELSE concat('k', id) END AS transaction_id"
        rows = spark.range(0, 60000, 1, 8).selectExpr(keys, "uuid() AS payload")
        rows.write.parquet(str(tmp_path / "rows"))
        done = spark.range(0, 60000, 1, 8).where("id % 2 = 0").selectExpr("concat('k', id) AS transaction_id")
        fresh = incremental.not_processed(spark.read.parquet(str(tmp_path / "rows")), done)
        assert len(fresh.collect()) == 50000
        assert "skew=true" in fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["score_rejects", "stream_score_forest"])
def test_landing_rows_are_made_once(spark, sf, tmp_path, monkeypatch, name):
    """The forest queries use the rows several times; after they are staged their source may be gone."""
    source = str(tmp_path / "typed")
    queries._typed(spark, sf).write.parquet(source)
    monkeypatch.setattr(queries, "_typed", lambda spark, sf: spark.read.parquet(source))
    train = jobs.train_forest

    def train_without_source(*args, **params):
        shutil.rmtree(source)
        return train(*args, **params)

    monkeypatch.setattr(jobs, "train_forest", train_without_source)
    assert queries.REGISTRY[name](spark, sf).count() > 0


@pytest.mark.parametrize("name", ["score_rejects", "stream_score_forest", "score_saved_forest"])
def test_training_rows_are_not_written(spark, sf, monkeypatch, name):
    """The fit keeps what it reads; the test part, for which wide rows would be written, is not used there."""
    labels = []
    monkeypatch.setattr(queries, "stage", lambda df, label: labels.append(label) or stage(df, label))
    queries.REGISTRY[name](spark, sf)
    assert "features" not in labels


def test_missing_rows_are_counted_without_whole_rows(spark, sf):
    """Only ids and hashes of the input are shuffled to find what is in neither output."""
    text = plan(queries.score_rejects(spark, sf))
    keys = [line for line in text.splitlines() if "HashAggregate(keys=[transaction_id" in line]
    assert keys and not any("merchant_category" in line for line in keys)


def test_a_row_in_neither_output_is_counted_once(spark, sf, monkeypatch):
    """Rows of one user are kept from both runs; copies of them count once."""
    score = jobs.score_new
    kept = "user_id NOT IN ('USER_7', 'GUEST_USER_7', 'USER_USER_7') OR user_id IS NULL"
    monkeypatch.setattr(jobs, "score_new", lambda raw, *args, **options: score(raw.where(kept), *args, **options))
    lost = quality.filter_header(queries._typed(spark, sf)).where(f"NOT ({kept})").distinct().count()
    assert lost > 0 and queries.score_rejects(spark, sf).select("n_missing").distinct().collect() == [(lost,)]
