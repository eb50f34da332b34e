from __future__ import annotations

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_messages import MESSAGE

from txnrisk.operators import messages, models
from txnrisk.sources import messages as topics
from txnrisk.streaming import pipelines


def put(spark, path, *texts):
    rows = [(None, t) for t in texts]
    spark.createDataFrame(rows, "key string, value string").coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, **options):
    return topics.read_files(spark, path, spark.createDataFrame([], "key string, value string").schema, **options)


def message(n):
    return json.dumps({**MESSAGE, "Transaction_ID": f"t{n}"})


def ids(df):
    return sorted(r["transaction_id"] for r in df.collect())


def test_ingest_restart_is_exactly_once(spark, tmp_path):
    source, sink, state = (str(tmp_path / p) for p in ("in", "out", "state"))
    for texts in ([message(1), "broken"], [message(2)], []):
        if texts:
            put(spark, source, *texts)
        report = pipelines.run(
            pipelines.ingest(stream(spark, source), sink, state, trigger=pipelines.AVAILABLE_NOW)
        )
        assert report.error is None
    assert ids(pipelines.ingested(spark, sink)) == ["t1", "t2"]
    assert [r["value"] for r in pipelines.ingest_rejects(spark, sink).collect()] == ["broken"]


def test_ingest_to_csv(spark, tmp_path):
    source, sink, state = (str(tmp_path / p) for p in ("in", "out", "state"))
    put(spark, source, message(1))
    pipelines.run(pipelines.ingest(stream(spark, source), sink, state, "csv", pipelines.AVAILABLE_NOW))
    assert ids(spark.read.option("header", True).csv(sink)) == ["t1"]


def test_stream_decodes_like_batch(spark, tmp_path, txn):
    source, sink, state = (str(tmp_path / p) for p in ("in", "out", "state"))
    messages.encode(txn).repartition(4).write.parquet(source)
    decoded = messages.decode(stream(spark, source, files_per_batch=1))
    query = decoded.writeStream.format("memory").queryName("decoded").trigger(availableNow=True)
    report = pipelines.run(query.option("checkpointLocation", state).start())
    assert (report.batches, report.rows) == (4, txn.count())
    batch = messages.decode(messages.encode(txn))
    assert spark.table("decoded").exceptAll(batch).isEmpty()
    assert sink is not None


def test_failure_is_reported(spark, tmp_path):
    source = str(tmp_path / "in")
    put(spark, source, message(1))

    def fail(batch, batch_id):
        raise RuntimeError("no sink")

    query = stream(spark, source).writeStream.foreachBatch(fail).option("checkpointLocation", str(tmp_path / "state"))
    started = query.trigger(availableNow=True).start()
    report = pipelines.run(started, raise_on_error=False)
    assert "no sink" in report.error
    with pytest.raises(StreamingQueryException, match="no sink"):
        pipelines.run(started)


def test_report_counts_more_batches_than_spark_keeps(spark, tmp_path):
    source, sink, state = (str(tmp_path / p) for p in ("in", "out", "state"))
    values = [(f"t{n}", message(n)) for n in range(120)]
    spark.createDataFrame(values, "key string, value string").repartition(120, "key").write.option(
        "maxRecordsPerFile", 1
    ).parquet(source)
    query = pipelines.ingest(
        stream(spark, source, files_per_batch=1), sink, state, trigger=pipelines.AVAILABLE_NOW
    )
    report = pipelines.run(query)
    assert (report.batches, report.rows) == (120, 120)


def test_running_stream_can_be_stopped(spark, tmp_path):
    source, sink, state = (str(tmp_path / p) for p in ("in", "out", "state"))
    put(spark, source, message(1))
    query = pipelines.ingest(stream(spark, source), sink, state, trigger={"processingTime": "1 second"})
    query.processAllAvailable()
    assert pipelines.run(query, timeout=1).error is None
    assert not query.isActive and ids(pipelines.ingested(spark, sink)) == ["t1"]


def score(df):
    return models.score_linear(df, {"x": 1.0}, 0.0)


def rows(spark, *numbers):
    df = spark.createDataFrame([(f"t{n}", float(n)) for n in numbers], "transaction_id string, x double")
    return df.withColumn("timestamp", F.timestamp_seconds((F.col("x") * 40000).cast("long")))


def run_scoring(spark, source, sink, state):
    stream = topics.read_files(spark, source, rows(spark).schema)
    report = pipelines.run(pipelines.score_stream(stream, score, sink, state, pipelines.AVAILABLE_NOW))
    assert report.error is None


def test_scoring_skips_redelivered_rows(spark, tmp_path):
    source, sink, state = (str(tmp_path / p) for p in ("in", "out", "state"))
    for numbers in [(1, 2, 2), (2, 3), (1,)]:
        rows(spark, *numbers).write.mode("append").parquet(source)
        run_scoring(spark, source, sink, state)
    assert ids(spark.read.parquet(sink)) == ["t1", "t2", "t3"]
    run_scoring(spark, source, sink, str(tmp_path / "new"))
    assert ids(spark.read.parquet(sink)) == ["t1", "t2", "t3"]


def test_new_checkpoint_keeps_what_earlier_runs_stored(spark, tmp_path):
    sink = str(tmp_path / "out")
    for run, numbers in enumerate([(1, 2), (3,)]):
        source = str(tmp_path / f"in{run}")
        rows(spark, *numbers).write.parquet(source)
        run_scoring(spark, source, sink, str(tmp_path / f"state{run}"))
    assert ids(spark.read.parquet(sink)) == ["t1", "t2", "t3"]


def test_batch_that_is_run_again_replaces_its_own_rows(spark, tmp_path):
    """Without its commit file a batch counts as unfinished, as after a crash."""
    source, sink, state = (str(tmp_path / p) for p in ("in", "out", "state"))
    rows(spark, 1, 2).write.parquet(source)
    run_scoring(spark, source, sink, state)
    for name in ("0", ".0.crc"):
        (tmp_path / "state" / "commits" / name).unlink()
    run_scoring(spark, source, sink, state)
    assert ids(spark.read.parquet(sink)) == ["t1", "t2"]
