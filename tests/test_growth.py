"""Tables that grow or are replaced, and streams with state or a position."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from test_messages import values

from txnrisk.operators import features, incremental, messages, metrics, models
from txnrisk.plans import jobs
from txnrisk.sources import messages as topics
from txnrisk.sources import versions
from txnrisk.sources.keyset import Keyed, read_keyset
from txnrisk.sources.tables import BucketedTable, PathTable, partitioned_table, scan
from txnrisk.sources.versions import Companion, VersionedTable
from txnrisk.streaming import pipelines

ROWS = "transaction_id string, timestamp timestamp, x double"


def rows(spark, *numbers, hour=1):
    """Rows an hour apart, with the number as id."""
    start = dt.datetime(2024, 3, 1)
    return spark.createDataFrame([(f"t{n:04d}", start + dt.timedelta(hours=hour * n), float(n)) for n in numbers], ROWS)


def ids(df):
    return sorted(r["transaction_id"] for r in df.collect())


# Scoring by state ---------------------------------------------------------------


def score(df):
    return models.score_linear(df, {"x": 0.1}, 0.0)


def score_files(spark, tmp_path, delay, sink="out"):
    stream = topics.read_files(spark, str(tmp_path / "in"), rows(spark).schema, files_per_batch=1)
    paths = (str(tmp_path / sink), str(tmp_path / "state"))
    return pipelines.run(pipelines.score_once(stream, score, *paths, delay, pipelines.AVAILABLE_NOW))


def test_state_stays_bounded_and_copies_go(spark, tmp_path):
    """A hundred batches of five rows, each with two of the batch before; the state holds some hours only."""
    for n in range(100):
        rows(spark, *range(5 * n - 2 if n else 0, 5 * n + 5)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # one state store
    try:
        report = score_files(spark, tmp_path, "20 hours")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert report.batches >= 100 and report.error is None
    assert report.state_rows <= 60
    out = spark.read.parquet(str(tmp_path / "out"))
    assert ids(out) == [f"t{n:04d}" for n in range(500)] and report.late == 0


def test_redelivery_is_known_without_reading_the_sink(spark, tmp_path):
    rows(spark, 1, 2, 3).coalesce(1).write.parquet(str(tmp_path / "in"))
    score_files(spark, tmp_path, "10 days")
    assert ids(spark.read.parquet(str(tmp_path / "out"))) == ["t0001", "t0002", "t0003"]
    rows(spark, 3, 4, 1).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = topics.read_files(spark, str(tmp_path / "in"), rows(spark).schema)
    started = pipelines.score_once(stream, score, str(tmp_path / "out"), str(tmp_path / "state"), "10 days", pipelines.AVAILABLE_NOW)
    pipelines.run(started)
    plan = started._jsq.explainInternal(False) if hasattr(started._jsq, "explainInternal") else ""
    assert str(tmp_path / "out") not in plan
    assert ids(spark.read.parquet(str(tmp_path / "out"))) == ["t0001", "t0002", "t0003", "t0004"]


def test_late_rows_are_counted(spark, tmp_path):
    for numbers in [(100,), (101,), (1, 102)]:
        rows(spark, *numbers).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        report = score_files(spark, tmp_path, "2 hours")
    assert report.late == 1
    assert ids(spark.read.parquet(str(tmp_path / "out"))) == ["t0100", "t0101", "t0102"]


def test_rows_without_a_place_are_apart(spark, tmp_path):
    odd = spark.createDataFrame([("a", None, 1.0), (None, dt.datetime(2024, 1, 1), 2.0), ("b", dt.datetime(2024, 1, 1), 3.0)], ROWS)
    odd.coalesce(1).write.parquet(str(tmp_path / "in"))
    assert score_files(spark, tmp_path, "1 hour").error is None
    assert ids(spark.read.parquet(str(tmp_path / "out"))) == ["b"]
    assert sorted(r["reason"] for r in pipelines.unplaced(odd).collect()) == ["no timestamp", "no transaction_id"]


def test_stream_keeps_the_callers_state_provider(spark, tmp_path):
    before = spark.conf.get(pipelines.STATE_PROVIDER)
    rows(spark, 1).write.parquet(str(tmp_path / "in"))
    score_files(spark, tmp_path, "1 hour")
    assert spark.conf.get(pipelines.STATE_PROVIDER) == before


def test_metrics_of_a_running_stream(spark, tmp_path):
    """After each batch the table holds the counts of all rows so far."""
    scored = spark.range(200).selectExpr("round(id % 10 / 10, 1) AS score", "double(id % 10 > 5) AS prediction", "int(id % 3 = 0) AS label")
    path, schema = str(tmp_path / "in"), scored.schema
    for n, part in enumerate(scored.randomSplit([1.0, 1.0], 3)):
        part.write.mode("append").parquet(path)
        stream = topics.read_files(spark, path, schema)
        query = pipelines.tally_stream(stream, f"tally_of_test_{n}", str(tmp_path / f"state{n}"), trigger=pipelines.AVAILABLE_NOW)
        pipelines.run(query)
        want = metrics.metrics_report(spark.read.parquet(path)).collect()
        assert sorted(metrics.report_of(spark.table(f"tally_of_test_{n}")).collect()) == sorted(want)


# Positions -----------------------------------------------------------------------


def publish(spark, tmp_path, table, start="earliest", **options):
    stream = read_keyset(spark, table.path, rows(spark).schema, "timestamp__micros", start=start, **options)
    return pipelines.run(pipelines.publish(stream, str(tmp_path / "state"), "parquet", {"path": str(tmp_path / "out")}, pipelines.AVAILABLE_NOW))


def published(spark, tmp_path):
    out = spark.read.schema("key string, value string").parquet(str(tmp_path / "out"))
    return sorted(r["key"] for r in out.collect())


@pytest.mark.parametrize("by_date", [True, False])
def test_stream_goes_on_where_it_ended(spark, tmp_path, by_date):
    table = PathTable(str(tmp_path / "table"), micros=["timestamp"])
    partitions = ["event_date"] if by_date else []
    for n in range(4):
        part = rows(spark, *range(10 * n, 10 * n + 10)).withColumn("event_date", F.to_date("timestamp"))
        table.append(part if by_date else part.drop("event_date"), partitions)
        report = publish(spark, tmp_path, table, range_rows=3)
        assert report.rows == 10 and published(spark, tmp_path) == [f"t{i:04d}" for i in range(10 * n + 10)]
    assert publish(spark, tmp_path, table).rows == 0
    assert publish(spark, tmp_path, table, start="latest").rows == 0  # the checkpoint counts, not the option


def test_stream_starts_above_a_key_among_equal_times(spark, tmp_path):
    at = dt.datetime(2024, 3, 1, 5, 0, 0, 123456)
    same = spark.createDataFrame([(f"s{i}", at, 0.0) for i in range(6)] + [(None, at, 0.0), ("n", None, 0.0)], ROWS)
    table = PathTable(str(tmp_path / "table"), micros=["timestamp"])
    table.append(same.union(rows(spark, 1, 9)))
    publish(spark, tmp_path, table, start=(at, "s3"))
    assert published(spark, tmp_path) == ["s4", "s5", "t0009"]


def test_stream_from_latest_of_an_empty_folder_takes_what_comes(spark, tmp_path):
    table = PathTable(str(tmp_path / "table"), micros=["timestamp"])
    table.append(rows(spark))
    assert publish(spark, tmp_path, table, start="latest").rows == 0
    table.append(rows(spark, 1, 2))
    publish(spark, tmp_path, table, start="latest")
    assert published(spark, tmp_path) == ["t0001", "t0002"]


def test_earlier_dates_are_not_listed_and_row_groups_are_skipped(spark, tmp_path):
    table = PathTable(str(tmp_path / "table"), micros=["timestamp"])
    days = rows(spark, *range(0, 240)).withColumn("event_date", F.to_date("timestamp"))
    table.append(days.repartition(10, "event_date"), ["event_date"])
    keyed = Keyed(table.path, "timestamp__micros", "transaction_id", "event_date")
    assert len(keyed.listed(None)) == 10 and len(keyed.listed(dt.date(2024, 3, 8))) == 3
    low = int(dt.datetime(2024, 3, 8, 12, tzinfo=dt.UTC).timestamp() * 1e6)
    assert len(keyed.ranges((low, ""), (low + 3600 * 10**6 * 20, "z"), 1000)) == 2
    assert keyed.newest() == (int(dt.datetime(2024, 3, 10, 23, tzinfo=dt.UTC).timestamp() * 1e6), "t0239")


def test_timestamps_without_statistics_work_too(spark, tmp_path):
    path = str(tmp_path / "table")
    rows(spark, 3, 1, 2).write.parquet(path)
    stream = read_keyset(spark, path, rows(spark).schema, start=(dt.datetime(2024, 3, 1, 1), "t0001"))
    sink = {"path": str(tmp_path / "out")}
    pipelines.run(pipelines.publish(stream, str(tmp_path / "state"), "parquet", sink, pipelines.AVAILABLE_NOW))
    assert published(spark, tmp_path) == ["t0002", "t0003"]


# Messages of unknown fields ----------------------------------------------------------


def test_inferred_fields(spark):
    texts = ['{"a":1,"b":"x","c":[1]}', '{"a":2.5,"b":3,"d":null}', '{"a":null,"e":{"f":1,"g":2}}', '{"h,i: j<k>":true}', "bad", "", None, "[]"]
    objects = messages.variants(values(spark, *texts, '[{"a":7},{"b":true},8,null]', "[1", "5"))
    schema = messages.inferred_schema(objects)
    assert {f.name: f.dataType.simpleString() for f in schema} == {
        "a": "double", "b": "string", "c": "string", "d": "string", "e": "string", "h,i: j<k>": "boolean",
    }
    out = messages.decode_inferred(objects, schema)
    good = messages.accepted(out).collect()
    assert sorted(r["a"] for r in good if r["a"] is not None) == [1.0, 2.5, 7.0]
    assert sorted(r["b"] for r in good if r["b"] is not None) == ["3", "true", "x"]
    assert [r["e"] for r in good if r["e"]] == ['{"f":1,"g":2}'] and [r["h,i: j<k>"] for r in good].count(True) == 1
    assert sorted(r["value"] for r in messages.rejected(out).collect()) == ["", "", "", "5", "8", "[1", "bad"]


def test_nothing_to_infer(spark):
    objects = messages.variants(values(spark, "bad", None))
    out = messages.decode_inferred(objects, messages.inferred_schema(objects))
    assert out.columns == [messages.CORRUPT] and out.count() == 2


def test_null_values_and_items_are_rejects(spark):
    decoded = messages.decode(values(spark, None, '{"Card_Age":1}'))
    assert [r["value"] for r in messages.rejected(decoded).collect()] == [""]
    assert messages.accepted(decoded).count() == 1
    items = values(spark, '[null,{"Card_Age":1}]', None)
    assert messages.explode_array(items).count() == 1 and messages.array_rejects(items).count() == 2


# Tables -------------------------------------------------------------------------------


def typed(txn, letter):
    return txn.withColumn("device_type", F.concat(F.lit(letter), "device_type"))


def labels_match(spark, table):
    """Every label of the vocabulary has its column, and no column is without a label."""
    labels = features.labels_of(table.companion(spark, "vocabulary"))
    hot = {c for c in table.read(spark).columns if c.startswith("device_type_")}
    return hot and hot == {c for c in features.onehot_columns(labels) if c.startswith("device_type_")}


def test_any_failing_write_leaves_a_matching_pair(spark, txn, tmp_path, monkeypatch):
    table = VersionedTable("swapped_in_test", str(tmp_path / "versions"))
    vocabulary = Companion(table, "vocabulary")
    jobs.curate(typed(txn, "A"), table, vocabulary, "full")
    version = table.version(spark)
    assert labels_match(spark, table)
    folders = sorted(p.name for p in (tmp_path / "versions").iterdir())

    broken = F.expr("cast(raise_error('broken') AS string)")
    for part in (versions.MAIN, "vocabulary"):
        publish = VersionedTable.publish

        def failing(self, parts, partition_by=(), part=part, publish=publish):
            return publish(self, {**parts, part: parts[part].withColumn("broken", broken)}, partition_by)

        with monkeypatch.context() as patch, pytest.raises(Exception, match="broken"):
            patch.setattr(VersionedTable, "publish", failing)
            jobs.curate(typed(txn, "B"), table, vocabulary, "full")
        assert table.version(spark) == version and labels_match(spark, table)

    def no_catalog(self, spark, folder, before):
        raise RuntimeError("no catalog")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="no catalog"):
        patch.setattr(VersionedTable, "point", no_catalog)
        jobs.curate(typed(txn, "B"), table, vocabulary, "full")
    assert table.version(spark) == version and labels_match(spark, table)
    assert sorted(p.name for p in (tmp_path / "versions").iterdir()) == folders  # nothing half written stays

    reader = table.read(spark)
    jobs.curate(typed(txn, "B"), table, vocabulary, "full")
    assert table.version(spark) != version and labels_match(spark, table)
    assert reader.count() == table.read(spark).count()  # the version before is still there
    jobs.curate(typed(txn, "C"), table, vocabulary, "full")
    assert len(list((tmp_path / "versions").iterdir())) == 2
    spark.sql("DROP VIEW swapped_in_test")


def test_versioned_table_appends(spark, tmp_path):
    table = VersionedTable("appended_in_test", str(tmp_path / "versions"))
    assert not table.exists(spark) and table.version(spark) is None
    table.append(rows(spark, 1))
    table.append(rows(spark, 2))
    assert ids(table.read(spark)) == ["t0001", "t0002"]
    spark.sql("DROP VIEW appended_in_test")


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_newest_comes_from_footers(spark, tmp_path):
    table = PathTable(str(tmp_path / "t"), micros=["timestamp"])
    table.append(rows(spark, 1, 5))
    table.append(rows(spark, 3).union(spark.createDataFrame([("n", None, 0.0)], ROWS)))
    newest = table.newest(spark, "timestamp")
    assert "PushedAggregation: [MAX(timestamp__micros)]" in plan_of(newest)
    assert newest.collect() == [(dt.datetime(2024, 3, 1, 5),)]
    assert table.read(spark).columns == ["transaction_id", "timestamp", "x"]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    jobs.import_new(rows(spark, 4, 5, 6, 7), table)
    assert ids(table.read(spark).where("x > 5")) == ["t0006", "t0007"]


def test_newest_of_an_empty_table(spark, tmp_path):
    table = PathTable(str(tmp_path / "t"), micros=["timestamp"])
    table.append(rows(spark))
    assert incremental.watermark(table.newest(spark, "timestamp")).first()[0] == dt.datetime(1970, 1, 1)


def test_partitions_are_read_without_listing_the_others(spark, tmp_path):
    metric = spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics.METRIC_FILES_DISCOVERED()
    path, ddl = str(tmp_path / "days"), "transaction_id string, event_date date"
    table = partitioned_table(spark, "days_in_test", path, ddl, ["event_date"])
    seen = []
    for first in (0, 1000):
        days = rows(spark, *range(24 * first // 100, 24 * first // 100 + 240)).withColumn("event_date", F.to_date("timestamp"))
        days.select("transaction_id", "event_date").write.mode("append").partitionBy("event_date").parquet(path)
        table.recover_partitions(spark)
        before = metric.getCount()
        one = scan(spark, table.name, "event_date = DATE '2024-03-02'")
        assert one.count() == 24
        seen.append(metric.getCount() - before)
    assert seen[0] == seen[1] or seen[1] <= 8  # files of one date only
    assert "PartitionFilters: [isnotnull(event_date" in plan_of(one)
    elsewhere = str(tmp_path / "elsewhere")
    rows(spark, 7).select("transaction_id").write.parquet(elsewhere)
    table.add_partition(spark, {"event_date": "2025-01-01"}, elsewhere)
    assert ids(scan(spark, table.name, "event_date = DATE '2025-01-01'")) == ["t0007"]
    spark.sql("DROP TABLE days_in_test")


def test_history_in_buckets_is_not_shuffled(spark, tmp_path):
    table = BucketedTable("bucketed_in_test", "transaction_id", 8, {"path": str(tmp_path / "b")})
    for numbers in (range(40), range(20, 60), range(60)):
        jobs.score_new(rows(spark, *numbers), table, score)
    assert ids(table.read(spark)) == [f"t{n:04d}" for n in range(60)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source = str(tmp_path / "rows")
        rows(spark, *range(100)).write.parquet(source)
        fresh = incremental.not_processed(spark.read.parquet(source), table.read(spark))
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and fresh.count() == 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE bucketed_in_test")


def test_vocabulary_grows_and_keeps_its_places(spark):
    def frame(*pairs):
        return spark.createDataFrame(pairs, "a string, b string")

    vocabulary = features.label_vocab(frame(("x", "p"), ("x", "q"), ("y", "q")), ["a", "b"])
    more = frame(("z", "q"), ("w", None), ("z", "r"), ("y", "s"), (None, "s"))
    merged = features.merge_vocab(vocabulary, more, ["a", "b"])
    found = {(r["column_name"], r["label"]): (r["idx"], r["n_rows"]) for r in merged.collect()}
    assert found == {
        ("a", "x"): (0, 2), ("a", "y"): (1, 2), ("a", "z"): (2, 2), ("a", "w"): (3, 1),
        ("b", "q"): (0, 3), ("b", "p"): (1, 1), ("b", "s"): (2, 2), ("b", "r"): (3, 1),
    }
    assert features.merge_vocab(vocabulary, more.limit(0), ["a", "b"]).exceptAll(vocabulary).isEmpty()


def test_a_second_bad_row_of_an_id_is_kept(spark, tmp_path):
    rejects = PathTable(str(tmp_path / "rejects"))
    columns = "transaction_id string, a int, b int"
    first, second = [("i", None, 1), ("i", None, 1)], [("i", None, 1), ("i", 2, None), ("j", 1, 1)]
    for part in (first, first + second):
        df = spark.createDataFrame(part, columns)
        fresh = incremental.not_seen(df, rejects.read(spark), ["transaction_id", "a", "b"]) if rejects.exists(spark) else df
        rejects.append(fresh.where("a IS NULL OR b IS NULL").dropDuplicates())
    assert sorted(map(str, rejects.read(spark).collect())) == sorted(map(str, spark.createDataFrame([("i", None, 1), ("i", 2, None)], columns).collect()))


def test_payloads_with_numbers_that_are_none(spark):
    from txnrisk.schemas import V36_BLOCKS, V36_SCALARS, VOCABULARY

    blocks = [[0.0] * len(VOCABULARY[c]) for c in V36_BLOCKS]
    good = [1.5] * len(V36_SCALARS) + blocks
    bad = [["NaN", *good[1:]], ["Infinity", *good[1:]], [*good[:-1], ["-Infinity", *blocks[-1][1:]]]]
    texts = [json.dumps({"features": f}) for f in (good, *bad)]
    out = models.payload_valid(values(spark, *texts), len(good))
    assert [r["valid"] for r in out.collect()] == [True, False, False, False]
