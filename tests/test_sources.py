from __future__ import annotations

import pytest

from txnrisk.operators import models
from txnrisk.plans import fixtures, jobs
from txnrisk.schemas import CATEGORICALS, TS_FORMAT
from txnrisk.sources import files, scratch
from txnrisk.sources import messages as topics
from txnrisk.sources.tables import CatalogTable, JdbcTable, PathTable


def test_scratch_folder_is_the_one_the_session_names(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_root(spark) == root.rstrip("/")
    assert scratch.scratch_path(spark, "x") != scratch.scratch_path(spark, "x")


def test_csv_keeps_types_and_nulls(spark, txn, tmp_path):
    path = str(tmp_path / "csv")
    some = txn.limit(20).selectExpr("* EXCEPT (card_type)", "nullif(card_type, 'Visa') AS card_type").select(*txn.columns)
    some = scratch.stage(some, "some")
    files.write_csv(some, path)
    files.write_csv(some, path, mode="append")
    back = files.read_csv(spark, path)
    assert back.schema == txn.schema or [f.dataType for f in back.schema] == [f.dataType for f in txn.schema]
    assert back.exceptAll(some.union(some)).isEmpty() and back.count() == 40


def test_csv_with_a_bad_field_keeps_the_row(spark, tmp_path):
    path = str(tmp_path / "csv")
    spark.createDataFrame([("t1", "old")], "transaction_id string, card_age string").write.option("header", True).csv(path)
    schema = spark.createDataFrame([], "transaction_id string, card_age int").schema
    assert tuple(files.read_csv(spark, path, schema).first()) == ("t1", None)


def test_external_table_skips_headers_of_each_file(spark, txn, tmp_path):
    path = str(tmp_path / "ext")
    files.write_csv(txn.limit(30).repartition(3), path)
    assert files.external_table(spark, "ext_test", path).count() == 30
    assert spark.sql(f"SELECT count(*) FROM ext_test WHERE Timestamp > to_timestamp('1990-01-01 00:00:00', '{TS_FORMAT}')").first()[0] == 30


def test_insert_goes_by_name(spark):
    table = CatalogTable("by_name")
    table.append(spark.sql("SELECT 'a' AS x, 'b' AS y"))
    table.append(spark.sql("SELECT 'b' AS y, 'a' AS x"))
    assert {tuple(r) for r in table.read(spark).collect()} == {("a", "b")}
    with pytest.raises(Exception, match="y"):
        table.append(spark.sql("SELECT 'a' AS x"))


def test_path_table(spark, tmp_path):
    table = PathTable(str(tmp_path / "t"))
    assert not table.exists(spark)
    table.overwrite(spark.range(3))
    table.append(spark.range(2))
    assert table.exists(spark) and table.read(spark).count() == 5


def test_database_options():
    table = JdbcTable("jdbc:postgresql://host/db", "trans", {"user": "u"})
    assert table.read_options() == {"url": "jdbc:postgresql://host/db", "dbtable": "trans", "user": "u"}
    ranged = table.range_options("timestamp", "2024-01-01 00:00:00", "2024-02-01 00:00:00", 16)
    assert (ranged["partitionColumn"], ranged["numPartitions"]) == ("timestamp", "16")
    assert table.max_options("ts")["query"] == 'SELECT MAX("ts") AS "ts" FROM trans'
    assert "dbtable" not in table.max_options("ts")
    assert ranged["lowerBound"] < ranged["upperBound"]


class Recorder:
    """Stands in for a DataFrame writer or reader and keeps what it is told."""

    def __init__(self):
        self.calls = {}

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls[name] = (args, kwargs)
            return self

        return call


def test_database_writes_replace_rows_but_keep_the_table():
    table = JdbcTable("jdbc:x", "trans")

    class Frame:
        write = Recorder()

    table.overwrite(Frame)
    assert Frame.write.calls["mode"] == (("overwrite",), {})
    assert Frame.write.calls["options"][1]["truncate"] == "true"
    table.append(Frame)
    assert Frame.write.calls["mode"] == (("append",), {})


def test_topic_options():
    assert topics.topic_options("a:1,b:1", "realtime", "latest") == {
        "kafka.bootstrap.servers": "a:1,b:1",
        "subscribe": "realtime",
        "startingOffsets": "latest",
    }


def test_incremental_load_stops_when_nothing_is_new(spark, txn, tmp_path):
    target = PathTable(str(tmp_path / "t"))
    rows = scratch.stage(txn.limit(50), "rows")
    jobs.full_load(rows.where("1 = 0"), target)
    runs = [jobs.incremental_load(rows, target, limit=20) for _ in range(5)]
    assert runs.count(True) >= 3 and runs[-1] is False
    assert target.read(spark).count() == 50


def test_curation_keeps_columns_when_labels_change(spark, sf, tmp_path):
    from txnrisk.operators import quality

    rows = scratch.stage(quality.type_rows(fixtures.landing(spark, sf)), "typed")
    curated, vocabulary = PathTable(str(tmp_path / "c")), PathTable(str(tmp_path / "v"))
    jobs.curate(rows.where("card_type <> 'Visa' AND timestamp < '2024-01-05'"), curated, vocabulary)
    before = curated.read(spark).columns
    jobs.curate(rows.where("timestamp < '2024-01-08'"), curated, vocabulary)
    after = curated.read(spark)
    assert after.columns == before and "card_type_visa" not in before
    visa = after.where("card_type = 'visa'")
    assert visa.count() > 0
    assert visa.where("card_type_amex + card_type_mastercard + card_type_discover > 0").isEmpty()
    assert after.count() == after.select("transaction_id").distinct().count()
    jobs.curate(rows.where("timestamp < '2024-01-08'"), curated, vocabulary)
    assert curated.read(spark).count() == after.count()


def test_array_route_trains_evaluates_and_saves_once(spark, txn, tmp_path):
    table = CatalogTable("array_features")
    jobs.curate_arrays(txn, table, PathTable(str(tmp_path / "v")))
    rows = table.read(spark)
    assert not set(CATEGORICALS) & set(rows.columns)
    path = str(tmp_path / "model")
    model, test = jobs.train_arrays(rows, models.forest(numTrees=5), path)
    report = dict(jobs.evaluate(model, test).collect())
    assert set(report) == {"AUC", "Precision", "Recall"} and all(0 <= v <= 1 for v in report.values())
    assert report["AUC"] > 0.8
    with pytest.raises(Exception, match="exist"):
        jobs.train_arrays(rows, models.forest(numTrees=1), path)
