from __future__ import annotations

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from txnrisk.operators import features, metrics, models
from txnrisk.schemas import CATEGORICALS, V36_BLOCKS, V36_SCALARS, VOCABULARY, message_schema, raw_schema

CATS = "transaction_id string, user_id string, " + ", ".join(f"{c} string" for c in CATEGORICALS)


def test_layouts():
    assert len(raw_schema()) == 21
    assert len(message_schema()) == 20
    assert sum(map(len, VOCABULARY.values())) == 25
    assert len(V36_SCALARS) + 25 == 36 and V36_SCALARS.count("risk_score") == 2
    assert len(features.v40_inputs()) == 40


def test_vocabulary_order_is_that_of_the_indexer(spark, txn):
    labels = features.labels_of(features.label_vocab(txn))
    model = features.encoding_pipeline().fit(txn)
    assert [list(v) for v in model.stages[0].labelsArray] == [labels[c] for c in CATEGORICALS]


def test_array_encoding_of_two_rows(spark):
    rows = [("t1", "u1", "online", "mobile", "London", "food", "visa", "pin"),
            ("t2", "u2", "pos", "laptop", "Paris", "travel", "visa", "otp")]
    df = spark.createDataFrame(rows, CATS)
    out = features.encoding_pipeline().fit(df).transform(df)
    out = features.vectors_to_arrays(out, [f"{c}_vec" for c in CATEGORICALS])
    first = out.orderBy("transaction_id").first()
    assert {f"{c}_arr" for c in CATEGORICALS} < set(out.columns)
    assert first["transaction_type_arr"] == [1.0, 0.0] and first["card_type_arr"] == [1.0]


def test_unseen_and_null_labels_are_all_zero(spark):
    df = spark.createDataFrame([("a",), ("zz",), (None,)], "c string")
    labels = {"c": ["a", "b"]}
    named = features.onehot_named(df, labels).collect()
    assert [(r["c_a"], r["c_b"]) for r in named] == [(1, 0), (0, 0), (0, 0)]
    assert [r["c_idx"] for r in features.label_index(df, labels).collect()] == [0.0, 2.0, 2.0]
    arrays = features.onehot_arrays(df, labels).collect()
    assert [r["c_arr"] for r in arrays] == [[1.0, 0.0], [0.0, 0.0], [0.0, 0.0]]


def test_both_index_routes_agree(spark, txn):
    vocab = features.label_vocab(txn.where("device_type <> 'Laptop'"), ["device_type"])
    short = features.label_index(txn, features.labels_of(vocab)).select("transaction_id", "device_type_idx")
    joined = features.index_by_join(txn, vocab, "device_type").select("transaction_id", "device_type_idx")
    assert short.exceptAll(joined).isEmpty() and joined.exceptAll(short).isEmpty()


def test_large_vocabulary_equals_the_small_one(spark, txn):
    for c in ("user_id", "location"):
        small = features.label_vocab(txn, [c])
        large = features.label_vocab_large(txn, c)
        assert small.exceptAll(large).isEmpty() and large.count() == small.count()


def test_large_vocabularies_have_no_limit(spark):
    df = spark.range(3000).selectExpr("cast(id AS string) AS c")
    vocab = features.label_vocab(df, ["c"])
    labels = features.labels_of(vocab)["c"]
    assert len(labels) == 3000
    more = df.union(spark.sql("SELECT 'new' AS c UNION ALL SELECT NULL"))
    hot = {r["c"]: r["c_hot"] for r in features.onehot_by_join(more, vocab, "c").collect()}
    assert all(hot[label]["indices"] == [i] and hot[label]["values"] == [1.0] for i, label in enumerate(labels))
    assert hot["new"]["indices"] == hot[None]["indices"] == [] and hot["new"]["size"] == 3000


def test_labels_that_share_a_column_name_are_refused():
    with pytest.raises(ValueError, match="normalise"):
        features.onehot_columns({"c": ["New York", "new-york"]})


def test_assemble_null_handling(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, 2.0)], "a double, b double")
    assert features.assemble(df, ["a", "b"], invalid="skip").count() == 1
    assert features.assemble(df, ["a", "b"], invalid="keep").count() == 2
    with pytest.raises(Exception, match="null"):
        features.assemble(df, ["a", "b"]).collect()


def test_payloads(spark):
    scalars = ",".join(str(i) for i in range(11))
    blocks = ",".join("[" + ",".join(["0"] * len(VOCABULARY[c])) + "]" for c in V36_BLOCKS)
    df = spark.createDataFrame([('{"features":[%s,%s]}' % (scalars, blocks),), ('{"features":[1]}',), ("x",)], "value string")
    checked = models.payload_valid(df, 17)
    assert [(r["n_features"], r["valid"]) for r in checked.collect()] == [(17, True), (1, False), (0, False)]
    vector = models.payload_vector(checked.where("valid")).first()["features"]
    assert len(vector) == 36 and list(vector[:3]) == [0.0, 1.0, 2.0]


def test_filter_on_valid_parses_payloads_once(spark):
    """The filter stays above the parsing, which it would repeat for each of its conditions."""
    df = spark.range(5).selectExpr("cast(id AS string) AS value")
    good = models.payload_valid(df, 17).where("valid")
    for rows, times in ((good, 1), (models.payload_vector(good), 2)):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == times * (1 + len(V36_BLOCKS))


def test_payload_columns_keep_their_place(spark):
    df = spark.createDataFrame([(1, "x", 2)], "id int, value string, n int")
    row = models.payload_valid(df, 17).first()
    assert row.asDict() == {"id": 1, "value": "x", "n": 2, "n_features": 0, "valid": False}


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.range(3000).selectExpr("id", "round((id * 7919 % 1000) / 1000, 2) AS score")
    df = df.selectExpr("*", "cast(score + (id * 104729 % 100) / 100 > 1 AS int) AS label")
    return df.selectExpr("*", "cast(score > 0.6 AS double) AS prediction", "cast(label AS double) AS truth")


def test_auc_is_the_exact_evaluator_value(scored):
    evaluator = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0)
    assert metrics.roc_auc(scored).first()[0] == pytest.approx(evaluator.evaluate(scored), abs=1e-12)


def test_auc_equals_pair_counting(spark):
    rows = [(0.1, 0), (0.4, 0), (0.4, 1), (0.4, 1), (0.8, 1), (0.7, 0)]
    df = spark.createDataFrame(rows, "score double, label int")
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    won = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    assert metrics.roc_auc(df).first()[0] == pytest.approx(won / 9)
    assert metrics.roc_auc(df.where("label = 1")).first()[0] is None


@pytest.mark.parametrize("metric", ["weightedPrecision", "weightedRecall"])
def test_weighted_metrics_equal_the_evaluator(scored, metric):
    want = MulticlassClassificationEvaluator(labelCol="truth", metricName=metric).evaluate(scored)
    got = metrics.weighted_precision_recall(scored).first().asDict()
    assert got["weighted_precision" if metric.endswith("Precision") else "weighted_recall"] == pytest.approx(want)


def test_report(scored):
    report = dict(metrics.metrics_report(scored).collect())
    assert set(report) == {"AUC", "Precision", "Recall"}
    assert report["AUC"] == round(metrics.roc_auc(scored).first()[0], 4)


def test_train_save_score_reload(spark, tmp_path):
    df = spark.range(400).selectExpr("cast(id % 20 AS double) AS x", "cast(id % 20 > 9 AS int) AS fraud_label", "id")
    path = str(tmp_path / "model")
    for classifier in (models.forest(numTrees=5), models.logistic()):
        model = models.train(df, ["x", "x"], classifier)
        models.save(model, path, overwrite=True)
        with pytest.raises(Exception, match="exist"):
            models.save(model, path)
        first, again = (models.score(df, m, ["id"]) for m in (model, models.load(path)))
        assert first.exceptAll(again).isEmpty()
        assert metrics.roc_auc(models.score(df, model), "probability", "fraud_label").first()[0] == 1.0


def test_join_back_does_not_multiply_copies(spark):
    raw = spark.createDataFrame([("a", 1)] * 3 + [("b", 2)], "transaction_id string, x int")
    preds = raw.select("transaction_id", F.lit(1.0).alias("prediction"))
    assert models.join_back(raw, preds).count() == 4


def test_scoring_needs_no_shuffle(spark, tmp_path):
    df = spark.range(40).selectExpr("cast(id AS double) AS x", "cast(id > 20 AS int) AS fraud_label")
    scored = models.score(df, models.train(df, ["x"], models.logistic()))
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
    assert scored.count() == 40
