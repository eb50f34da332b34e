"""Registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.functions import (
    clean_user_id,
    hash_bucket,
    parse_ts,
    round_array,
    strip_prefix,
    text,
)
from txnrisk.operators import features, incremental, messages, metrics, models, ordering, quality, split
from txnrisk.plans import jobs
from txnrisk.plans.fixtures import landing, txn
from txnrisk.schemas import (
    CALENDAR,
    CATEGORICALS,
    HEADER_ID,
    HEADER_TYPE,
    LABEL,
    RAW_COLUMNS,
    RAW_FIELDS,
    V36_BLOCKS,
    V36_SCALARS,
    VOCABULARY,
)
from txnrisk.sources import files
from txnrisk.sources import messages as topics
from txnrisk.sources.keyset import read_keyset
from txnrisk.sources.scratch import scratch_path, stage
from txnrisk.sources.tables import BucketedTable, CatalogTable, PathTable, partitioned_table, scan
from txnrisk.sources.versions import Companion, VersionedTable
from txnrisk.streaming import pipelines

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

KEYS = ("timestamp", "transaction_id")
LAST = "2024-01-20 12:00:00"

# Logistic coefficients for value checks: SQL can repeat this score, unlike a trained model's.
PINNED = {
    "transaction_amount": 0.002,
    "account_balance": -0.00003,
    "risk_score": 4.0,
    "previous_fraudulent_activity": 0.6,
    "failed_transaction_count_7d": 0.1,
    "hour": 0.01,
    "transaction_type_atm_withdrawal": 1.5,
    "location_new_york": -0.25,
}
INTERCEPT = -3.0


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    return quality.type_rows(landing(spark, sf))


def _spread(df: DataFrame, array: Column, prefix: str, size: int, keep: tuple[str, ...]) -> DataFrame:
    """Array elements as columns, so that results compare column by column."""
    places = [f"get(elements, {i}) AS {prefix}_{i}" for i in range(size)]
    return df.withColumn("elements", array).selectExpr(*keep, *places)


def _score(df: DataFrame) -> DataFrame:
    """Featurize raw rows with the fixed vocabulary and score them; raw columns stay."""
    raw = {f"raw_{c}": text.name(c) for c in CATEGORICALS}
    ready = features.with_calendar(features.onehot_fixed(text.with_columns(df, raw)))
    scored = models.score_linear(ready, PINNED, INTERCEPT)
    columns = [f"raw_{c} AS {c}" if c in CATEGORICALS else text.name(c) for c in df.columns]
    return scored.selectExpr(*columns, "round(probability, 6) AS probability", "prediction")


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Landing text to scored transactions: filter, type, clean, featurize, score."""
    rows = quality.clean_rows(_typed(spark, sf))
    return _score(rows.withColumn("user_id", clean_user_id("user_id")))


@query
def score_landing(spark: SparkSession, sf: str) -> DataFrame:
    return flagship(spark, sf)


# Row quality -----------------------------------------------------------------


@query
def filter_header(spark: SparkSession, sf: str) -> DataFrame:
    return quality.filter_header(landing(spark, sf))


@query
def filter_header_curated(spark: SparkSession, sf: str) -> DataFrame:
    renamed = landing(spark, sf).withColumn(
        "transaction_type",
        F.when(F.col("transaction_id") == HEADER_ID, HEADER_TYPE).otherwise(F.col("transaction_type")),
    )
    return quality.filter_header(renamed, "transaction_type", HEADER_TYPE)


@query
def project_drop(spark: SparkSession, sf: str) -> DataFrame:
    return txn(spark, sf).drop(*CATEGORICALS, "timestamp")


@query
def project_select(spark: SparkSession, sf: str) -> DataFrame:
    return txn(spark, sf).select("transaction_id", F.col("transaction_amount").alias("amount"), "fraud_label")


@query
def clean_rows(spark: SparkSession, sf: str) -> DataFrame:
    return quality.clean_rows(landing(spark, sf))


@query
def metric_auc_null_label(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without a label or score count in neither class."""
    scored = _score(txn(spark, sf)).withColumns({
        "fraud_label": F.when(F.col("card_age") % 7 != 0, F.col("fraud_label")),
        "probability": F.when(F.col("card_age") % 11 != 0, F.col("probability")),
    })
    area = metrics.roc_auc(scored, "probability", "fraud_label").select(F.round("auc", 6).alias("auc"))
    return area.join(metrics.unscored(scored, "probability", "fraud_label"), F.lit(True))


@query
def onehot_wide(spark: SparkSession, sf: str) -> DataFrame:
    """A sparse one-hot over thousands of labels: its only place, and how many it has."""
    rows = txn(spark, sf)
    vocab = features.label_vocab_large(rows.where(hash_bucket("transaction_id") < 70), "transaction_id")
    hot = features.onehot_by_join(rows, vocab, "transaction_id")
    place = F.coalesce(F.get("transaction_id_hot.indices", F.lit(0)), F.lit(-1))
    return hot.select("transaction_id", place.alias("place"), F.col("transaction_id_hot.size").alias("n_places"))


@query
def fill_nulls(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.filter_header(_typed(spark, sf))
    return quality.fill_nulls(rows, {"transaction_amount": 0.0, "card_age": 0, "location": "Unknown"}).drop("timestamp")


@query
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_profile(_typed(spark, sf))


@query
def dup_profile(spark: SparkSession, sf: str) -> DataFrame:
    return quality.dup_profile(landing(spark, sf))


@query
def type_rejects(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.filter_header(landing(spark, sf))
    bad = quality.type_rejects(rows, ["timestamp", "transaction_amount", "card_age"])
    return bad.select("transaction_id", "timestamp", "reason")


def _payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Positional JSON payloads from transactions. Some lack entries or have no list; some have a text,
    a null, a block that is too short or none in place of a number or block."""
    rows = features.onehot_arrays(features.normalize_all(txn(spark, sf)), VOCABULARY)
    scalars = ", ".join(f"cast(cast({c} AS double) AS string)" for c in V36_SCALARS)
    blocks = ", ".join(f"to_json({c}_arr)" for c in V36_BLOCKS)
    rest = scalars.partition(", ")[2]
    others = blocks.rpartition(", ")[0]
    return rows.selectExpr(
        "transaction_id",
        f"""CASE {text.hash_bucket("transaction_id", 20)}
          WHEN 3 THEN concat('{{"features":[', concat_ws(',', {scalars}), ']}}')
          WHEN 4 THEN '{{}}'
          WHEN 5 THEN concat('{{"features":["many",', concat_ws(',', {rest}, {blocks}), ']}}')
          WHEN 6 THEN concat('{{"features":[null,', concat_ws(',', {rest}, {blocks}), ']}}')
          WHEN 7 THEN concat('{{"features":[', concat_ws(',', {scalars}, {others}), ',[0.0,1.0]]}}')
          WHEN 8 THEN concat('{{"features":[', concat_ws(',', {scalars}, {others}), ',"none"]}}')
          ELSE concat('{{"features":[', concat_ws(',', {scalars}, {blocks}), ']}}') END AS value""",
    )


PAYLOAD_SIZE = len(V36_SCALARS) + len(V36_BLOCKS)


@query
def payload_nonfinite(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads with a number that is none: in the scalars or in a block."""
    part = hash_bucket("transaction_id", 20)
    first = r'^\{"features":\[[^,]+'
    value = F.when(part == 9, F.regexp_replace("value", first, '{"features":["NaN"'))
    value = value.when(part == 10, F.regexp_replace("value", first, '{"features":["-Infinity"'))
    value = value.when(part == 11, F.regexp_replace("value", r"\[[01]\.0,", '["NaN",'))
    rows = _payloads(spark, sf).withColumn("value", value.otherwise(F.col("value")))
    return models.payload_valid(rows, PAYLOAD_SIZE).select("transaction_id", "valid")


@query
def payload_validate(spark: SparkSession, sf: str) -> DataFrame:
    return models.payload_valid(_payloads(spark, sf), PAYLOAD_SIZE).drop("value")


@query
def payload_vector(spark: SparkSession, sf: str) -> DataFrame:
    good = models.payload_valid(_payloads(spark, sf), PAYLOAD_SIZE).where("valid")
    rows = models.payload_vector(good)
    return _spread(rows, vector_to_array("features"), "f", 36, ("transaction_id",))


@query
def payload_score(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads and the rows they stand for must get the same scores; bad payloads get none."""
    rows = stage(_v36(spark, sf), "vectors")
    model = models.train(rows, features.v36_inputs(), models.logistic(LABEL, maxIter=5))
    payloads = models.score_payloads(stage(_payloads(spark, sf), "payloads"), model, PAYLOAD_SIZE)
    direct = models.score(rows, model, ["transaction_id"]).withColumnRenamed("probability", "expected")
    both = payloads.join(direct.drop("prediction"), "transaction_id")
    return both.agg(
        F.count("*").alias("n_payloads"),
        F.count_if(F.expr("NOT valid AND probability IS NULL")).alias("n_rejected"),
        F.count_if(F.expr("valid AND abs(probability - expected) < 1e-12")).alias("n_equal"),
    )


# Scalar functions ------------------------------------------------------------


@query
def clean_user(spark: SparkSession, sf: str) -> DataFrame:
    return landing(spark, sf).select(
        "transaction_id",
        strip_prefix("user_id").alias("stripped"),
        strip_prefix("user_id", anchored=False).alias("stripped_all"),
        clean_user_id("user_id").alias("user_number"),
        clean_user_id("user_id", anchored=False).alias("user_number_all"),
    )


@query
def normalize_categories(spark: SparkSession, sf: str) -> DataFrame:
    both = [f"{text.normalize_category(c)} AS {c}" for c in CATEGORICALS]
    plain = [f"{text.normalize_category(c, collapse=False)} AS {c}_plain" for c in CATEGORICALS]
    return landing(spark, sf).selectExpr("transaction_id", *both, *plain)


@query
def ts_parse(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.filter_header(landing(spark, sf))
    return rows.select("transaction_id", parse_ts("timestamp").alias("ts"))


@query
def calendar(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.filter_header(landing(spark, sf)).withColumn("ts", parse_ts("timestamp"))
    return features.with_calendar(rows, "ts").select("transaction_id", "hour", "dayofweek", "dayofmonth")


@query
def round_probability(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("risk_score").cast("double")
    pair = array_to_vector(F.array(1 - p * 0.731, p * 0.731))
    rows = txn(spark, sf).withColumn("probability", pair)
    return _spread(rows, round_array("probability"), "p", 2, ("transaction_id",))


# Encodings -------------------------------------------------------------------


@query
def label_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return features.label_vocab(quality.filter_header(landing(spark, sf)))


def _vocabulary(df: DataFrame) -> dict[str, list[str]]:
    return features.labels_of(features.label_vocab(df))


@query
def label_index(spark: SparkSession, sf: str) -> DataFrame:
    """Vocabulary of the train part, so that other rows can be unseen."""
    rows = quality.filter_header(landing(spark, sf))
    known = rows.where((F.col("device_type") != "Smart-TV") & hash_bucket("transaction_id").between(0, 69))
    out = features.label_index(rows, _vocabulary(known))
    return out.select("transaction_id", *[f"{c}_idx" for c in CATEGORICALS])


@query
def index_by_join(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.filter_header(landing(spark, sf))
    vocab = features.label_vocab_large(rows.where(hash_bucket("transaction_id") < 70), "user_id")
    return features.index_by_join(rows, vocab, "user_id").select("transaction_id", "user_id_idx")


@query
def onehot_fixed(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.onehot_fixed(quality.filter_header(landing(spark, sf)))
    return rows.select("transaction_id", *CATEGORICALS, *features.onehot_columns(VOCABULARY))


@query
def onehot_named(spark: SparkSession, sf: str) -> DataFrame:
    rows = txn(spark, sf)
    labels = _vocabulary(rows)
    out = features.onehot_named(rows, labels)
    return out.select("transaction_id", *features.onehot_columns(labels))


@query
def onehot_array(spark: SparkSession, sf: str) -> DataFrame:
    rows = txn(spark, sf)
    labels = _vocabulary(rows)
    out = features.onehot_arrays(rows, labels).select("transaction_id", *[f"{c}_arr" for c in CATEGORICALS])
    return _flat_slots(out, {c: len(v) for c, v in labels.items()})


@query
def onehot_vector(spark: SparkSession, sf: str) -> DataFrame:
    rows = txn(spark, sf).select("transaction_id", *CATEGORICALS)
    model = features.encoding_pipeline().fit(rows)
    vectors = [f"{c}_vec" for c in CATEGORICALS]
    out = features.vectors_to_arrays(model.transform(rows), vectors)
    sizes = {c: len(v) for c, v in zip(CATEGORICALS, model.stages[0].labelsArray, strict=True)}
    return _flat_slots(out.select("transaction_id", *[f"{c}_arr" for c in CATEGORICALS]), sizes)


def _flat_slots(df: DataFrame, sizes: dict[str, int]) -> DataFrame:
    for c in CATEGORICALS:
        df = features.flatten_array(df, f"{c}_arr", sizes[c])
    return df


@query
def flatten_array(spark: SparkSession, sf: str) -> DataFrame:
    counts = F.array("daily_transaction_count", "failed_transaction_count_7d", "card_age")
    short = F.slice(counts, 1, 2)
    arrays = F.when(F.col("ip_address_flag") == 1, short).otherwise(counts)
    rows = txn(spark, sf).select("transaction_id", arrays.alias("counts"))
    return features.flatten_array(rows, "counts", 3)


@query
def array_vector_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    values = F.array(*[F.col(c).cast("double") for c in ("transaction_amount", "account_balance", "risk_score")])
    rows = txn(spark, sf).select("transaction_id", values.alias("money_arr"))
    back = features.vectors_to_arrays(features.arrays_to_vectors(rows, ["money_arr"]), ["money_vec"])
    return features.flatten_array(back, "money_arr", 3)


def _v36(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = features.normalize_all(txn(spark, sf))
    arrays = [f"{c}_arr" for c in CATEGORICALS]
    return features.arrays_to_vectors(features.onehot_arrays(cleaned, VOCABULARY), arrays)


@query
def assemble_v36(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.assemble(_v36(spark, sf), features.v36_inputs())
    return _spread(rows, vector_to_array("features"), "f", 36, ("transaction_id",))


@query
def assemble_v40(spark: SparkSession, sf: str) -> DataFrame:
    rows = jobs.feature_rows(_typed(spark, sf)).where(F.col("user_id").isNotNull())
    rows = features.assemble(rows, features.v40_inputs())
    return _spread(rows, vector_to_array("features"), "f", 40, ("transaction_id",))


@query
def unseen_labels(spark: SparkSession, sf: str) -> DataFrame:
    return features.unseen_labels(quality.filter_header(landing(spark, sf)))


# Increments and order --------------------------------------------------------


@query
def watermark_max(spark: SparkSession, sf: str) -> DataFrame:
    rows = _typed(spark, sf)
    full = incremental.watermark(rows, name="last_ts").select(F.lit("all").alias("part"), "last_ts")
    none = incremental.watermark(rows.where(F.col("timestamp") < "1990-01-01"), name="last_ts")
    return full.unionByName(none.select(F.lit("none").alias("part"), "last_ts"))


@query
def incr_newer_than(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.newer_than(txn(spark, sf), LAST)


@query
def incr_topn(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.oldest_batch(txn(spark, sf), LAST)


@query
def incr_topn_ties(spark: SparkSession, sf: str) -> DataFrame:
    hourly = txn(spark, sf).withColumn("timestamp", F.date_trunc("hour", "timestamp"))
    return incremental.oldest_batch(hourly, LAST, with_ties=True)


@query
def incr_left_anti(spark: SparkSession, sf: str) -> DataFrame:
    rows = txn(spark, sf)
    return incremental.not_processed(rows, rows.where(hash_bucket("transaction_id") < 60))


@query
def ordered_index(spark: SparkSession, sf: str) -> DataFrame:
    rows = txn(spark, sf).select("transaction_id", "timestamp")
    return ordering.ordered_index(rows, KEYS)


@query
def incr_by_row_index(spark: SparkSession, sf: str) -> DataFrame:
    rows = txn(spark, sf)
    seen = rows.where(hash_bucket("transaction_id") < 60).count()
    return ordering.rows_from_index(rows, KEYS, seen)


@query
def page_offset(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.page_by_offset(txn(spark, sf), KEYS, 500, 100)


@query
def page_keyset(spark: SparkSession, sf: str) -> DataFrame:
    """The second page after the last key of the first."""
    rows = txn(spark, sf)
    first = ordering.page_after(rows, KEYS, None, 100)
    end = first.agg(F.max(F.struct(F.unix_micros("timestamp").alias("at"), "transaction_id")).alias("k")).first()["k"]
    last = (F.timestamp_micros(F.lit(end["at"])), F.lit(end["transaction_id"]))
    return ordering.page_after(rows, KEYS, last, 100)


FAR = {"small": 50, "pivots": 7}  # the search over several levels, on tables of any size


@query
def page_offset_far(spark: SparkSession, sf: str) -> DataFrame:
    """A page across the last dated rows and the first without a time."""
    rows = _typed(spark, sf)
    dated = rows.where(F.col("timestamp").isNotNull()).count()
    return ordering.page_by_offset(rows, KEYS, dated - 40, 100, **FAR).select("transaction_id", "timestamp")


@query
def rows_from_index_nulls(spark: SparkSession, sf: str) -> DataFrame:
    rows = _typed(spark, sf)
    return ordering.rows_from_index(rows, KEYS, rows.count() * 3 // 4, **FAR).select("transaction_id", "timestamp")


@query
def time_split_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Cuts by id where the time is null for some rows, nulls last."""
    return split.time_split(_typed(spark, sf), KEYS, **FAR).select("transaction_id", "timestamp", "split")


@query
def time_split(spark: SparkSession, sf: str) -> DataFrame:
    return split.time_split(txn(spark, sf)).select("transaction_id", "timestamp", "split")


@query
def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    return split.hash_split(txn(spark, sf)).select("transaction_id", F.col("is_train").cast("int").alias("is_train"))


# Messages --------------------------------------------------------------------


def _messages(spark: SparkSession, sf: str) -> DataFrame:
    """Encoded transactions; some are no JSON, some have a field of the wrong type."""
    encoded = messages.encode(txn(spark, sf))
    part = hash_bucket("key", 50)
    value = (
        F.when(part == 7, F.concat(F.lit("broken "), "key"))
        .when(part == 8, F.regexp_replace("value", r'"Card_Age":\d+', '"Card_Age":"old"'))
        .otherwise(F.col("value"))
    )
    return encoded.withColumn("value", value)


@query
def json_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Deleted messages (null values), and nulls in arrays, are rejects like other values that are no message."""
    rows = stage(_messages(spark, sf), "messages")
    part = hash_bucket("key", 50)
    deleted = rows.withColumn("value", F.when(part != 9, F.col("value")))
    arrays = rows.where(part == 9).select(F.concat(F.lit("[null,"), "value", F.lit("]")).alias("value"))
    parts = []
    for name, decoded in (("values", messages.decode(deleted)), ("arrays", messages.array_items(arrays))):
        counts = decoded.agg(F.count_if(F.col(messages.CORRUPT).isNull()).alias("accepted"))
        bad = messages.rejected(decoded).groupBy("value", "reason").count()
        parts.append(counts.join(bad, F.lit(True)).withColumn("form", F.lit(name)))
    return parts[0].union(parts[1])


def _loose_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Short messages whose fields are not the same: one missing, one more, a text for a number, arrays, no JSON."""
    rows = txn(spark, sf).select("transaction_id", "card_age", "risk_score", "location")
    encoded, part = messages.encode(rows), hash_bucket("key", 50)
    age = r',"Card_Age":\d+'
    value = (
        F.when(part == 3, F.regexp_replace("value", age, ""))
        .when(part == 4, F.regexp_replace("value", r"^\{", '{"Free note":"by hand",'))
        .when(part == 5, F.regexp_replace("value", age, ',"Card_Age":"old"'))
        .when(part == 6, F.concat(F.lit("broken "), "key"))
        .when(part == 7, F.concat(F.lit("["), "value", F.lit(","), "value", F.lit(",5,null]")))
        .when(part == 8, F.lit("[]"))
        .when(part != 9, F.col("value"))
    )
    return encoded.withColumn("value", value)


@query
def json_infer(spark: SparkSession, sf: str) -> DataFrame:
    """Messages decoded by the fields that they turn out to have, good and bad."""
    objects = stage(messages.variants(_loose_messages(spark, sf)), "objects")
    schema = messages.inferred_schema(objects)
    return messages.decode_inferred(objects, schema).withColumnRenamed(messages.CORRUPT, "bad")


@query
def json_infer_schema(spark: SparkSession, sf: str) -> DataFrame:
    """The inferred fields and their types."""
    schema = messages.inferred_schema(messages.variants(_loose_messages(spark, sf)))
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema.fields], "field string, type string")


@query
def json_encode(spark: SparkSession, sf: str) -> DataFrame:
    return messages.encode(txn(spark, sf))


@query
def json_decode(spark: SparkSession, sf: str) -> DataFrame:
    decoded = messages.decode(_messages(spark, sf))
    return decoded.withColumn("bad", F.col(messages.CORRUPT).isNotNull().cast("int")).drop(messages.CORRUPT)


@query
def json_reject(spark: SparkSession, sf: str) -> DataFrame:
    return messages.rejected(messages.decode(_messages(spark, sf)))


def _arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Messages in JSON arrays; some values are no JSON, some arrays hold something that is no message."""
    encoded = messages.encode(txn(spark, sf))
    part = hash_bucket("key", 50)
    value = (
        F.when(part == 3, F.col("value"))
        .when(part == 4, F.lit("[]"))
        .when(part == 5, F.concat(F.lit("["), "value", F.lit(","), "value", F.lit("]")))
        .when(part == 6, F.concat(F.lit("no JSON "), "key"))
        .when(part == 7, F.concat(F.lit("["), "value", F.lit(',"'), "key", F.lit('"]')))
        .otherwise(F.concat(F.lit("["), "value", F.lit("]")))
    )
    return encoded.withColumn("value", value)


@query
def json_array_explode(spark: SparkSession, sf: str) -> DataFrame:
    return messages.explode_array(_arrays(spark, sf))


@query
def json_array_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return messages.array_rejects(_arrays(spark, sf))


@query
def message_types(spark: SparkSession, sf: str) -> DataFrame:
    decoded = messages.accepted(messages.decode(_messages(spark, sf)))
    return messages.type_message(decoded)


# Scores and metrics ----------------------------------------------------------


@query
def score_pinned(spark: SparkSession, sf: str) -> DataFrame:
    return _score(txn(spark, sf)).select("transaction_id", "fraud_label", "probability", "prediction")


@query
def score_join_back(spark: SparkSession, sf: str) -> DataFrame:
    raw = quality.type_rows(quality.filter_header(landing(spark, sf)))
    predictions = _score(raw).select("transaction_id", "prediction")
    return models.join_back(raw, predictions)


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return _score(txn(spark, sf)).select(
        F.col("probability").alias("score"), "prediction", F.col("fraud_label").alias("label")
    )


@query
def metric_auc(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.roc_auc(_labelled(spark, sf)).select(F.round("auc", 6).alias("auc"))


@query
def metric_confusion(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion(_labelled(spark, sf))


@query
def metric_weighted_pr(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.weighted_precision_recall(_labelled(spark, sf))
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query
def metrics_report(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.metrics_report(_labelled(spark, sf))


# Sources and sinks -----------------------------------------------------------


@query
def src_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    files.write_csv(txn(spark, sf), path)
    return files.read_csv(spark, path)


@query
def src_parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    files.write_parquet(txn(spark, sf), path)
    return files.read_parquet(spark, path)


@query
def src_external_table(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "external")
    rows = txn(spark, sf)
    files.write_csv(rows.select(*[F.col(f.name).alias(f.wire) for f in RAW_FIELDS]), path)
    name = f"ext_{uuid.uuid4().hex}"
    return _then_drop(files.external_table(spark, name, path).toDF(*RAW_COLUMNS), name)


def _then_drop(df: DataFrame, name: str) -> DataFrame:
    """The rows of a query on a table of its own, which goes."""
    rows = stage(df, "table")
    df.sparkSession.sql(f"DROP TABLE {text.name(name)}")
    return rows


@query
def src_catalog_scan(spark: SparkSession, sf: str) -> DataFrame:
    name = f"scan_{uuid.uuid4().hex}"
    CatalogTable(name, options={"path": scratch_path(spark, "scan")}).overwrite(txn(spark, sf))
    rows = scan(spark, name, "fraud_label = 1", ["transaction_id", "user_id", "transaction_amount"])
    return _then_drop(rows, name)


@query
def sink_insert_by_name(spark: SparkSession, sf: str) -> DataFrame:
    rows = txn(spark, sf).select("transaction_id", "user_id", "card_type", "device_type")
    late = hash_bucket("transaction_id") >= 60
    table = CatalogTable(f"sink_{uuid.uuid4().hex}", options={"path": scratch_path(spark, "sink")})
    table.append(rows.where(~late))
    table.append(rows.where(late).select("device_type", "card_type", "user_id", "transaction_id"))
    return _then_drop(table.read(spark), table.name)


@query
def load_full(spark: SparkSession, sf: str) -> DataFrame:
    target = PathTable(scratch_path(spark, "full"))
    rows = split.time_split(txn(spark, sf))
    jobs.full_load(rows.drop("split"), target)
    first = stage(target.read(spark), "first")
    jobs.full_load(rows.where("split = 'stream'").drop("split"), target)
    return first.withColumn("load", F.lit(1)).union(target.read(spark).withColumn("load", F.lit(2)))


@query
def load_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """A full load, then two increments with ties."""
    target = PathTable(scratch_path(spark, "load"))
    rows = txn(spark, sf)
    jobs.full_load(rows.where(F.col("timestamp") <= LAST), target)
    jobs.incremental_load(rows, target)
    jobs.incremental_load(rows, target)
    return target.read(spark).select("transaction_id", "timestamp")


@query
def import_new(spark: SparkSession, sf: str) -> DataFrame:
    target = PathTable(scratch_path(spark, "import"))
    rows = txn(spark, sf)
    jobs.full_load(rows.where(F.col("timestamp") <= LAST), target)
    jobs.import_new(rows, target)
    return target.read(spark)


@query
def split_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "split")
    jobs.split_to_files(txn(spark, sf), path)
    return files.read_csv(spark, path)


@query
def append_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends of delimited text to one folder."""
    path, rows = scratch_path(spark, "appended"), txn(spark, sf)
    late = hash_bucket("transaction_id") >= 60
    for part in (rows.where(~late), rows.where(late)):
        files.write_csv(part, path, mode="append")
    return files.read_csv(spark, path)


def _curate_in_steps(spark: SparkSession, sf: str, modes: list[str]) -> DataFrame:
    """Curate the landing table in time order, one part per mode."""
    rows = _typed(spark, sf)
    curated = PathTable(scratch_path(spark, "curated"))
    vocabulary = PathTable(scratch_path(spark, "vocabulary"))
    bounds = ["2024-01-19", "2024-01-25", None][-len(modes) :]
    for mode, bound in zip(modes, bounds, strict=True):
        part = rows.where(F.col("timestamp") < bound) if bound else rows
        jobs.curate(part, curated, vocabulary, mode)
    return curated.read(spark).drop("event_date")


@query
def curate_full(spark: SparkSession, sf: str) -> DataFrame:
    return _curate_in_steps(spark, sf, ["full"])


@query
def curate_incremental(spark: SparkSession, sf: str) -> DataFrame:
    return _curate_in_steps(spark, sf, ["auto", "auto", "incremental"])


def _array_table(spark: SparkSession, sf: str) -> DataFrame:
    table = CatalogTable(f"arrays_{uuid.uuid4().hex}", options={"path": scratch_path(spark, "arrays")})
    jobs.curate_arrays(_typed(spark, sf), table, PathTable(scratch_path(spark, "vocabulary")))
    return table.read(spark)


@query
def curate_arrays(spark: SparkSession, sf: str) -> DataFrame:
    table = _array_table(spark, sf)
    sizes = table.agg(*[F.max(F.size(f"{c}_arr")).alias(c) for c in CATEGORICALS]).first().asDict()
    return _flat_slots(table, sizes)


@query
def curate_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """What two curation runs put aside: the second sees all rows and adds only the missing ones."""
    rows = _typed(spark, sf)
    curated, vocabulary, rejects = (PathTable(scratch_path(spark, p)) for p in ("curated", "vocabulary", "rejects"))
    for part in (rows.where(hash_bucket("transaction_id") < 60), rows):
        jobs.curate(part, curated, vocabulary, rejects=rejects)
    return rejects.read(spark).select("transaction_id", "timestamp", "reason")


@query
def score_new(spark: SparkSession, sf: str) -> DataFrame:
    """Two scoring runs; the second sees all rows and adds only the missing ones."""
    rows = txn(spark, sf)
    predictions = PathTable(scratch_path(spark, "predictions"))
    jobs.score_new(rows.where(F.col("timestamp") <= LAST), predictions, _score)
    jobs.score_new(rows, predictions, _score)
    return predictions.read(spark).select("transaction_id", "probability", "prediction")


# Streams ---------------------------------------------------------------------


def _message_stream(spark: SparkSession, path: str) -> DataFrame:
    schema = spark.createDataFrame([], "key string, value string").schema
    return topics.read_files(spark, path, schema)


@query
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    source, sink, state = (scratch_path(spark, p) for p in ("topic", "ingested", "state"))
    _messages(spark, sf).write.parquet(source)
    pipelines.run(pipelines.ingest(_message_stream(spark, source), sink, state, trigger=pipelines.AVAILABLE_NOW))
    return pipelines.ingested(spark, sink)


@query
def stream_ingest_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Ingest to delimited text, with the time of ingest in a column of its own."""
    source, sink, state = (scratch_path(spark, p) for p in ("topic", "ingested", "state"))
    _messages(spark, sf).write.parquet(source)
    stream = _message_stream(spark, source)
    query = pipelines.ingest(stream, sink, state, "csv", trigger=pipelines.AVAILABLE_NOW, stamp="time_details")
    pipelines.run(query)
    # The sink has a column with the default name of the reader's own column for corrupt lines.
    reader = spark.read.option("header", True).option("columnNameOfCorruptRecord", "unreadable")
    rows = reader.csv(sink).where("rejected = 'false' AND time_details IS NOT NULL")
    return rows.select("transaction_id", "user_id", "card_age", "location")


@query
def stream_rejects(spark: SparkSession, sf: str) -> DataFrame:
    source, sink, state = (scratch_path(spark, p) for p in ("topic", "ingested", "state"))
    _messages(spark, sf).write.parquet(source)
    pipelines.run(pipelines.ingest(_message_stream(spark, source), sink, state, trigger=pipelines.AVAILABLE_NOW))
    return pipelines.ingest_rejects(spark, sink)


@query
def stream_restart(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs on one checkpoint; the second only takes the messages that came in between."""
    source, sink, state = (scratch_path(spark, p) for p in ("topic", "ingested", "state"))
    rows = _messages(spark, sf)
    late = hash_bucket("key") >= 60
    for part in (rows.where(~late), rows.where(late)):
        part.write.mode("append").parquet(source)
        stream = _message_stream(spark, source)
        pipelines.run(pipelines.ingest(stream, sink, state, trigger=pipelines.AVAILABLE_NOW))
    return pipelines.ingested(spark, sink)


@query
def stream_publish(spark: SparkSession, sf: str) -> DataFrame:
    source, sink, state = (scratch_path(spark, p) for p in ("rows", "topic", "state"))
    rows = txn(spark, sf)
    rows.write.parquet(source)
    stream = topics.read_files(spark, source, rows.schema)
    options = {"path": sink}
    pipelines.run(pipelines.publish(stream, state, "parquet", options, pipelines.AVAILABLE_NOW))
    return spark.read.parquet(sink)


@query
def stream_score(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs; the second redelivers some rows, which must not be scored again."""
    source, sink, state = (scratch_path(spark, p) for p in ("rows", "scored", "state"))
    rows = txn(spark, sf)
    part = hash_bucket("transaction_id")
    for delivered in (rows.where(part < 60), rows.where(part >= 40)):
        delivered.write.mode("append").parquet(source)
        stream = topics.read_files(spark, source, rows.schema)
        pipelines.run(pipelines.score_stream(stream, _score, sink, state, pipelines.AVAILABLE_NOW))
    return spark.read.parquet(sink).select("transaction_id", "probability", "prediction")


# Models ----------------------------------------------------------------------


@query
def rf_train_score(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage(jobs.feature_rows(_typed(spark, sf)), "features")
    model, test = jobs.train_forest(rows, VOCABULARY)
    return models.score(test, model, ["transaction_id", LABEL]).drop("probability")


@query
def evaluate_forest(spark: SparkSession, sf: str) -> DataFrame:
    """The metrics of a trained forest on its test part."""
    rows = stage(jobs.feature_rows(_typed(spark, sf)), "features")
    model, test = jobs.train_forest(rows, VOCABULARY, numTrees=20)
    return jobs.evaluate(model, test)


@query
def score_saved_forest(spark: SparkSession, sf: str) -> DataFrame:
    """Train and save a forest, load it in a scoring job and run that twice over growing input."""
    path, raw = scratch_path(spark, "forest"), _typed(spark, sf)
    jobs.train_forest(jobs.feature_rows(raw), VOCABULARY, path, numTrees=20)
    predictions, scorer = PathTable(scratch_path(spark, "predictions")), jobs.forest_scorer(path)
    jobs.score_new(raw.where(F.col("timestamp") <= LAST), predictions, scorer)
    jobs.score_new(raw, predictions, scorer)
    return predictions.read(spark).select("transaction_id", "user_id", LABEL, "prediction")


@query
def lr_train_score(spark: SparkSession, sf: str) -> DataFrame:
    model, test = jobs.train_arrays(_array_table(spark, sf), models.logistic(LABEL))
    return models.score(test, model, ["transaction_id", LABEL]).drop("probability")


@query
def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Save, load and compare: scored rows, and rows that break an invariant (none should)."""
    path = scratch_path(spark, "model")
    rows = split.hash_split(_v36(spark, sf))
    model = models.train(rows.where("is_train"), features.v36_inputs(), models.forest(LABEL, numTrees=20))
    models.save(model, path)
    test = rows.where("NOT is_train")
    again = models.load(path).transform(model.transform(test).withColumnsRenamed(
        {c: f"first_{c}" for c in ("features", "rawPrediction", "probability", "prediction")}
    ))
    p, q = vector_to_array("probability"), vector_to_array("first_probability")
    argmax = F.when(F.get(p, F.lit(1)) > F.get(p, F.lit(0)), 1.0).otherwise(0.0)
    total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
    return again.agg(
        F.count("*").alias("n_scored"),
        F.count_if((p != q) | (F.col("prediction") != F.col("first_prediction"))).alias("n_changed"),
        F.count_if(F.abs(total - 1) > 1e-9).alias("n_not_one"),
        F.count_if(F.col("prediction") != argmax).alias("n_not_argmax"),
    )


# Tables that grow and are replaced ---------------------------------------------------


@query
def load_swap(spark: SparkSession, sf: str) -> DataFrame:
    """Two full curations and one that fails while it writes: table and vocabulary stay those of the second."""
    rows = _typed(spark, sf)
    table = VersionedTable(f"curated_{uuid.uuid4().hex}", scratch_path(spark, "versions"))
    vocabulary = Companion(table, "vocabulary")
    jobs.curate(rows.where(F.col("timestamp") < "2024-01-19"), table, vocabulary, "full")
    jobs.curate(rows, table, vocabulary, "full")
    broken = F.expr("if(rand() >= 0, cast(raise_error('no more rows') AS string), location)")
    try:
        jobs.curate(rows.withColumn("location", broken), table, vocabulary, "full")
    except Exception as error:  # the message of the planted failure, however Spark wraps it
        if "no more rows" not in str(error):
            raise
    labels = features.labels_of(vocabulary.read(spark))
    out = stage(table.read(spark).select(*RAW_COLUMNS, *features.onehot_columns(labels), *CALENDAR), "table")
    spark.sql(f"DROP VIEW {table.quoted}")
    return out


@query
def watermark_footer(spark: SparkSession, sf: str) -> DataFrame:
    """The newest time of a folder, before and after an append, from the files' footers."""
    table, rows = PathTable(scratch_path(spark, "footers"), micros=["timestamp"]), txn(spark, sf)
    out = []
    for part in (F.col("timestamp") <= LAST, F.col("timestamp") > LAST):
        table.append(rows.where(part))
        out.append(stage(incremental.watermark(table.newest(spark, "timestamp")), "watermark"))
    return out[0].withColumn("load", F.lit(1)).union(out[1].withColumn("load", F.lit(2)))


@query
def catalog_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Dates that other writers finished: some told to the catalog one by one, the rest taken over at the end."""
    path, rows = scratch_path(spark, "dates"), txn(spark, sf).select("transaction_id", "timestamp")
    rows = rows.withColumn("event_date", F.to_date("timestamp"))
    ddl = "transaction_id string, timestamp timestamp, event_date date"
    table = partitioned_table(spark, f"dates_{uuid.uuid4().hex}", path, ddl, ["event_date"])
    rows.write.mode("append").partitionBy("event_date").parquet(path)
    for day in ("2024-01-10", "2024-01-12"):
        table.add_partition(spark, {"event_date": day})
    wanted = "event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-14'"
    told = stage(scan(spark, table.name, wanted, ["transaction_id", "event_date"]), "told")
    table.recover_partitions(spark)
    every = scan(spark, table.name, wanted, ["transaction_id", "event_date"])
    both = told.withColumn("step", F.lit(1)).union(every.withColumn("step", F.lit(2)))
    return _then_drop(both, table.name)


@query
def score_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Three scoring runs over growing input; the history is joined bucket by bucket."""
    rows = txn(spark, sf)
    path = {"path": scratch_path(spark, "bucketed")}
    predictions = BucketedTable(f"bucketed_{uuid.uuid4().hex}", "transaction_id", 8, path)
    for part in (hash_bucket("transaction_id") < 30, hash_bucket("transaction_id") < 70, F.lit(True)):
        jobs.score_new(rows.where(part), predictions, _score)
    return _then_drop(predictions.read(spark).select("transaction_id", "probability", "prediction"), predictions.name)


@query
def vocab_merge(spark: SparkSession, sf: str) -> DataFrame:
    """A vocabulary over three increments; user ids are many labels, and each increment brings new ones."""
    rows, columns, ts = _typed(spark, sf), [*CATEGORICALS, "user_id"], F.col("timestamp")
    parts = [rows.where(ts < "2024-01-02"), rows.where((ts >= "2024-01-02") & (ts < "2024-01-04")), rows.where(ts >= "2024-01-04")]
    vocabulary = stage(features.label_vocab(parts[0], columns), "vocabulary")
    for part in parts[1:]:
        vocabulary = stage(features.merge_vocab(vocabulary, part, columns), "vocabulary")
    return vocabulary.withColumn("idx", F.col("idx").cast("int"))


@query
def score_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """What two runs of a saved forest put aside, each row once, and how many rows of the input are in neither."""
    path, raw = scratch_path(spark, "forest"), stage(_typed(spark, sf), "raw")
    jobs.train_forest(jobs.feature_rows(raw), VOCABULARY, path, numTrees=3)
    predictions, rejects = (PathTable(scratch_path(spark, p)) for p in ("predictions", "rejects"))
    for part in (raw.where(hash_bucket("transaction_id") < 60), raw):
        jobs.score_new(part, predictions, jobs.forest_scorer(path), rejects=rejects)
    bad = rejects.read(spark)
    # Ids and hashes stand for rows, as not_seen compares them: whole rows are not shuffled, and copies only where missing.
    hashed = incremental.hashed_rows(quality.filter_header(raw), raw.columns)
    missing = incremental.not_processed(hashed, predictions.read(spark))
    missing = quality.drop_duplicate_rows(incremental.not_seen(missing, incremental.hashed_rows(bad, raw.columns), ["row_hash"]))
    return bad.select("transaction_id", "timestamp", "reason").join(missing.agg(F.count(F.lit(1)).alias("n_missing")), F.lit(True))


# Streams with state or a position -----------------------------------------------------


DELAY = "40 days"  # longer than the given tables, whose parts are delivered out of order


@query
def stream_score_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs; the second redelivers some rows, which the state store knows."""
    source, sink, state = (scratch_path(spark, p) for p in ("rows", "scored", "state"))
    rows = txn(spark, sf)
    part = hash_bucket("transaction_id")
    for delivered in (rows.where(part < 60), rows.where(part >= 40)):
        delivered.write.mode("append").parquet(source)
        stream = topics.read_files(spark, source, rows.schema)
        pipelines.run(pipelines.score_once(stream, _score, sink, state, DELAY, pipelines.AVAILABLE_NOW))
    return spark.read.parquet(sink).select("transaction_id", "probability", "prediction")


@query
def stream_score_forest(spark: SparkSession, sf: str) -> DataFrame:
    """A saved forest over a stream of landing rows, some of them delivered twice."""
    path, raw = scratch_path(spark, "forest"), stage(_typed(spark, sf), "raw")
    jobs.train_forest(jobs.feature_rows(raw), VOCABULARY, path, numTrees=20)
    source, sink, state = (scratch_path(spark, p) for p in ("rows", "scored", "state"))
    scorer = jobs.forest_scorer(path, distinct=False)
    for delivered in (raw, raw.where(hash_bucket("transaction_id") < 30)):
        delivered.write.mode("append").parquet(source)
        stream = topics.read_files(spark, source, raw.schema)
        pipelines.run(pipelines.score_once(stream, scorer, sink, state, DELAY, pipelines.AVAILABLE_NOW))
    return spark.read.parquet(sink).select("transaction_id", "user_id", LABEL, "prediction")


@query
def stream_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The metrics of a stream's rows so far, from the counts that it keeps."""
    source, state, name = scratch_path(spark, "rows"), scratch_path(spark, "state"), f"tally_{uuid.uuid4().hex}"
    rows = txn(spark, sf)
    rows.repartition(6, "transaction_id").write.parquet(source)
    stream = _score(topics.read_files(spark, source, rows.schema, files_per_batch=2))
    scored = stream.select(F.col("probability").alias("score"), "prediction", F.col("fraud_label").alias("label"))
    pipelines.run(pipelines.tally_stream(scored, name, state, trigger=pipelines.AVAILABLE_NOW))
    tally = stage(spark.table(name), "tally")
    spark.catalog.dropTempView(name)
    return metrics.report_of(tally)


def _publish_from(spark: SparkSession, sf: str, start: str | tuple[datetime, str]) -> DataFrame:
    """Two runs that publish a growing table from a position; rows arrive by day, in between."""
    table, rows = PathTable(scratch_path(spark, "rows"), micros=["timestamp"]), txn(spark, sf)
    sink, state = (scratch_path(spark, p) for p in ("topic", "state"))
    for part in (F.col("timestamp") < "2024-01-22", F.col("timestamp") >= "2024-01-22"):
        days = rows.where(part).withColumn("event_date", F.to_date("timestamp"))
        table.append(days.repartition(4, "event_date"), ["event_date"])
        stream = read_keyset(spark, table.path, rows.schema, "timestamp__micros", start=start)
        pipelines.run(pipelines.publish(stream, state, "parquet", {"path": sink}, pipelines.AVAILABLE_NOW))
    return spark.read.schema("key string, value string").parquet(sink)


@query
def stream_from_keyset(spark: SparkSession, sf: str) -> DataFrame:
    """Published from the rows above a time and an id on."""
    rows = txn(spark, sf).where(F.col("timestamp") > LAST)
    key = F.struct(F.col("timestamp").cast("string").alias("at"), "transaction_id")
    first = rows.agg(F.min(key).alias("k")).first()["k"]
    return _publish_from(spark, sf, (datetime.fromisoformat(first["at"]), first["transaction_id"]))


@query
def stream_from_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Published from the rows that came after the stream had begun."""
    return _publish_from(spark, sf, "latest")
