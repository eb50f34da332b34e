"""The jobs: split, load, curate, train and score."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.functions import clean_user_id, text
from txnrisk.operators import features, incremental, metrics, models, quality
from txnrisk.operators.split import hash_split, time_split
from txnrisk.schemas import CATEGORICALS, LABEL, VOCABULARY
from txnrisk.sources.files import write_csv
from txnrisk.sources.scratch import remove, scratch_path, stage
from txnrisk.sources.tables import PathTable, Table
from txnrisk.sources.versions import MAIN, Companion, VersionedTable

KEYS = ("timestamp", "transaction_id")


def split_to_files(df: DataFrame, path: str, keys: Sequence[str] = KEYS) -> None:
    """Write the three load parts as header CSV under ``split=<part>``."""
    write_csv(time_split(df, keys), path, partition_by=["split"])


def full_load(df: DataFrame, target: Table) -> None:
    """Replace the target table. Also used for the table that feeds the stream."""
    target.overwrite(df)


def incremental_load(
    df: DataFrame, target: Table, limit: int = incremental.BATCH, ts: str = "timestamp", with_ties: bool = True
) -> bool:
    """Append the oldest rows newer than the target's watermark; False when there are none."""
    last = incremental.watermark_value(target.newest(df.sparkSession, ts), ts)
    if incremental.newer_than(df, last, ts).isEmpty():
        return False
    target.append(incremental.oldest_batch(df, last, limit, ts, with_ties=with_ties))
    return True


def import_new(source: DataFrame, target: Table, ts: str = "timestamp") -> None:
    """Append everything newer than the target's watermark."""
    last = incremental.watermark_value(target.newest(source.sparkSession, ts), ts)
    target.append(incremental.newer_than(source, last, ts))


def normalized(df: DataFrame) -> DataFrame:
    """Clean rows with numeric user id, normalised categories and calendar features."""
    changes = {"user_id": text.clean_user_id("user_id")}
    changes |= {c: text.normalize_category(c) for c in CATEGORICALS}
    return text.with_columns(quality.clean_rows(df), {**changes, **text.calendar_features("timestamp")})


def feature_rows(df: DataFrame, labels: Mapping[str, Sequence[str]] = VOCABULARY) -> DataFrame:
    """Rows ready for the flattened feature vector, id and categories kept."""
    return features.onehot_named(normalized(df), labels)


def curate(
    raw: DataFrame,
    curated: Table | VersionedTable,
    vocabulary: PathTable | Companion,
    mode: str = "auto",
    since: Column | None = None,
    rejects: Table | None = None,
) -> None:
    """Write the curated feature table.

    ``full`` fits the vocabulary, stores it and replaces the table. ``incremental``
    adds rows whose id is not there yet and keeps the stored vocabulary, so columns
    never move and a new label is all zeros. ``auto`` is incremental once the table
    exists. ``since`` limits an incremental run to newer rows. ``rejects`` gets the rows
    that cleaning drops for a null, with the reason; a row that is there already is not cleaned again.

    A ``VersionedTable`` and its companion as ``vocabulary`` are replaced as one: readers never see columns
    of one fit with the labels of another. Other tables are written one after the other.
    """
    spark = raw.sparkSession
    if mode == "auto":
        mode = "incremental" if curated.exists(spark) else "full"
    if mode == "full":
        # Staged once: the fit reads six columns of it, the projection the rest.
        path = scratch_path(spark, "normalized")
        normalized(raw).write.parquet(path)
        rows = spark.read.parquet(path)
        labels = features.labels_of(features.label_vocab(rows))
        if rejects is not None:
            rejects.overwrite(quality.null_rejects(raw))
        if isinstance(curated, VersionedTable):
            parts = {MAIN: _by_date(features.onehot_named(rows, labels)), vocabulary.part: features.label_vocab(rows)}
            curated.publish(parts, partition_by=["event_date"])
            remove(spark, path)
            return
        # The table first: were its write to fail, the old table and the old vocabulary still belong together.
        curated.overwrite(_by_date(features.onehot_named(rows, labels)), partition_by=["event_date"])
        vocabulary.overwrite(features.label_vocab(rows))
        remove(spark, path)
        return
    done = curated.read(spark)
    if since is not None:
        raw, done = (incremental.newer_than(d, since) for d in (raw, done))
    labels = features.labels_of(vocabulary.read(spark))
    fresh = incremental.not_processed(raw, done)
    if rejects is not None:
        if rejects.exists(spark):
            fresh = incremental.not_seen(fresh, rejects.read(spark), raw.columns)
        rejects.append(quality.null_rejects(fresh))
    rows = features.onehot_named(normalized(fresh), labels)
    curated.append(_by_date(rows), partition_by=["event_date"])


def curate_arrays(raw: DataFrame, target: Table, vocabulary: PathTable) -> None:
    """Write the array feature table: one ``array<double>`` per category in place of its text.

    Rows with nulls stay, and labels are taken as they are. The table is Parquet or a
    catalog table: delimited text cannot hold arrays.
    """
    rows = quality.drop_duplicate_rows(quality.filter_header(raw))
    rows = stage(rows.withColumn("user_id", clean_user_id("user_id", anchored=False)), "distinct")
    vocabulary.overwrite(features.label_vocab(rows))
    labels = features.labels_of(vocabulary.read(raw.sparkSession))
    target.overwrite(features.onehot_arrays(rows, labels).drop(*CATEGORICALS))


def _by_date(df: DataFrame) -> DataFrame:
    """Add the partition column. Rebalancing writes few files per date and splits a hot date."""
    return df.withColumn("event_date", F.to_date("timestamp")).hint("rebalance", "event_date")


def train_forest(
    curated: DataFrame, labels: Mapping[str, Sequence[str]], path: str | None = None, **params: object
) -> tuple[PipelineModel, DataFrame]:
    """Fit a forest on the train part; returns the model and the test part."""
    rows = hash_split(curated)
    inputs = features.v40_inputs(labels)
    rows = quality.drop_null_rows(rows, inputs)
    model = models.train(rows.where("is_train"), inputs, models.forest(LABEL, **params))
    if path:
        models.save(model, path, overwrite=True)
    return model, rows.where("NOT is_train").drop("is_train")


def train_arrays(
    table: DataFrame, classifier: models.Classifier, path: str | None = None
) -> tuple[PipelineModel, DataFrame]:
    """Fit a classifier on the array feature table; returns the model and the test part.

    An existing model at ``path`` is an error.
    """
    vectors = features.arrays_to_vectors(table, [f"{c}_arr" for c in CATEGORICALS])
    rows = quality.drop_null_rows(hash_split(vectors), features.v36_inputs())
    model = models.train(rows.where("is_train"), features.v36_inputs(), classifier)
    if path:
        models.save(model, path)
    return model, rows.where("NOT is_train").drop("is_train")


def evaluate(model: PipelineModel, test: DataFrame, label: str = LABEL) -> DataFrame:
    """AUC, weighted precision and weighted recall of a model, one row each."""
    scored = models.score(test, model, [label])
    return metrics.metrics_report(scored, "probability", "prediction", label)


def score_new(
    raw: DataFrame,
    predictions: Table,
    score: Callable[[DataFrame], DataFrame],
    since: Column | None = None,
    rejects: Table | None = None,
) -> None:
    """Score rows whose id has no prediction yet and append them.

    ``since`` limits the run to newer rows, of the input and of the predictions alike, so the
    history that is read stays bounded; a ``BucketedTable`` keeps it from being shuffled. There is no
    emptiness test first: it would run the anti join twice.

    ``rejects`` gets the rows that the scorer cannot score, with the reason (``score.rejects``); what is there
    counts as done. Predictions, rejects, header rows, rows without an id and copies add up to the input.
    """
    spark = raw.sparkSession
    fresh = raw if since is None else incremental.newer_than(raw, since)
    if predictions.exists(spark):
        done = predictions.read(spark)
        if since is not None:
            done = incremental.newer_than(done, since)
        fresh = incremental.not_processed(fresh, done)
    if rejects is not None:
        if rejects.exists(spark):
            fresh = incremental.not_seen(fresh, rejects.read(spark), raw.columns)
        path = scratch_path(spark, "fresh")
        fresh.write.parquet(path)  # the same rows are scored and rejected
        fresh = spark.read.schema(fresh.schema).parquet(path)
        rejects.append(score.rejects(fresh))
        predictions.append(score(fresh))
        remove(spark, path)
        return
    predictions.append(score(fresh))


def forest_scorer(
    path: str, labels: Mapping[str, Sequence[str]] = VOCABULARY, distinct: bool = True
) -> Callable[[DataFrame], DataFrame]:
    """A scorer from a saved forest: clean, encode by the fixed vocabulary, score; raw columns stay.

    Its ``rejects`` gives the distinct rows that it leaves out, with the reason. Without ``distinct`` copies are
    scored as often as they come, row by row, as streams need it.
    """
    model = models.load(path)

    def score(raw: DataFrame) -> DataFrame:
        kept = {f"raw_{c}": text.name(c) for c in (*CATEGORICALS, "user_id")}
        changes = {"user_id": text.clean_user_id("user_id")}
        changes |= {c: text.normalize_category(c) for c in CATEGORICALS}
        clean = quality.clean_rows(raw) if distinct else quality.drop_null_rows(quality.filter_header(raw))
        rows = text.with_columns(text.with_columns(clean, kept), changes)
        ready = features.onehot_named(features.with_calendar(rows), labels)
        inputs = features.v40_inputs(labels)
        scored = models.score(quality.drop_null_rows(ready, inputs), model)
        columns = [f"raw_{c} AS {text.name(c)}" if f"raw_{c}" in kept else text.name(c) for c in raw.columns]
        return scored.selectExpr(*columns, "prediction", "probability")

    def rejects(raw: DataFrame) -> DataFrame:
        no_number = F.when(F.col("user_id").isNotNull() & clean_user_id("user_id").isNull(), F.lit("user_id is no number"))
        return quality.null_rejects(raw, extra=[no_number])

    score.rejects = rejects
    return score
