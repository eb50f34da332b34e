"""Quality of scored rows, as small tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _tally(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per distinct combination; copies are combined before the shuffle."""
    return df.groupBy(*columns).agg(F.count("*").alias("n_rows"))


def roc_auc(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Exact area under the ROC curve, ties counted half. Null when a class is missing.

    Rows without a score or a label take no part; ``unscored`` counts them.
    """
    return _auc(df.withColumn("n_rows", F.lit(1)), score, label)


def unscored(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Rows that the area leaves out, one number."""
    return df.agg(F.count_if(F.col(score).isNull() | F.col(label).isNull()).alias("n_unscored"))


def _auc(tally: DataFrame, score: str, label: str) -> DataFrame:
    """Area from row counts.

    Counts are combined per distinct score, which absorbs a hot score. The distinct
    scores are range partitioned; each range adds up its own pairs, and the ranges
    (one row per shuffle partition) are combined at the end.
    """
    known = tally.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    scores = known.groupBy(score).agg(
        F.sum(F.expr(f"CASE WHEN {label} = 1 THEN n_rows ELSE 0 END")).cast("double").alias("pos"),
        F.sum(F.expr(f"CASE WHEN {label} = 1 THEN 0 ELSE n_rows END")).cast("double").alias("neg"),
    )
    ranged = scores.repartitionByRange(score).withColumn("part", F.spark_partition_id())
    below = Window.partitionBy("part").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("neg_below", F.coalesce(F.sum("neg").over(below), F.lit(0.0)))
    parts = placed.groupBy("part").agg(
        F.expr("sum(pos * (neg_below + neg / 2))").alias("pairs"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifted = parts.withColumn("neg_before", F.coalesce(F.sum("neg").over(earlier), F.lit(0.0)))
    return shifted.selectExpr("try_divide(sum(pairs + pos * neg_before), sum(pos) * sum(neg)) AS auc")


def confusion(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Rows per (label, prediction)."""
    return _confusion(_tally(df, label, prediction), prediction, label)


def _confusion(tally: DataFrame, prediction: str, label: str) -> DataFrame:
    return tally.groupBy(
        F.expr(f"cast({label} AS double)").alias("label"), F.expr(f"cast({prediction} AS double)").alias("prediction")
    ).agg(F.sum("n_rows").alias("n_rows"))


def weighted_precision_recall(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Per-class precision and recall weighted by class size.

    A class that is never predicted has precision 0. Weighted recall equals accuracy.
    """
    return _weighted(confusion(df, prediction, label))


def _weighted(counts: DataFrame) -> DataFrame:
    """Each cell of the confusion table counts once for its label and once for its prediction."""
    sides = counts.selectExpr(
        "stack(2, label, n_rows, 0L, if(label = prediction, n_rows, 0L), prediction, 0L, n_rows, 0L) "
        "AS (cls, actual, predicted, hits)"
    )
    classes = sides.groupBy("cls").agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "hits")])
    return classes.selectExpr(
        "try_divide(sum(actual * if(predicted > 0, hits / predicted, 0D)), sum(actual)) AS weighted_precision",
        "try_divide(cast(sum(hits) AS double), sum(actual)) AS weighted_recall",
    )


def metrics_report(
    df: DataFrame, score: str = "score", prediction: str = "prediction", label: str = "label", digits: int = 4
) -> DataFrame:
    """Metric name and rounded value, one row each.

    Both metrics start from one tally of the scored rows, whose shuffle Spark reuses:
    the rows are scored once.
    """
    return report_of(_tally(df, score, prediction, label), score, prediction, label, digits)


def report_of(
    tally: DataFrame, score: str = "score", prediction: str = "prediction", label: str = "label", digits: int = 4
) -> DataFrame:
    """``metrics_report`` from rows per (score, prediction, label), such as a running stream keeps."""
    area = _auc(tally, score, label).selectExpr("'AUC' AS metric", "auc AS value")
    both = _weighted(_confusion(tally, prediction, label)).selectExpr(
        "stack(2, 'Precision', weighted_precision, 'Recall', weighted_recall) AS (metric, value)"
    )
    return area.unionByName(both).select("metric", F.round("value", digits).alias("value"))
