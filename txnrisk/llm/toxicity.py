"""Toxicity: a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

A text's features are the hashed buckets of its character n-grams, each counted once; white space
runs are one blank and A-Z is lower-cased. From the labelled rows come the counts of texts by
bucket and label, and from these each bucket's log-count ratio. A logistic regression is fitted on
the ratios of the buckets that a text has; its weight times the ratio is what a bucket adds to a
score.

The fit takes a bounded sample of the labelled rows (``train_rows``, by a hash of the key); every
text is scored, whole, against the broadcast table of bucket weights, whose size is fixed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import ship, with_fields
from txnrisk.llm.steps import Steps

BUCKETS = 1 << 18
SIZES = (3, 4, 5)
SPACE = re.compile(r"\s+")
TRAIN_ROWS = 20_000  # labelled rows that a fit takes at most


def buckets_of(text: str | None, scratch: np.ndarray) -> np.ndarray:
    """Distinct buckets of a text's n-grams. ``scratch`` is a cleared array of flags of all buckets."""
    clean = " " + SPACE.sub(" ", text or "").strip().encode().lower().decode() + " "
    codes = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    for size in SIZES:
        if len(codes) < size:
            break
        rolled = codes[: len(codes) - size + 1] + np.uint64(size)
        for i in range(1, size):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + codes[i : len(codes) - size + 1 + i]
        rolled = (rolled ^ (rolled >> np.uint64(31))) * np.uint64(0xC4CEB9FE1A85EC53)
        scratch[(rolled >> np.uint64(64 - 18)).astype(np.int64)] = True
    found = np.flatnonzero(scratch)
    scratch[found] = False
    return found


def feature_batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``label`` and ``features`` of texts, given out in small runs: they are larger than the texts."""
    scratch = np.zeros(BUCKETS, bool)
    for frame in frames:
        for start in range(0, len(frame), 128):
            run = frame.iloc[start : start + 128]
            found = [buckets_of(t, scratch).astype(np.int32) for t in run["text"]]
            yield pd.DataFrame({"label": run["label"], "features": found})


def ratios(pairs: DataFrame, smoothing: float) -> tuple[np.ndarray, float]:
    """Log-count ratio of each bucket, from (label, features); and the share of label 1.

    What comes to the driver is at most a row for each bucket.
    """
    totals = {r["label"]: r["n"] for r in pairs.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = (
        pairs.select("label", F.explode("features").alias("bucket"))
        .groupBy("bucket")
        .agg(F.sum("label").alias("ones"), F.count(F.lit(1)).alias("n"))
        .toPandas()
    )
    ones, zeros = np.zeros(BUCKETS), np.zeros(BUCKETS)
    ones[counts["bucket"]] = counts["ones"]
    zeros[counts["bucket"]] = counts["n"] - counts["ones"]
    n_one, n_zero = totals.get(1, 0), totals.get(0, 0)
    share = (n_one + 1) / (n_one + n_zero + 2)
    # Counts against those expected if the label did not matter: rare buckets stay near 0.
    n = ones + zeros
    table = np.log((ones + smoothing) / (n * share + smoothing)) - np.log((zeros + smoothing) / (n * (1 - share) + smoothing))
    return table, share


def draw(
    labelled: DataFrame, key: str = "doc_id", label: str = "label", train_rows: int = TRAIN_ROWS, seed: int = 11
) -> DataFrame:
    """About ``train_rows`` of the rows with a label of 0 or 1, by a hash of the key; all, if fewer.

    Rows of one key, and those without a key, are drawn together. Needs no text: draw before texts are joined.
    """
    known = labelled.where(F.col(f"`{label}`").isin(0, 1))
    n = known.count()
    if n <= train_rows:
        return known
    place = F.pmod(F.xxhash64(F.lit(seed), F.col(f"`{key}`")), F.lit(1 << 20))
    return known.where(place < int((1 << 20) * train_rows / n))


def fit(
    labelled: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "label",
    train_rows: int = TRAIN_ROWS,
    penalty: float = 0.001,
    smoothing: float = 1.0,
    least_ratio: float = 0.5,
    seed: int = 11,
) -> tuple[np.ndarray, float]:
    """Weights of all buckets, and the intercept, from rows with a text and a label of 0 or 1.

    Rows with another or no label take no part. At most about ``train_rows`` rows are taken, by a
    hash of the key. Buckets whose ratio is nearer to 0 than ``least_ratio`` say little and get no
    weight. With rows of one label only, or none, there are no weights: every text gets the share
    of label 1, smoothed by one row of each.
    """
    ship(labelled.sparkSession)
    steps = Steps(labelled.sparkSession, "toxicity")
    known = draw(labelled, key, label, train_rows, seed)
    texts = known.select(F.col(f"`{label}`").cast("int").alias("label"), F.col(f"`{text}`").alias("text"))
    rows = steps.put("features", texts.mapInPandas(feature_batches, "label int, features array<int>"))
    table, base = ratios(rows, smoothing)
    table[np.abs(table) < least_ratio] = 0.0
    weights = np.zeros(BUCKETS)
    if rows.select("label").distinct().count() < 2:
        return weights, float(np.log(base / (1 - base)))
    shared = labelled.sparkSession.sparkContext.broadcast(table)

    @F.udf(VectorUDT())
    def scaled(found: list[int]):
        at = np.array(found, np.int64)
        at = at[shared.value[at] != 0]
        return Vectors.sparse(BUCKETS, at.tolist(), shared.value[at].tolist())

    vectors = steps.put("vectors", rows.select("label", scaled("features").alias("scaled")))
    learner = LogisticRegression(
        featuresCol="scaled", labelCol="label", regParam=penalty, standardization=False, maxIter=60, tol=1e-5
    )
    model = learner.fit(vectors)
    weights = model.coefficients.toArray() * table
    steps.drop("features", "vectors")
    return weights, float(model.intercept)


def score(df: DataFrame, weights: np.ndarray, intercept: float, text: str = "text", name: str = "score") -> DataFrame:
    """Append the chance, from 0 to 1, that a text has label 1.

    A null or empty text has the n-grams of no words. Texts are scored whole. Rows are neither
    dropped nor joined; a column that has the name of the output is replaced.
    """
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast((weights.astype(np.float32), intercept))

    def score_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scratch = np.zeros(BUCKETS, bool)
        table, start = shared.value
        for texts in batches:
            sums = [start + float(table[buckets_of(t, scratch)].sum(dtype=np.float64)) for t in texts]
            yield pd.Series(1 / (1 + np.exp(-np.clip(sums, -500, 500))))

    scored = F.pandas_udf(score_batches, "double")
    return with_fields(df, F.struct(scored(F.col(f"`{text}`")).alias(name)), [name])
