"""Quality rules: exact statistics of a text, and robust outliers among them.

The statistics are transformed to a vector of whole numbers. For each language and source the
minimum covariance determinant estimate is found by concentration steps: keep the share ``h`` of
rows with the least Mahalanobis distances, take mean and covariance of those, repeat while the
determinant falls. Steps run from five starts; after two of them the two starts of least
determinant go on until they settle, and the least determinant of all is the estimate. Rows beyond
a quantile of the chi-squared distribution are rejected.

A step is two aggregations by group and start: counts by distance bin, whose running sum gives the
bin of the h-th row, then the sums of vectors and their products up to that bin. Both combine on
the map side, so a group of any size costs each task no more than its bins. The sums are
of whole numbers, so they do not depend on the order of rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm.common import remove, scratch_path, ship, with_fields
from txnrisk.llm.steps import Steps

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"  # fixed value: the symbols that count

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

# Vector: name, transformation of the statistics, and the least deviation that counts as one
# (the covariance gets its square: groups in which a statistic hardly varies stay usable).
FEATURES = (
    ("word_length", "ln(word_chars / n_words)", 0.08),
    ("symbols", "sqrt(n_symbols / n_words)", 0.07),
    ("dup_lines", "ln(1 + n_dup_lines)", 0.35),
    ("repeats", "sqrt(n_repeat_words / n_words)", 0.12),
)
UNIT = 1000  # a vector's numbers are in thousandths
BINS_PER_DOUBLING = 64
DOUBLINGS = 128  # distances beyond so many share a bin
SHRINK = 0.05  # share of the unit matrix in the starting correlations, which may be singular
SETTLED = 1e-4  # a step that lowers the determinant by a smaller share ends its start
FEW = 8  # tasks that hold the parameters, a row for each pool and start


def repeated_words(words: list[str], size: int = 3) -> int:
    """Words in windows of ``size`` words that stand in the text twice or more."""
    if len(words) <= size:
        return 0
    windows = list(zip(*(words[i:] for i in range(size)), strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    total, end = 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            total += at + size - max(at, end)
            end = at + size
    return total


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def statistics_of(text: str | None) -> tuple[int, int, int, int, int]:
    """The statistics of one text; a null text has no words."""
    text = text or ""
    words = WORD.findall(text)
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        duplicate_lines(text),
        repeated_words(words),
    )


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Append the statistics and ``base_failed`` (under 50 words, or over half in repeated windows).

    Null and empty texts have no words and fail. Texts are measured whole, however long. Rows are
    neither dropped nor joined; columns with a name of the output are replaced.
    """
    ship(df.sparkSession)

    def measure_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([statistics_of(t) for t in texts], columns=STATISTICS, dtype="int64")

    fields = ", ".join(f"{name} long" for name in STATISTICS)
    measured = F.pandas_udf(measure_batches, fields)
    out = with_fields(df, measured(F.col(text)), STATISTICS)
    return out.withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))


def chi_squared(share: float, degrees: int) -> float:
    """Quantile of the chi-squared distribution (Wilson and Hilferty)."""
    part = 2 / (9 * degrees)
    return degrees * (1 - part + NormalDist().inv_cdf(share) * math.sqrt(part)) ** 3


def pools(rows: DataFrame, least: int) -> DataFrame:
    """``both`` keys -> ``pool``: both where they have ``least`` rows; else the first key, for the
    rest of its rows, where those are as many; else the empty name."""
    small = F.col("n") < least
    counts = rows.groupBy("first", "both").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("rest", F.sum(F.when(small, F.col("n"))).over(Window.partitionBy("first")))
    pool = F.when(~small, F.col("both")).when(F.col("rest") >= least, F.col("first")).otherwise("")
    return counts.select("both", pool.alias("pool"))


def upper(matrix: np.ndarray) -> np.ndarray:
    """Upper triangle, row by row."""
    return matrix[np.triu_indices(len(matrix))]


def moments(n: int, sums: list[int], products: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance from counts, sums and sums of products (their upper triangle)."""
    mean = np.asarray(sums, float) / n
    square = np.zeros((len(mean), len(mean)))
    square[np.triu_indices(len(mean))] = np.asarray(products, float) / n
    return mean, np.triu(square) + np.triu(square, 1).T - np.outer(mean, mean)


def estimate_udf(scales: list[float]):
    """From counts, sums and sums of products: mean, inverse covariance (both flat), logarithm of the determinant."""

    def estimate(n: pd.Series, sums: pd.Series, products: pd.Series) -> pd.DataFrame:
        out = []
        for count, total, product in zip(n, sums, products, strict=True):
            mean, covariance = moments(count, total, product)
            covariance += np.diag(np.square(scales))
            out.append((mean, upper(np.linalg.inv(covariance)), np.linalg.slogdet(covariance)[1]))
        return pd.DataFrame(out, columns=["mean", "inverse", "det"])

    return F.pandas_udf(estimate, "mean array<double>, inverse array<double>, det double")


def start_udf():
    """From sums of transformed deviations, the medians and their deviations: a start's mean and inverse."""

    def begin(
        start: pd.Series, n: pd.Series, sums: pd.Series, products: pd.Series, mid: pd.Series, dev: pd.Series
    ) -> pd.DataFrame:
        out = []
        for name, count, total, product, middle, spread in zip(start, n, sums, products, mid, dev, strict=True):
            middle, spread = np.asarray(middle, float), np.asarray(spread, float)
            mean, covariance = moments(count, total, product)
            mean, covariance = mean / UNIT, covariance / UNIT**2
            if name == "rows":
                middle, spread = middle + mean * spread, spread * np.sqrt(np.diag(covariance) + SHRINK)
            root = np.sqrt(np.diag(covariance) + 1e-12)
            shape = (1 - SHRINK) * covariance / np.outer(root, root) + SHRINK * np.eye(len(root))
            out.append((middle, upper(np.linalg.inv(shape * np.outer(spread, spread)))))
        return pd.DataFrame(out, columns=["mean", "inverse"])

    return F.pandas_udf(begin, "mean array<double>, inverse array<double>")


def squared_distance(names: list[str]) -> Column:
    """Mahalanobis distance, squared, of the vector columns to ``mean`` under ``inverse``."""
    total, at = F.lit(0.0), 0
    gap = [F.col(name) - F.col("mean")[i] for i, name in enumerate(names)]
    for i in range(len(names)):
        for j in range(i, len(names)):
            total = total + gap[i] * gap[j] * F.col("inverse")[at] * (1 if i == j else 2)
            at += 1
    return F.greatest(total, F.lit(0.0))


def sums_of(values: list[Column]) -> list[Column]:
    """Count, sums and sums of products of whole-number columns."""
    pairs = [values[i] * values[j] for i in range(len(values)) for j in range(i, len(values))]
    return [
        F.count(F.lit(1)).alias("n"),
        F.array(*map(F.sum, values)).alias("sums"),
        F.array(*map(F.sum, pairs)).alias("products"),
    ]


def starts(vectors: DataFrame, names: list[str], scales: list[float]) -> DataFrame:
    """Five starts of each pool: pool, start, mean, inverse.

    All look at deviations from the medians, in units of the median deviation. ``alone``: each
    statistic for itself. The others take correlations of the deviations: ``rows`` as they are,
    around their mean; ``tanh`` and ``sign`` of each; ``sphere`` brought to length one.
    """
    medians = vectors.groupBy("pool").agg(*(F.percentile(n, F.lit(0.5)).alias(f"{n}_mid") for n in names))
    spread = vectors.join(medians, "pool").groupBy("pool").agg(
        *(F.percentile(F.abs(F.col(n) - F.col(f"{n}_mid")), F.lit(0.5)).alias(f"{n}_dev") for n in names)
    )
    devs = [F.sqrt(F.pow(1.4826 * F.col(f"{n}_dev"), 2) + scale**2) for n, scale in zip(names, scales, strict=True)]
    centres = medians.join(spread, "pool").select(
        "pool", F.array(*(F.col(f"{n}_mid") for n in names)).alias("mid"), F.array(*devs).alias("dev")
    )
    width = range(len(names))
    zero = F.lit(0.0)
    alone = F.array(*(1 / F.pow(F.col("dev")[i], 2) if i == j else zero for i in width for j in width if j >= i))
    alone = centres.select("pool", F.lit("alone").alias("start"), F.col("mid").alias("mean"), alone.alias("inverse"))
    z = [(F.col(n) - F.col("mid")[i]) / F.col("dev")[i] for i, n in enumerate(names)]
    length = F.sqrt(sum((x * x for x in z), zero))
    kinds = {
        "rows": z,
        "tanh": [F.tanh(x) for x in z],
        "sign": [F.signum(x) for x in z],
        "sphere": [F.when(length > 0, x / length).otherwise(zero) for x in z],
    }
    kinds = [
        F.struct(F.lit(kind).alias("start"), F.array(*(F.round(x * UNIT).cast("long") for x in of)).alias("z"))
        for kind, of in kinds.items()
    ]
    turned = vectors.join(centres, "pool").select("pool", F.inline(F.array(*kinds)))
    summed = turned.groupBy("pool", "start").agg(*sums_of([F.col("z")[i] for i in width])).join(centres, "pool")
    begun = summed.coalesce(FEW).withColumn("begun", start_udf()("start", "n", "sums", "products", "mid", "dev"))
    return alone.unionByName(begun.select("pool", "start", "begun.mean", "begun.inverse"))


def concentrate(
    vectors: DataFrame, params: DataFrame, names: list[str], scales: list[float], share: float, bins: int, least_step: float
) -> DataFrame:
    """One concentration step of each pool and start.

    The rows of the nearest bins that hold ``share`` of a pool give the new parameters. Where these
    do not lower the determinant the old ones stay and the start has ``settled``. ``scale`` is the
    median of the distances to the old ones against that of the chi-squared distribution.
    """
    by = ["pool", "start"]
    number = F.floor(F.least(F.log2(1 + squared_distance(names)), F.lit(DOUBLINGS)) * bins).cast("int")
    placed = vectors.join(params.select(*by, "mean", "inverse"), "pool").select(*by, *names, number.alias("bin"))
    counts = placed.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("n").over(Window.partitionBy(*by))
    ranked = counts.select(*by, "bin", F.coalesce(before, F.lit(0)).alias("before"), total.alias("total"))
    cuts = ranked.groupBy(*by).agg(
        F.max(F.when(F.col("before") < F.col("total") * share, F.col("bin"))).alias("cut"),
        F.max(F.when(F.col("before") < F.col("total") * 0.5, F.col("bin"))).alias("median_bin"),
    )
    near = placed.join(cuts, by).where("bin <= cut").groupBy(*by).agg(*sums_of([F.col(n) for n in names]))
    found = near.coalesce(FEW).withColumn("found", estimate_udf(scales)("n", "sums", "products")).select(*by, "found")
    middle = F.pow(2.0, (F.col("median_bin") + 0.5) / bins) - 1
    joined = params.drop("scale", "settled").join(found, by).join(cuts.drop("cut"), by)
    settled = F.col("found.det") > F.col("det") - least_step
    return joined.select(
        *by,
        *(F.when(settled, F.col(c)).otherwise(F.col(f"found.{c}")).alias(c) for c in ("mean", "inverse", "det")),
        F.greatest(middle / chi_squared(0.5, len(names)), F.lit(1.0)).alias("scale"),
        settled.alias("settled"),
    )


def estimates(
    vectors: DataFrame,
    names: list[str],
    scales: list[float],
    share: float,
    steps: int,
    least: int,
    bins: int = BINS_PER_DOUBLING,
    least_step: float = SETTLED,
) -> DataFrame:
    """The estimate of each pool with ``least`` rows: mean, inverse covariance, determinant, distance scale.

    The determinant is that of the covariance with the squares of ``scales`` added to its diagonal,
    given as a logarithm. ``steps``: most concentration steps of a start; ``bins``: distance bins
    for each doubling of the distance, the more the nearer a subset comes to ``share``. The rows of
    one bin stay together, and ties of the determinant go to the start first by name.
    ``least_step``: how far a step has to lower the logarithm for its start to go on.
    """
    table = Steps(vectors.sparkSession, "quality")
    large = vectors.groupBy("pool").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= least).select("pool")
    pooled = table.put("pooled", vectors.join(large, "pool"))
    begun = starts(pooled, names, scales).coalesce(FEW)
    params = table.put("params", begun.withColumn("det", F.lit(float("inf"))))
    best = Window.partitionBy("pool").orderBy("det", "start")
    for step in range(1, steps + 1):
        params = table.put("params", concentrate(pooled, params, names, scales, share, bins, least_step).coalesce(FEW))
        if step == 2:
            ranked = params.withColumn("place", F.row_number().over(best)).where("place <= 2").drop("place")
            params = table.put("params", ranked.coalesce(FEW))
        if params.where(~F.col("settled")).isEmpty():
            break
    chosen = params.withColumn("place", F.row_number().over(best)).where("place = 1")
    found = table.put("estimates", chosen.select("pool", "start", "mean", "inverse", "det", "scale").coalesce(FEW))
    table.drop("pooled", "params")
    return found


def judge(
    measured: DataFrame,
    keys: tuple[str, str] = ("lang", "source"),
    share: float = 0.75,
    steps: int = 10,
    least: int = 60,
    reject: float = 1e-9,
    again: bool = False,
) -> DataFrame:
    """Append ``distance`` and ``kept`` to rows that ``measure`` gave.

    Rows that fail the base rule are not kept and take no part in the estimates. The others are
    compared with their language and source (``keys``); sources with under ``least`` rows are
    taken together within their language, and languages where those are still fewer are taken
    together too. Where even these are fewer, nothing more is rejected and ``distance`` is null.
    ``share``: share of rows that an estimate keeps; ``reject``: share of regular rows beyond the
    limit.

    The rows are written once, with all their columns: leave out the text if it is not needed
    after, or measure ``again`` for the result, with which the numbers alone are written, and go once
    the limits are known. Null texts count as empty and fail. Null keys are a value like any other. Repeated rows
    count each time and get the same verdict. Columns with a name of the output are replaced.
    """
    spark, names, scales = measured.sparkSession, [f[0] for f in FEATURES], [f[2] * UNIT for f in FEATURES]
    columns = [c for c in measured.columns if c.lower() not in {"distance", "kept"}]
    first, second = (F.col(f"`{k}`").cast("string") for k in keys)
    path = scratch_path(spark, "quality-rows")
    prepared = measured.select(
        F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"),
        (~F.col("base_failed")).alias("good"),
        F.to_json(F.array(first)).alias("first"),
        F.to_json(F.array(first, second)).alias("both"),
        *(F.when(~F.col("base_failed"), F.round(F.expr(how) * UNIT).cast("long")).alias(n) for n, how, _ in FEATURES),
    )
    (prepared.drop("row") if again else prepared).write.parquet(path)
    rows = spark.read.parquet(path)
    good = rows.where("good")
    group_path, vector_path = scratch_path(spark, "quality-pools"), scratch_path(spark, "quality-vectors")
    pools(good, least).write.parquet(group_path)
    groups = spark.read.parquet(group_path)
    good.join(groups, "both").select("pool", *names).write.parquet(vector_path)
    found = estimates(spark.read.parquet(vector_path), names, scales, share, steps, least)
    remove(spark, vector_path)
    # A table of its own, so that its size is known: the whole rows are not dealt out by their few keys.
    known_path = scratch_path(spark, "quality-known")
    groups.join(found, "pool").select("both", "mean", "inverse", "scale").write.parquet(known_path)
    remove(spark, group_path)
    if again:
        remove(spark, path)
        rows = prepared
    placed = rows.join(spark.read.parquet(known_path), "both", "left")
    distance = F.when(F.col("good"), squared_distance(names) / F.col("scale"))
    limit = chi_squared(1 - reject, len(names))
    # One comparison: a filter on it stays above the join, where a filter on ``good`` would measure once more.
    kept = F.coalesce(F.when(F.col("good"), F.coalesce(distance, F.lit(0.0))), F.lit(float("inf"))) <= limit
    return placed.select("row.*", distance.alias("distance"), kept.alias("kept"))
