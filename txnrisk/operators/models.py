"""Training, saving and applying classifiers with Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.functions import linear_score
from txnrisk.schemas import LABEL, V36_BLOCKS, V36_SCALARS, VOCABULARY

# Forest size, depth and seed.
FOREST = {"numTrees": 100, "maxDepth": 5, "seed": 42}


Classifier = RandomForestClassifier | LogisticRegression


def forest(label: str = LABEL, **params: object) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, featuresCol="features", **{**FOREST, **params})


def logistic(label: str = LABEL, **params: object) -> LogisticRegression:
    return LogisticRegression(labelCol=label, featuresCol="features", **params)


def train(
    df: DataFrame,
    inputs: Sequence[str],
    classifier: Classifier,
    invalid: str = "error",
) -> PipelineModel:
    """Fit assembler and classifier.

    Both learners pass over their input many times, so it is kept (memory, then disk)
    during the fit; a lost executor only recomputes its own partitions.
    """
    needed = [*dict.fromkeys(inputs), classifier.getLabelCol()]
    kept = df.select(*needed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        assembler = VectorAssembler(inputCols=list(inputs), outputCol="features", handleInvalid=invalid)
        return Pipeline(stages=[assembler, classifier]).fit(kept)
    finally:
        kept.unpersist()


def save(model: PipelineModel, path: str, overwrite: bool = False) -> None:
    """Without ``overwrite`` an existing model is an error."""
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(df: DataFrame, model: PipelineModel, keep: Sequence[str] | None = None) -> DataFrame:
    """Add ``prediction`` and ``probability`` (of class 1) to the columns in ``keep``.

    Raw columns travel through the model, so no join back is needed: no shuffle, and
    copies of an id do not multiply.
    """
    scored = model.transform(df)
    positive = F.get(vector_to_array("probability"), F.lit(1))
    return scored.select(*(keep or df.columns), "prediction", positive.alias("probability"))


def score_vectors(df: DataFrame, model: PipelineModel, features: str = "features") -> DataFrame:
    """Score rows that already hold a feature vector: only the classifier of the pipeline runs."""
    classifier = model.stages[-1]
    renamed = df.withColumnRenamed(features, classifier.getFeaturesCol())
    scored = classifier.transform(renamed).withColumnRenamed(classifier.getFeaturesCol(), features)
    positive = F.get(vector_to_array("probability"), F.lit(1))
    return scored.select(*df.columns, "prediction", positive.alias("probability"))


def score_payloads(df: DataFrame, model: PipelineModel, size: int, value: str = "value") -> DataFrame:
    """Score positional payloads; those that are not valid get no prediction and ``valid`` false.

    One pass: a payload is parsed once, and one that is not valid goes through the model as zeros.
    """
    width = len(V36_SCALARS) + sum(len(VOCABULARY[c]) for c in V36_BLOCKS)
    parsed = payload_parsed(df, size, value)
    zeros = F.array_repeat(F.lit(0.0), width)
    vectors = parsed.withColumn("features", array_to_vector(F.coalesce("parsed", zeros))).drop("parsed")
    scored = score_vectors(vectors, model).drop("features")
    return scored.withColumns({c: F.when(F.col("valid"), F.col(c)) for c in ("prediction", "probability")})


def score_linear(
    df: DataFrame, coefficients: Mapping[str, float], intercept: float, threshold: float = 0.5
) -> DataFrame:
    """Score with given logistic coefficients."""
    scored = df.withColumn("probability", linear_score(coefficients, intercept))
    return scored.withColumn("prediction", (F.col("probability") > threshold).cast("double"))


def join_back(raw: DataFrame, predictions: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Raw rows with predictions that arrive as a table of their own.

    Equal predictions for one id are combined first: k copies of a raw row give k
    rows, not k times k.
    """
    return raw.join(predictions.dropDuplicates(), key, "inner")


def payload_valid(df: DataFrame, size: int, value: str = "value") -> DataFrame:
    """Check ``{"features": [...]}`` payloads; add ``n_features`` and ``valid``.

    Valid payloads have ``size`` entries: finite numbers first, then for each category a list of
    finite numbers as long as its vocabulary.
    """
    return payload_parsed(df, size, value).drop("parsed")


def payload_parsed(df: DataFrame, size: int, value: str = "value") -> DataFrame:
    """``payload_valid``, and ``parsed``: the numbers of a valid payload in one array, else null.

    The three come out of a generator of one row, below which Spark moves no filter: one on ``valid`` would repeat the
    parsing, and whatever made the payload, for each of its conditions.
    """
    entries = F.from_json(F.col(value), "struct<features:array<string>>")["features"]
    df = df.withColumn("__entries", entries)
    n_scalars = len(V36_SCALARS)
    numbers = F.transform(F.slice("__entries", 1, n_scalars), lambda x: x.try_cast("double"))
    blocks = [F.from_json(F.get("__entries", F.lit(n_scalars + i)), "array<double>") for i in range(len(V36_BLOCKS))]
    parts = df.withColumn("__parts", F.array(numbers, *blocks))
    widths = [n_scalars, *(len(VOCABULARY[c]) for c in V36_BLOCKS)]
    n_features = F.coalesce(F.size("__entries"), F.lit(0))
    good = n_features == size
    for i, width in enumerate(widths):
        part = F.get("__parts", F.lit(i))
        # "NaN" and "Infinity" are numbers to a cast, but no features.
        number = F.forall(part, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
        good &= F.coalesce((F.size(part) == width) & number, F.lit(False))
    checked = parts.withColumn("__checked", F.struct(n_features.alias("n_features"), good.alias("valid")))
    parsed = F.when(F.col("__checked.valid"), F.flatten("__parts")).alias("parsed")
    row = F.array(F.struct("__checked.n_features", "__checked.valid", parsed))
    return checked.select(*df.columns, F.inline(row)).drop("__entries")


def payload_vector(df: DataFrame, value: str = "value", output: str = "features") -> DataFrame:
    """Positional payload (scalars, then one array per category) to one feature vector; null if not valid."""
    parsed = payload_parsed(df.drop("n_features", "valid"), len(V36_SCALARS) + len(V36_BLOCKS), value)
    vector = F.when(F.col("parsed").isNotNull(), array_to_vector("parsed"))
    return parsed.withColumn(output, vector).drop("n_features", "valid", "parsed")
