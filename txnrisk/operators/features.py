"""Category vocabularies, encodings and feature vectors."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.functions import normalize_category, text
from txnrisk.operators.ordering import ordered_index
from txnrisk.schemas import CALENDAR, CATEGORICALS, V36_BLOCKS, V36_SCALARS, VOCABULARY, numeric_columns
from txnrisk.sources.scratch import stage

Labels = Mapping[str, Sequence[str]]


def label_counts(df: DataFrame, columns: Sequence[str] = CATEGORICALS) -> DataFrame:
    """Rows per (column, label), nulls left out.

    All columns are counted in one pass. Counts are partly summed before the shuffle,
    so a label on a third of all rows arrives as one row per map task.
    """
    pairs = ", ".join(f"{text.literal(c)}, {text.name(c)}" for c in columns)
    return (
        df.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, label)")
        .where("label IS NOT NULL")
        .groupBy("column_name", "label")
        .agg(F.count("*").alias("n_rows"))
    )


def label_vocab(df: DataFrame, columns: Sequence[str] = CATEGORICALS) -> DataFrame:
    """Vocabulary table: labels of each column by falling frequency, ties by name.

    The window runs over distinct labels only, one task per column; see
    ``label_vocab_large`` for a column with very many.
    """
    rank = Window.partitionBy("column_name").orderBy(F.desc("n_rows"), "label")
    return label_counts(df, columns).select(
        "column_name",
        "label",
        normalize_category("label").alias("clean_label"),
        (F.row_number().over(rank) - 1).alias("idx"),
        "n_rows",
    )


def label_vocab_large(df: DataFrame, column: str) -> DataFrame:
    """``label_vocab`` for one column with any number of labels: no task holds them all."""
    counts = label_counts(df, [column]).withColumn("__rank", -F.col("n_rows"))
    ranked = ordered_index(counts, ["__rank", "label"], "idx")
    return ranked.select("column_name", "label", normalize_category("label").alias("clean_label"), "idx", "n_rows")


def merge_vocab(vocab: DataFrame, rows: DataFrame, columns: Sequence[str] = CATEGORICALS) -> DataFrame:
    """The vocabulary after more rows: counts grow, indexes stay, new labels come after the old ones.

    New labels follow in the order of falling frequency in ``rows``, ties by name. All of them are ranked
    by one range partitioning over all columns, so no task holds a column's labels; only the first
    place of each column is joined back.
    """
    counts = label_counts(rows, columns)
    old = vocab.select("column_name", "label", "idx", F.col("n_rows").alias("n_old"))
    both = stage(old.join(counts, ["column_name", "label"], "full"), "labels")
    known = both.where("idx IS NOT NULL").selectExpr("column_name", "label", "idx", "n_old + coalesce(n_rows, 0) AS n_rows")
    new = both.where("idx IS NULL").select("column_name", "label", "n_rows", (-F.col("n_rows")).alias("__rank"))
    placed = ordered_index(new, ["column_name", "__rank", "label"], "__spot")
    first = placed.groupBy("column_name").agg(F.min("__spot").alias("__first"))
    last = old.groupBy("column_name").agg((F.max("idx") + 1).alias("__next"))
    bases = first.join(last, "column_name", "left").selectExpr("column_name", "coalesce(__next, 0) - __first AS __shift")
    added = placed.join(bases, "column_name").selectExpr("column_name", "label", "__spot + __shift AS idx", "n_rows")
    return known.union(added).select("column_name", "label", normalize_category("label").alias("clean_label"), "idx", "n_rows")


def labels_of(vocab: DataFrame) -> dict[str, list[str]]:
    """Vocabulary table to ordered label lists, for labels that become columns.

    A column with more labels than a table can have columns goes through ``onehot_by_join``.
    """
    rows = vocab.select("column_name", "idx", "label").collect()
    out: dict[str, list[str]] = {}
    for column, _, label in sorted(rows):
        out.setdefault(column, []).append(label)
    return out


def label_index(df: DataFrame, labels: Labels, suffix: str = "_idx") -> DataFrame:
    """Frequency index per column. Unseen and null labels share the index after the last."""

    def index(c: str) -> str:
        values = labels[c]
        known = f"array_position(array({', '.join(map(text.literal, values))}), {text.name(c)})"
        return f"cast(coalesce(nullif({known}, 0) - 1, {len(values)}) AS double)"

    return text.with_columns(df, {c + suffix: index(c) for c in labels})


def index_by_join(df: DataFrame, vocab: DataFrame, column: str, suffix: str = "_idx") -> DataFrame:
    """``label_index`` for a column with any number of labels.

    Spark broadcasts the vocabulary while it is small. Beyond that the join is a
    shuffle on the label, where adaptive execution splits a hot label's rows.
    """
    own = vocab.where(F.col("column_name") == column)
    size = own.agg(F.count("*").cast("double").alias("n")).scalar()
    lookup = own.select(F.col("label").alias(column), F.col("idx").cast("double").alias(column + suffix))
    joined = df.join(lookup, column, "left")
    return joined.withColumn(column + suffix, F.coalesce(column + suffix, size)).select(*df.columns, column + suffix)


def onehot_by_join(df: DataFrame, vocab: DataFrame, column: str, suffix: str = "_hot") -> DataFrame:
    """One-hot of a column with any number of labels, in the layout of a sparse vector.

    A struct of ``size``, ``indices`` and ``values``; unseen and null labels have no index.
    """
    index = f"{column}__idx"
    indexed = index_by_join(df, vocab, column, "__idx")
    size = vocab.where(F.col("column_name") == column).agg(F.count("*").cast("int").alias("n")).scalar()
    known = F.col(index) < size
    hot = F.struct(
        size.alias("size"),
        F.when(known, F.array(F.col(index).cast("int"))).otherwise(F.array().cast("array<int>")).alias("indices"),
        F.when(known, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"),
    )
    return indexed.withColumn(column + suffix, hot).drop(index)


def clean_label(label: str, collapse: bool = True) -> str:
    """``normalize_category`` for a label of the vocabulary."""
    return re.sub(r"[\s-]+" if collapse else "[ -]", "_", label.lower(), flags=re.ASCII)


def onehot_columns(labels: Labels, collapse: bool = True) -> dict[str, str]:
    """SQL of one int column ``<column>_<label>`` per label; unseen and null give all zeros."""
    out: dict[str, str] = {}
    for c, values in labels.items():
        for value in values:
            name = f"{c}_{clean_label(value, collapse)}"
            if name in out:
                raise ValueError(f"two labels of {c} give the column {name}: normalise the labels first")
            out[name] = text.hot(c, value)
    return out


def onehot_named(df: DataFrame, labels: Labels, collapse: bool = True) -> DataFrame:
    """Flattened one-hot columns for a fitted vocabulary."""
    return text.with_columns(df, onehot_columns(labels, collapse))


def normalize_all(df: DataFrame, columns: Sequence[str] = CATEGORICALS) -> DataFrame:
    return text.with_columns(df, {c: text.normalize_category(c) for c in columns})


def onehot_fixed(df: DataFrame, vocabulary: Labels = VOCABULARY) -> DataFrame:
    """Normalise the categories in place and flatten them by a vocabulary known beforehand."""
    return text.with_columns(normalize_all(df, list(vocabulary)), onehot_columns(vocabulary))


def onehot_arrays(df: DataFrame, labels: Labels, suffix: str = "_arr") -> DataFrame:
    """One ``array<double>`` per column, a slot per label."""
    slots = {c: ", ".join(text.hot(c, v, "double") for v in values) for c, values in labels.items()}
    return text.with_columns(df, {c + suffix: f"array({sql})" for c, sql in slots.items()})


def encoding_pipeline(columns: Sequence[str] = CATEGORICALS, suffix: str = "_vec") -> Pipeline:
    """Index and one-hot all columns into vectors: two stages, one counting pass for all."""
    indexes = [c + "_idx" for c in columns]
    indexer = StringIndexer(inputCols=list(columns), outputCols=indexes, handleInvalid="keep")
    encoder = OneHotEncoder(inputCols=indexes, outputCols=[c + suffix for c in columns])
    return Pipeline(stages=[indexer, encoder])


def vectors_to_arrays(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``<name>_vec`` columns become ``<name>_arr`` columns."""
    arrays = {c.removesuffix("_vec") + "_arr": vector_to_array(c) for c in columns}
    return df.withColumns(arrays).drop(*columns)


def arrays_to_vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``<name>_arr`` columns become ``<name>_vec`` columns."""
    vectors = {c.removesuffix("_arr") + "_vec": array_to_vector(c) for c in columns}
    return df.withColumns(vectors).drop(*columns)


def flatten_array(df: DataFrame, column: str, size: int) -> DataFrame:
    """Positional columns ``<column>_<i>``; places past the end of an array are null."""
    places = {f"{column}_{i}": f"get({text.name(column)}, {i})" for i in range(size)}
    return text.with_columns(df, places).drop(column)


def with_calendar(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return text.with_columns(df, text.calendar_features(ts))


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features", invalid: str = "error") -> DataFrame:
    """Numeric and vector columns into one vector. ``invalid``: error, skip or keep."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=invalid).transform(df)


def v36_inputs(suffix: str = "_vec") -> list[str]:
    """Input columns of the array route, in order."""
    return [*V36_SCALARS, *[c + suffix for c in V36_BLOCKS]]


def v40_inputs(labels: Labels = VOCABULARY) -> list[str]:
    """Input columns of the flattened route: all but id, label, text and timestamp."""
    return ["user_id", *numeric_columns(), *onehot_columns(labels), *CALENDAR]


def unseen_labels(df: DataFrame, vocabulary: Labels = VOCABULARY) -> DataFrame:
    """Rows per (column, normalised label) that the vocabulary does not know."""
    cleaned = df.selectExpr(*[f"{text.normalize_category(c)} AS {text.name(c)}" for c in vocabulary])
    known = " OR ".join(
        f"(column_name = {text.literal(c)} AND label IN ({', '.join(map(text.literal, values))}))"
        for c, values in vocabulary.items()
    )
    return label_counts(cleaned, list(vocabulary)).where(f"NOT ({known})")
