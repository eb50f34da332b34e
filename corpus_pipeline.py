"""The document pipeline: stages from raw documents to token ids, each written and read again."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.llm import lines, mixing, neardup, pieces, quality
from txnrisk.llm.common import free_name, remove, scratch_path, stage, table
from txnrisk.llm.queries import piece_model

# Tokens of a line that goes when only one other text has it; a line length that none has.
LONG_LINE, NEVER = 12, 2**31 - 1
# Characters of a line that may go whatever its tokens, as scripts without blanks have few.
WIDE_LINE = 20


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps: its cleaner acts on what the driver's heap no longer holds."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules. They are measured twice, so that no copy of the texts stays on disk."""
    return quality.judge(quality.measure(docs), again=True).where("kept").select(*docs.columns)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that recur across documents; those with nothing left go."""
    return lines.drop_recurring(docs, characters=WIDE_LINE, constants=True).withColumn("n_chars", F.length("text").cast("long"))


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """Documents without long lines that stand in an earlier document, too: two texts are enough.

    Only for documents without near-duplicates: of a pair of these, one would be left in fragments.
    """
    whole = lines.drop_recurring(
        docs, documents=2, least=LONG_LINE, general=NEVER, characters=3 * WIDE_LINE, constants=True
    )
    return whole.withColumn("n_chars", F.length("text").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group of near-duplicates, less repeated long lines."""
    row = free_name(docs.columns, "row")
    # A key of each row by its content: ids may repeat or be null. The least id comes first, null ids last.
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64(*docs.columns).alias("hash"))
    docs = docs.withColumn(row, own)
    kept = neardup.components(docs, key=row, size=5, percent=80).where("kept").select(row).distinct()
    release(spark)
    first = docs.join(kept, row, "left_semi").dropDuplicates([row]).drop(row)
    unique = stage(first, "pipeline-unique")
    release(spark)
    return drop_repeated_lines(unique)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, some repeated and some left out, so that the sources have their target weights."""
    return mixing.repeat(docs, mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    return pieces.encode(docs, piece_model()).drop("text")


STAGES = [
    ("quality_rules", keep_quality),
    ("line_dedup", drop_recurring_lines),
    ("minhash", drop_near_duplicates),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

# Robust estimates, template trees, signatures and random rounding have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents. A stage's table goes when the next one is written."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, apply in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        apply(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            remove(spark, last)
        last = path
        release(spark)
    return docs
