"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target of words; each of its documents the expected number of copies target /
source size. The whole part of it is given to all, the fractional parts are rounded to 0 or 1 so
that every document keeps its expectation and a source's words stay at its target: two documents
at a time, mass (words times probability) moves from one to the other, in a randomly drawn
direction, until one of them is 0 or 1; the other goes on to meet the next one.

A source's documents are dealt to buckets of bounded size. A task pairs those of one bucket and
leaves at most one unfinished document. The leftovers meet in the next turn's buckets, until each
source has one: a reduction tree. Pairs go from large to small
documents and the last one is drawn alone, so a source misses its target by less than one, mostly
small, document. Buckets, order and draws come from hashes of the document key, so
reruns agree, whatever the partitions are.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm.common import ship
from txnrisk.llm.steps import Steps

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
BUCKET_ROWS = 20_000


def source_targets(sources: DataFrame, weights, share: float, most: float, steps: Steps) -> DataFrame:
    """``target`` of each source (columns source, source_size, rank).

    The budget is ``share`` of all sizes. By turns, what is left of it goes to the sources that
    are not full by weight; those that would get more than ``most`` times their size stop there.
    A turn is one aggregation over the sources.
    """
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sizes = steps.put("sizes", sources.withColumn("weight", weight).withColumn("most", F.col("source_size") * most))
    budget = (sizes.agg(F.sum("source_size").alias("all")).first()["all"] or 0) * share
    level = 0.0
    while True:
        # Full at this level: the sizes that stop at or below it.
        full = F.col("most") <= F.col("weight") * level
        left = sizes.agg(
            F.sum(F.when(full, F.col("most")).otherwise(0.0)).alias("full"),
            F.sum(F.when(~full, F.col("weight")).otherwise(0.0)).alias("open"),
        ).first()
        if not left["open"]:
            break
        next_level = (budget - left["full"]) / left["open"]
        if next_level <= level:
            break
        level = next_level
    return sizes.withColumn("target", F.least("most", F.col("weight") * level))


def round_bucket(members: pd.DataFrame) -> pd.DataFrame:
    """Pair the rows of a bucket. ``chance`` becomes 0 or 1, but for one row at most.

    Large documents come first: each is settled by others of its size, and the last one is small.
    """
    members = members.sort_values(["size", "tie", "row_key"], ascending=[False, True, True], kind="mergesort")
    chances, sizes, draws = members["chance"].tolist(), members["size"].tolist(), members["draw"].tolist()
    held = -1
    for i in range(len(chances)):
        held = i if held < 0 else pair(chances, sizes, held, i, draws[i])
    done = [i != held for i in range(len(chances))]
    return pd.DataFrame({"row_key": members["row_key"], "chance": chances, "done": done})


def pair(chances: list[float], sizes: list[int], i: int, j: int, draw: float) -> int:
    """Move mass between two rows until one is 0 or 1. Gives the other one, or -1 if both are.

    Up to ``up`` words can move from j to i, up to ``down`` from i to j; which happens is drawn
    so that both keep their expectations.
    """
    a, b, size_a, size_b = chances[i], chances[j], sizes[i], sizes[j]
    up_a, up_b = (1 - a) * size_a, b * size_b
    down_a, down_b = a * size_a, (1 - b) * size_b
    up, down = min(up_a, up_b), min(down_a, down_b)
    if draw * (up + down) < down:
        chances[i], chances[j] = a + up / size_a, b - up / size_b
        if up_a <= up_b:
            chances[i] = 1.0
        if up_b <= up_a:
            chances[j] = 0.0
    else:
        chances[i], chances[j] = a - down / size_a, b + down / size_b
        if down_a <= down_b:
            chances[i] = 0.0
        if down_b <= down_a:
            chances[j] = 1.0
    open_i, open_j = 0 < chances[i] < 1, 0 < chances[j] < 1
    return i if open_i else j if open_j else -1


def fraction(seed: int, turn: int):
    """A number from 0 to 1 drawn for a row and turn."""
    return F.xxhash64(F.lit(seed), F.lit(turn), "row_key").bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)


def chosen_rows(rows: DataFrame, seed: int, bucket_rows: int, steps: Steps) -> DataFrame:
    """``row_key`` and ``chance`` 0 or 1 for rows of row_key, source, size and a chance between."""
    settled, turn = [], 0
    while True:
        counts = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
        counts = steps.put(f"counts-{turn}", counts.withColumn("buckets", F.ceil(F.col("n") / bucket_rows)))
        bucket = F.pmod(F.xxhash64(F.lit(seed + 2), F.lit(turn), "row_key"), F.col("buckets"))
        numbered = rows.join(counts, "source").select(
            "row_key", "source", "size", "chance", bucket.alias("bucket"), fraction(seed, turn).alias("draw"),
            F.xxhash64(F.lit(seed + 1), F.lit(turn), "row_key").alias("tie"),
        )
        paired = numbered.groupBy("source", "bucket").applyInPandas(round_bucket, "row_key string, chance double, done boolean")
        paired = steps.put(f"turn-{turn}", paired)
        settled.append(paired.where("done").select("row_key", "chance"))
        left = paired.where("NOT done").select("row_key", "chance")
        if counts.where("buckets > 1").isEmpty():
            # One row at most is left of each source: it is drawn alone.
            last = F.when(fraction(seed + 3, turn) < F.col("chance"), 1.0).otherwise(0.0)
            return reduce(DataFrame.union, [*settled, left.select("row_key", last.alias("chance"))])
        rows = steps.put(f"open-{turn}", left.join(rows.select("row_key", "source", "size"), "row_key"))
        turn += 1


def mix(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 7,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per document: ``key``, ``source``, ``size``, ``source_size``, ``target`` and ``copies``.

    ``size``: words of the text (null or without words: 0). Sources, by code point and null last,
    have the ``weights`` by turns and share ``share`` times all words; a source's target stops at
    ``most`` times its size and the excess goes to the others by weight. ``copies`` is the whole
    number at or next to target / source size. Documents without words get no copy.

    Rows with the same key and source are one document: they are rounded as one, with their words
    together, so they have the same number of copies. A null key is a key like any other. An
    empty table gives an empty one. Other columns of ``df`` take no part.
    """
    spark = df.sparkSession
    ship(spark)
    steps = Steps(spark, "mix")
    picked = df.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{source}`").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    # One text for key and source, never null: what the row is joined, ordered and drawn by.
    rows = picked.withColumn("row_key", F.to_json(F.array(F.col("key").cast("string"), "source")))
    rows = rows.withColumn("source_key", F.to_json(F.array("source")))
    rows = steps.put("rows", rows)
    sources = rows.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    sources = steps.put("sources", ranked_sources(sources, steps))
    targets = steps.put("targets", source_targets(sources, weights, share, most, steps).select("source_key", "source_size", "target"))

    merged = rows.where("size > 0").groupBy("row_key", "source_key").agg(F.sum("size").alias("size"))
    placed = merged.join(targets, "source_key").withColumn("expected", F.col("target") / F.col("source_size"))
    whole = F.floor(F.col("expected") + 1e-12)
    placed = placed.withColumn("whole", whole).withColumn("chance", F.greatest(F.col("expected") - F.col("whole"), F.lit(0.0)))
    placed = steps.put("placed", placed.select("row_key", F.col("source_key").alias("source"), "size", "whole", "chance"))
    open_rows = placed.where("chance > 0").select("row_key", "source", "size", "chance")
    chosen = chosen_rows(open_rows, seed, bucket_rows, steps)
    copies = placed.drop("chance").join(chosen, "row_key", "left").select(
        "row_key", (F.col("whole") + F.coalesce(F.round("chance"), F.lit(0.0))).cast("long").alias("copies")
    )
    copies = steps.put("copies", copies)
    steps.drop(*(n for n in [*steps.paths] if n not in {"rows", "targets", "copies"}))
    out = rows.join(targets, "source_key").join(copies, "row_key", "left")
    number = F.coalesce("copies", F.lit(0)).cast("long").alias("copies")
    return out.select(F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", number)


def ranked_sources(sources: DataFrame, steps: Steps) -> DataFrame:
    """Add ``rank``: the place of a source by code point, from 0, null last.

    Sorted by range over all partitions; each partition's rows are numbered on their own, and the
    rows of the partitions before are added: no task sees all sources.
    """
    ordered = sources.repartitionByRange(F.col("source").isNull(), "source").withColumn("part", F.spark_partition_id())
    ordered = steps.put("ordered", ordered)
    counts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").isNull(), "source")) - 1
    return ordered.withColumn("within", within).join(before.drop("n"), "part").withColumn("rank", F.col("before") + F.col("within")).drop("part", "within", "before")


def repeat(df: DataFrame, copies: DataFrame, key: str = "doc_id", source: str = "source") -> DataFrame:
    """``df`` with each row as many times as ``copies`` (from ``mix``) says for its key and source.

    Rows without a number, or with 0, are left out. Null keys and sources match null ones.
    """
    names = ("number_key", "number_source")
    number = copies.where("copies > 0").select(
        F.col(f"`{key}`").alias(names[0]), F.col(f"`{source}`").alias(names[1]), "copies"
    ).distinct()
    rows = df.select(
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"),
        F.col(f"`{key}`").alias("own_key"), F.col(f"`{source}`").cast("string").alias("own_source"),
    )
    same = F.col("own_key").eqNullSafe(F.col(names[0])) & F.col("own_source").eqNullSafe(F.col(names[1]))
    many = rows.join(number, same).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return many.select("row.*")
