"""Exact top-k search by distributed histogram selection.

Queries are handled in blocks of bounded size. For a block every vector is scored; each task
counts its scores in equal bins of each query's range, the counts are summed, and the bin that
holds the k-th best score becomes the query's next range. After a few such passes the range is one
score, or few enough scores lie at or above it. A last pass gives out the scores from there on,
and ties are broken by the smaller id.

A task keeps its counts from the top bin down to where it has k scores by itself: the k-th best of
all cannot lie lower. In the last pass a task holds the k best rows of each query that it has met, of
equal scores those with the smallest ids, and gives them out once at its end: a vector that a third of all rows
repeat costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm.common import count_rows, ship
from txnrisk.llm.steps import Steps
from txnrisk.llm.vectors import Best, quantized, runs

BINS = 512
BLOCK = 2048  # queries that are searched together: their vectors and ranges are broadcast


@dataclass
class Block:
    """Queries of one length: ids, vectors, the ranges [low, high) that hold the k-th score, and the
    number of scores above them. A range is empty once ``low`` is settled."""

    ids: np.ndarray
    matrix: np.ndarray
    low: np.ndarray
    high: np.ndarray
    above: np.ndarray
    numbers: np.ndarray  # of the queries within the whole block

    @property
    def width(self) -> np.ndarray:
        return -(-(self.high - self.low) // BINS)


def scores(block: Block, ids: np.ndarray, matrix: np.ndarray, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """Scores of a block's queries, and where they count (a query's own rows do not)."""
    if exact:  # all sums stay below 2^53
        found = (block.matrix.astype(np.float64) @ matrix.T.astype(np.float64)).astype(np.int64)
    else:
        found = block.matrix @ matrix.T
    return found, block.ids[:, None] != ids[None, :]


def count_batches(shared, k: int):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks, exact = shared.value
        counts = {size: np.zeros((len(b.ids), BINS), np.int64) for size, b in blocks.items()}
        for part, matrix in runs(batches):
            block = blocks.get(matrix.shape[1])
            if block is None:
                continue
            found, valid = scores(block, part["key"].to_numpy(np.int64), matrix, exact)
            number = (found - block.low[:, None]) // np.maximum(block.width, 1)[:, None]
            valid &= (found >= block.low[:, None]) & (found < block.high[:, None])
            flat = (number + np.arange(len(number))[:, None] * BINS)[valid]
            counts[matrix.shape[1]] += np.bincount(flat, minlength=number.shape[0] * BINS).reshape(-1, BINS)
        for size, table in counts.items():
            above = table[:, ::-1].cumsum(axis=1)[:, ::-1] - table
            query, number = np.nonzero((table > 0) & (above < k))
            if len(query):
                n = table[query, number]
                yield pd.DataFrame({"query": blocks[size].numbers[query], "bin": number, "n": n})

    return count


def final_batches(shared, k: int):
    def final(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks, exact = shared.value
        best = {size: Best(len(b.ids), k) for size, b in blocks.items()}
        for part, matrix in runs(batches):
            block = blocks.get(matrix.shape[1])
            if block is None:
                continue
            ids, held = part["key"].to_numpy(np.int64), best[matrix.shape[1]]
            found, valid = scores(block, ids, matrix, exact)
            valid &= found >= np.maximum(block.low, held.floor)[:, None]
            query, row = np.nonzero(valid)
            held.add(query, ids[row], found[query, row])
        for size, held in best.items():
            held.settle()
            query, key, score = held.kept
            if len(query):
                yield pd.DataFrame({"query_id": blocks[size].ids[query], "key": key, "score": score})

    return final


def query_blocks(rows: list, most: dict[int, int]) -> tuple[dict[int, Block], bool]:
    """Blocks of the queries by length. Scores lie within the sums of the queries' magnitudes
    times the largest magnitude ``most`` of the candidates' components."""
    blocks, number, exact = {}, 0, True
    for size in sorted({len(r["vector"]) for r in rows}):
        same = sorted((r for r in rows if len(r["vector"]) == size), key=lambda r: (r["key"], r["vector"]))
        matrix = np.frombuffer(b"".join(r["vector"] for r in same), np.int64).reshape(len(same), size // 8)
        bound = [sum(map(abs, q)) * most.get(size // 8, 0) + 1 for q in matrix.tolist()]
        if max(bound) >= 1 << 62:
            raise ValueError("scores exceed 64 bits")
        exact &= max(bound) < 1 << 53
        high = np.array(bound, np.int64)
        blocks[size // 8] = Block(
            np.array([r["key"] for r in same], np.int64), matrix, 1 - high, high, np.zeros(len(same), np.int64), np.arange(number, number + len(same))
        )
        number += len(same)
    return blocks, exact


def refine(blocks: dict[int, Block], counts: dict[int, list[tuple[int, int]]], k: int) -> bool:
    """Narrow each range to the bin of the k-th score, given (bin, count) from the top. False when all are settled."""
    going_on = False
    for block in blocks.values():
        for i, number in enumerate(block.numbers.tolist()):
            if block.low[i] == block.high[i]:
                continue
            above, width = int(block.above[i]), int(block.width[i])
            low = high = int(block.low[i])  # fewer than k scores in all: each is given out
            for at, n in sorted(counts.get(number, ()), reverse=True):
                if above + n >= k:
                    low = int(block.low[i]) + at * width
                    high = min(low + width, int(block.high[i]))
                    if high - low == 1 or above + n <= 4 * k:
                        high = low
                    break
                above += n
            block.low[i], block.high[i], block.above[i] = low, high, above
            going_on |= high > low
    return going_on


def search(
    df: DataFrame,
    queries: DataFrame,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: float = 1024.0,
    block: int = BLOCK,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``key`` and ``score`` of the ``k`` best rows of each query.

    Scores are inner products of floor(scale * x). Ties go to the smaller key. A query's own rows
    (those with its key) do not count; a query with fewer than ``k`` others gets all of them.

    Rows with a null key, a null vector, or a null or non-finite component take no part, neither
    do rows whose vector has another length than the query's. Equal query rows are one query;
    repeated candidate rows each count. Other columns take no part. Empty tables give an empty one.
    Components or scores that do not fit 64 bits are an error.
    """
    spark = df.sparkSession
    ship(spark)
    steps = Steps(spark, "topk")
    base = steps.put("vectors", quantized(df, key, vector, scale))
    asked = steps.put("queries", quantized(queries, key, vector, scale).dropDuplicates())
    size = F.length("vector") / 8
    magnitude = F.pandas_udf(largest_component, "long")
    most = base.groupBy(size.cast("int").alias("size")).agg(F.max(magnitude("vector")).alias("most"))
    most = {r["size"]: r["most"] for r in most.collect()}  # one row for each length of vector
    n_blocks = max(1, -(-count_rows(asked) // block))
    parts = []
    for number in range(n_blocks):
        rows = asked.where(F.pmod(F.xxhash64("key"), F.lit(n_blocks)) == number).collect()  # about ``block`` queries
        if rows:
            parts.append(f"found-{number}")
            steps.put(parts[-1], search_block(base, rows, most, k))
    steps.drop("vectors", "queries")
    if not parts:
        return spark.createDataFrame([], f"query_id long, rank int, `{key}` long, score long")
    return steps.get(*parts).withColumnRenamed("key", key)


def largest_component(vectors: pd.Series) -> pd.Series:
    return pd.Series([int(np.abs(np.frombuffer(v, np.int64)).max(initial=0)) for v in vectors], dtype="int64")


def search_block(base: DataFrame, rows: list, most: dict[int, int], k: int) -> DataFrame:
    """The ``k`` best rows of some queries."""
    spark = base.sparkSession
    blocks, exact = query_blocks(rows, most)
    while True:
        shared = spark.sparkContext.broadcast((blocks, exact))
        counted = base.mapInPandas(count_batches(shared, k), "query long, bin int, n long")
        counted = counted.groupBy("query", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        # From the top down to the k-th: at most k bins of each query of the block.
        reached = counted.withColumn("upto", F.sum("n").over(down)).where(F.col("upto") - F.col("n") < k)
        counts: dict[int, list[tuple[int, int]]] = {}
        for row in reached.collect():
            counts.setdefault(row["query"], []).append((row["bin"], row["n"]))
        narrowed = refine(blocks, counts, k)
        shared.unpersist()
        if not narrowed:
            break
    shared = spark.sparkContext.broadcast((blocks, exact))
    found = base.mapInPandas(final_batches(shared, k), "query_id long, key long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "key")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "key", "score")
