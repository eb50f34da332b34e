"""Hard negatives by threshold joins over an inverted index with suffix-norm bounds.

The rows that score at least a threshold with an anchor are found as follows. Dimensions are put in
order of rising energy. A row's leading dimensions are left out of the index as long as their norm
times the largest norm of any anchor's leading dimensions stays below the threshold: what is left
out cannot reach it alone. The index lists for each run of dimensions the rows that have one of it
indexed. Partial scores are accumulated from the last run to the first; after each run a pair is
dropped when its partial score and the product of the remaining norms stay below the anchor's
threshold, and a row when all its pairs are. The dimensions left out are added for the survivors.

Anchors want no threshold but filled windows: the first positives, then for each positive the first
negatives of a band of scores. So thresholds begin near the top and are lowered, for those windows
that are not filled, until they are or nothing is left below. A window that is filled at a
threshold is final, as all that lies above has been seen.

Rows stay where they are: each task indexes runs of its own rows and holds the best few of each
window, and raises its thresholds to the least of them. Anchors go in blocks of bounded size, which are
broadcast with their thresholds. What comes back of a block is at most a window's length for each
window and task, whatever is repeated in the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm.common import count_rows, ship
from txnrisk.llm.steps import Steps
from txnrisk.llm.vectors import Best, quantized, runs

BLOCK = 8192  # anchors that are searched together
TOGETHER = 256  # anchors whose partial scores are accumulated together
STRIDE = 8  # dimensions of a run
STEPS_DOWN = (0.95, 0.8, 0.65, 0.5, 0.35, 0.2, 0.05)  # of the anchor's score with itself; then everything
BAND_STEPS = 4  # thresholds between a band's two ends
NEVER = 2**62
MOST = 2.0**55  # a percentage of a score fits 64 bits
FOUND = "window long, key long, score long, last boolean"


@dataclass(frozen=True)
class Anchors:
    """Anchors of one length. ``low`` and ``high``: the scores that each of their windows takes now; a
    window at rest has ``low`` NEVER. ``last``: whether nothing lies below ``low``. ``numbers``: of the windows."""

    ids: np.ndarray
    labels: np.ndarray
    matrix: np.ndarray
    low: np.ndarray
    high: np.ndarray
    last: np.ndarray
    numbers: np.ndarray

    def of(self, some: np.ndarray) -> Anchors:
        return Anchors(*(getattr(self, f)[some] for f in self.__dataclass_fields__))


def leading_norms(matrix: np.ndarray) -> np.ndarray:
    """Norms of the first 0, 1, ... dimensions, rounded up."""
    squares = np.zeros((len(matrix), matrix.shape[1] + 1))
    np.cumsum(matrix.astype(np.float64) ** 2, axis=1, out=squares[:, 1:])
    return np.sqrt(squares) * (1 + 1e-9)


def above(anchors: np.ndarray, rows: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of anchors and rows that score at least the anchor's ``least``, and the scores."""
    order = np.argsort((rows.astype(np.float64) ** 2).sum(axis=0), kind="stable")
    anchors, rows = anchors[:, order], rows[:, order]
    row_norms, norms = leading_norms(rows), leading_norms(anchors)
    reach = row_norms[:, -1].max(initial=0) * norms[:, -1].max(initial=0)
    if reach >= MOST:
        raise ValueError("scores exceed 55 bits")
    if reach < 2.0**52:  # sums of doubles are exact
        anchors, rows = anchors.astype(np.float64), rows.astype(np.float64)
    by_threshold = np.argsort(least, kind="stable")
    for start in range(0, len(anchors), TOGETHER):
        some = by_threshold[start : start + TOGETHER]
        at, row, score = survivors(anchors[some], norms[some], rows, row_norms, least[some], 1e-6 + 1e-14 * reach)
        yield some[at], row, score


def survivors(anchors, norms, rows, row_norms, least, slack):
    """Pairs that reach the anchors' thresholds, and their scores. ``slack``: what rounding may take from a bound."""
    size, n = rows.shape[1], len(rows)
    # Leading dimensions of each row that stay below all thresholds.
    left_out = (row_norms * norms.max(axis=0) < least.min()).sum(axis=1) - 1
    left_out = np.clip(left_out, 0, size)
    order = np.argsort(left_out, kind="stable")  # so the rows listed for a run of dimensions come first
    rows, left_out, row_norms, place = rows[order], left_out[order], row_norms[order], order
    indexed = np.where(np.arange(size) >= left_out[:, None], rows, 0)
    partial = np.zeros((len(anchors), n), rows.dtype)
    for end in range(size, 0, -STRIDE):
        begin = max(0, end - STRIDE)
        listed = np.searchsorted(left_out, end)  # rows with a dimension of the run in the index
        partial[:, :listed] += anchors[:, begin:end] @ indexed[:listed, begin:end].T
        rest = np.maximum(left_out, begin)
        remaining = norms[:, rest] * row_norms[np.arange(len(rows)), rest]
        alive = (partial + remaining + slack >= least[:, None]).any(axis=0)
        if not alive.all():
            rows, indexed, left_out, place = rows[alive], indexed[alive], left_out[alive], place[alive]
            row_norms, partial = row_norms[alive], partial[:, alive]
    partial += anchors @ (rows - indexed).T
    at, row = np.nonzero(partial >= least[:, None])
    return at, place[row], partial[at, row].astype(np.int64)


def found_batches(shared, same: bool, size: int):
    """The first rows of each window among a task's rows, of the anchor's label or of others."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks = shared.value
        best = {length: Best(a.low.size, size) for length, a in blocks.items()}
        for part, matrix in runs(batches):
            asked = blocks.get(matrix.shape[1])
            if asked is None:
                continue
            held = best[matrix.shape[1]]
            width = asked.low.shape[1]
            low = np.maximum(asked.low, held.floor.reshape(-1, width))
            keys, labels = part["key"].to_numpy(np.int64), part["label"].to_numpy()
            for at, row, score in above(asked.matrix, matrix, low.min(axis=1)):
                fits = (asked.labels[at] == labels[row]) == same
                if same:
                    fits &= asked.ids[at] != keys[row]
                at, row, score = at[fits], row[fits], score[fits]
                for w in range(width):
                    inside = (score >= low[at, w]) & (score <= asked.high[at, w])
                    if inside.any():
                        held.add(at[inside] * width + w, keys[row[inside]], score[inside])
        for length, held in best.items():
            held.settle()
            window, key, score = held.kept
            if len(window):
                asked = blocks[length]
                last, numbers = asked.last.ravel()[window], asked.numbers.ravel()[window]
                yield pd.DataFrame({"window": numbers, "key": key, "score": score, "last": last})

    return found


def fill(
    rows: DataFrame, blocks: dict[int, Anchors], thresholds, same: bool, size: int, steps: Steps, name: str
) -> list[str]:
    """Tables of the first ``size`` rows of each window. ``thresholds(anchors, n)`` gives the n-th ``low``
    and ``last`` of all windows; thresholds are lowered for the windows that are not filled yet."""
    done: set[int] = set()
    tables, number = [], 0
    while True:
        now = {}
        for length, anchors in blocks.items():
            low, last = thresholds(anchors, number)
            low = np.where(np.isin(anchors.numbers, list(done)) | (anchors.low == NEVER), NEVER, low)
            active = (low < NEVER).any(axis=1)
            if active.any():
                now[length] = replace(anchors, low=low, last=last).of(active)
        if not now:
            return tables
        shared = rows.sparkSession.sparkContext.broadcast(now)
        order = Window.partitionBy("window").orderBy(F.desc("score"), "key")
        ranked = rows.mapInPandas(found_batches(shared, same, size), FOUND).withColumn("rank", F.row_number().over(order))
        ranked = ranked.where(F.col("rank") <= size)
        full = F.count(F.lit(1)).over(Window.partitionBy("window")) == size
        table = f"{name}-{number}"
        written = steps.put(table, ranked.withColumn("full", full).where("full OR last").drop("full", "last"))
        tables.append(table)
        filled = written.select("window").distinct().toArrow()["window"].to_numpy()
        done |= set(filled.tolist())
        for anchors in now.values():
            done |= set(anchors.numbers[anchors.last & (anchors.low < NEVER)].tolist())
        shared.unpersist()
        number += 1


def falling(anchors: Anchors, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds of the positives: shares of an anchor's score with itself, then everything."""
    last = number >= len(STEPS_DOWN)
    if last:
        low = np.full(len(anchors.ids), -NEVER)
    else:
        own = (anchors.matrix.astype(np.float64) ** 2).sum(axis=1)
        low = np.floor(np.minimum(own * STEPS_DOWN[number], MOST)).astype(np.int64)
    return low[:, None], np.full((len(anchors.ids), 1), last)


def least_negative(positive, percent: int):
    """The least whole score n with percent * positive <= 100 * n."""
    return -(-percent * positive // 100)


def banded(percent: int):
    def thresholds(anchors: Anchors, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Thresholds of the negatives: from the positive's score down to the band's lower end."""
        end = least_negative(anchors.high, percent)
        low = np.maximum(anchors.high - (anchors.high - end) * (number + 1) // BAND_STEPS, end)
        return low, low == end

    return thresholds


def block_of(rows: list) -> dict[int, Anchors]:
    """Anchors by length, each with one window that is open."""
    out, number = {}, 0
    for size in sorted({len(r["vector"]) for r in rows}):
        same = [r for r in rows if len(r["vector"]) == size]
        matrix = np.frombuffer(b"".join(r["vector"] for r in same), np.int64).reshape(len(same), size // 8)
        n = len(same)
        if size:
            out[size // 8] = Anchors(
                np.array([r["key"] for r in same], np.int64), np.array([r["label"] for r in same]), matrix,
                np.full((n, 1), -NEVER), np.full((n, 1), NEVER), np.zeros((n, 1), bool), np.arange(number, number + n)[:, None],
            )
            number += n
    return out


def with_bands(blocks: dict[int, Anchors], found, width: int) -> dict[int, Anchors]:
    """The anchors with a window for each of their positives; a positive that scores below 0 has none."""
    score = {(w, r): s for w, r, s in zip(*(found[c].to_pylist() for c in ("window", "rank", "score")), strict=True)}
    out = {}
    for length, anchors in blocks.items():
        numbers = anchors.numbers[:, 0].tolist()
        high = np.array([[score.get((w, r), -1) for r in range(1, width + 1)] for w in numbers], np.int64).reshape(-1, width)
        out[length] = replace(
            anchors,
            low=np.where(high < 0, NEVER, 0),
            high=high,
            numbers=anchors.numbers * width + np.arange(width),
        )
    return out


def mine(
    df: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: float = 256.0,
    block: int = BLOCK,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` from 1, ``negative_id``, ``positive_score``, ``negative_score``.

    Scores are inner products of floor(scale * x). An anchor's positives are its first rows of the same label, other
    than its own; the negatives of a positive are the first rows of other labels with
    percent * positive_score <= 100 * negative_score <= 100 * positive_score. Higher scores come first, ties by
    smaller key. Windows with fewer rows give all of them.

    Rows with a null key, label or vector, or a null or non-finite component, take no part, nor do rows of
    another length than the anchor's or of none. Repeated rows each count, as positives and as negatives; equal anchor
    rows are one anchor. Other columns take no part, and empty tables give an empty one. Scores beyond
    55 bits are an error.
    """
    spark = df.sparkSession
    ship(spark)
    steps = Steps(spark, "negatives")
    rows = steps.put("rows", quantized(df, key, vector, scale, label))
    asked = steps.put("anchors", quantized(anchors, key, vector, scale, label).dropDuplicates())
    n_blocks = max(1, -(-count_rows(asked) // block))
    parts = []
    for number in range(n_blocks):
        some = asked.where(F.pmod(F.xxhash64("key"), F.lit(n_blocks)) == number).collect()  # about ``block`` anchors
        blocks = block_of(sorted(some, key=lambda r: (r["key"], r["vector"], r["label"])))
        if not blocks:
            continue
        first = fill(rows, blocks, falling, True, positives, steps, f"positives-{number}")
        near = steps.get(*first)
        banded_blocks = with_bands(blocks, near.select("window", "rank", "score").toArrow(), positives)
        found = fill(rows, banded_blocks, banded(percent), False, negatives, steps, f"negatives-{number}")
        if found:
            ids = [(int(w), int(i)) for a in blocks.values() for w, i in zip(a.numbers[:, 0], a.ids, strict=True)]
            names = spark.createDataFrame(ids, "anchor long, anchor_id long")
            own = near.withColumnRenamed("window", "anchor").join(names, "anchor")
            window = (F.col("anchor") * positives + F.col("rank") - 1).alias("window")
            own = own.select("anchor_id", window, F.col("key").alias("positive_id"), F.col("score").alias("positive_score"))
            both = steps.get(*found).join(own, "window")
            parts.append(f"mined-{number}")
            steps.put(parts[-1], both.select(
                "anchor_id", "positive_id", "rank", F.col("key").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
            ))
        steps.drop(*first, *found)
    steps.drop("rows", "anchors")
    if parts:
        return steps.get(*parts)
    return spark.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
