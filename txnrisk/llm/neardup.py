"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidate edges.

A document's set holds the 64-bit hashes of its distinct word shingles. The hash range is cut into
bins; a bin's value is its least hash (one permutation). An empty bin borrows from the first
occupied bin in a fixed random order of its own (optimal densification), so small sets keep
independent values. Runs of values are hashed to bucket keys. With the default bands two sets at
the least similarity share no bucket with a chance of about 5 in 10^8.

Documents with equal sets are one class, found by the set's 128-bit fingerprint: copies never form
pairs. Within a bucket one class is the centre and gets an edge to each other one; every edge is
confirmed on the full sets. The centre is the class with the fewest shingles that no other
candidate has, so a group's original, which most variants are close to, rather than a variant.

What a star can miss is closed exactly. Where a bucket still spans several components, links
between them are searched by their rarest shingles: two sets of the least similarity share one
among the first few of each, in a common order by number of candidates that have it. Rows of the
component that most rows of a shingle belong to meet only the others' rows. The numbers of own
shingles and the places of the shared one bound what two sets can have in common, so nearly all
pairs that are no links fall away before any set is looked at.

Nothing is collected: signatures, edges and labels are tables in the shared folder.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import ship
from txnrisk.llm.steps import Steps

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
BINS, ROWS = 128, 4  # 32 bands of 4 values


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over the whole range, one to one."""
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``size`` words; the whole sequence if it is shorter."""
    words = WORD.findall((text or "").encode().lower().decode())
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest("\n".join(words), seed=len(words))], np.uint64)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    rolled = hashes[: len(words) - size + 1].copy()
    for i in range(1, size):
        rolled = rolled * MULTIPLIER + hashes[i : len(words) - size + 1 + i]
    return np.unique(mixed(rolled))


@cache
def lenders(bins: int) -> np.ndarray:
    """For each bin the place of every bin in its order of borrowing."""
    return np.random.default_rng(20).random((bins, bins)).argsort(axis=1).argsort(axis=1)


def signature(hashes: np.ndarray, bins: int) -> np.ndarray:
    """Least hash of each bin of a sorted, non-empty set; empty bins borrow."""
    owner = (hashes >> np.uint64(64 - (bins - 1).bit_length())).astype(np.int64)
    occupied, first = np.unique(owner, return_index=True)
    values = np.empty(bins, np.uint64)
    values[occupied] = hashes[first]
    if len(occupied) < bins:
        empty = np.setdiff1d(np.arange(bins), occupied, assume_unique=True)
        donor = occupied[lenders(bins)[np.ix_(empty, occupied)].argmin(axis=1)]
        values[empty] = values[donor]
    return values


def bucket_keys(values: np.ndarray, rows: int) -> np.ndarray:
    """A key for each band of ``rows`` values; the band's number is part of it."""
    bands = values.reshape(-1, rows)
    keys = np.arange(len(bands), dtype=np.uint64)
    for i in range(rows):
        keys = mixed(keys * MULTIPLIER + bands[:, i] + np.uint64(1))
    return keys.view(np.int64)


SIGNED = "n_shingles long, node binary, keys array<long>"


def sign_batches(size: int, bins: int, rows: int):
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for text in texts:
                hashes = shingles(text, size)
                keys = bucket_keys(signature(hashes, bins), rows) if len(hashes) else np.empty(0, np.int64)
                out.append((len(hashes), xxhash.xxh3_128_digest(hashes.tobytes()), keys))
            yield pd.DataFrame(out, columns=["n_shingles", "node", "keys"])

    return sign


def member_batches(size: int):
    def members(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            sets = [shingles(text, size) for text in texts]
            nodes = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            yield pd.DataFrame({"node": nodes, "members": [s.view(np.int64) for s in sets]})

    return members


def similar_batches(percent: int):
    def similar(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            out = []
            for a, b in zip(left, right, strict=True):
                x, y = np.asarray(a, np.int64).view(np.uint64), np.asarray(b, np.int64).view(np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                common = int((y[at] == x).sum())
                out.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pd.Series(out, dtype=bool)

    return similar


def label_components(edges: DataFrame, steps: Steps) -> DataFrame:
    """``node`` -> ``label``, the least node of its component, for all nodes of the edges (a, b).

    Labels spread along edges and then jump to their label's label, until nothing changes.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    first = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label"))
    labels = steps.put("labels", first)
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
        spread = labels.withColumnRenamed("label", "old").join(near.agg(F.min("label").alias("near")), "node")
        spread = spread.select("node", "old", F.least("old", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        jumped = spread.join(jump, "next").select("node", F.least("next", "far").alias("label"), "old")
        moved = steps.put("labels", jumped)
        labels = moved.select("node", "label")
        if moved.where("label <> old").isEmpty():
            return labels


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    check = F.pandas_udf(similar_batches(percent), "boolean")
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("a_members"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("b_members"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    return joined.where(check("a_members", "b_members")).select("a", "b")


def least_common(percent: int) -> str:
    """Shingles that sets of ``n`` and ``other_n`` share at least when they are similar enough."""
    return f"({percent} * (n + other_n) + {percent + 99}) div {percent + 100}"


def may_be_similar(percent: int):
    """Whether the numbers of shingles that others have, too, allow the least similarity."""
    return F.expr(f"least(n - own, other_n - other_own) >= {least_common(percent)}")


def with_own(sets: DataFrame, steps: Steps) -> tuple[DataFrame, DataFrame]:
    """``node``, ``n`` and ``own`` (shingles that no other set has); and the others' rows (node, shingle, df)."""
    rows = sets.select("node", F.explode("members").alias("shingle"))
    common = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    known = steps.put("known", rows.join(steps.put("common", common), "shingle"))
    steps.drop("common")
    counts = known.groupBy("node").agg(F.count(F.lit(1)).alias("met"))
    sizes = sets.select("node", F.size("members").cast("long").alias("n")).join(counts, "node", "left")
    own = F.col("n") - F.coalesce("met", F.lit(0))
    return steps.put("own", sizes.select("node", "n", own.alias("own"))), known


def other(rows: DataFrame, *keep: str) -> DataFrame:
    """The columns of the other set of a pair."""
    return rows.select(*keep, *(F.col(c).alias(f"other_{c}") for c in rows.columns if c not in keep))


def cross_pairs(placed: DataFrame, known: DataFrame, percent: int, steps: Steps) -> DataFrame:
    """Pairs (a, b) of different labels that may be links, from rows of node, n, own and label."""
    share = f"{percent} * n"
    probe = f"n - ({share} + 99) div 100 + 1"  # enough for partners of any size
    index = f"n - (2 * {share} + {percent + 99}) div {percent + 100} + 1"  # enough for partners not smaller
    listed = known.join(placed.select("node"), "node").groupBy("node")
    listed = listed.agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("rarest")).join(placed, "node")
    listed = listed.withColumn("probe", F.expr(f"cast({probe} - own AS int)")).where("probe > 0")
    rows = listed.select(
        "node", "n", "own", "label", F.expr(index).alias("index"), F.posexplode(F.expr("slice(rarest, 1, probe)")).alias("at", "s")
    )
    place = F.col("at") + F.col("own")
    rows = rows.select("node", "n", "own", "label", "index", place.alias("place"), F.col("s.shingle").alias("shingle"))
    rows = steps.put("prefixes", rows)
    by_label = rows.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("rows"))
    main = by_label.groupBy("shingle").agg(F.max(F.struct("rows", "label")).alias("main"), F.count(F.lit(1)).alias("labels"))
    main = steps.put("main", main.where("labels > 1").select("shingle", F.col("main.label").alias("main")))
    minor = steps.put("minor", rows.join(main, "shingle").where("label <> main").drop("main"))
    fits = F.expr(
        "label <> other_label AND IF(n < other_n OR n = other_n AND node < other_node, place < index, other_place < other_index) "
        f"AND least(n - place, other_n - other_place) >= {least_common(percent)}"
    )
    met = minor.join(other(rows, "shingle"), "shingle").where(fits & may_be_similar(percent))
    return met.select(F.least("node", "other_node").alias("a"), F.greatest("node", "other_node").alias("b")).distinct()


def components(
    df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80, bins: int = BINS, rows: int = ROWS
) -> DataFrame:
    """One row per document: ``key``, ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked when 100 * shared shingles >= ``percent`` * all shingles of both.
    ``component_id`` is the least key reachable over links; ``kept`` is true where that is the
    document's own.

    Documents without words, null texts among them, have no shingles and are linked with nothing.
    Rows with the same key and text are the same document and each gets its row; rows with the
    same key and other texts are documents of their own. A null key sorts after all others and
    stays null. Other columns of ``df`` take no part.
    """
    spark = df.sparkSession
    ship(spark)
    steps = Steps(spark, "neardup")
    sign = F.pandas_udf(sign_batches(size, bins, rows), SIGNED)
    row_key = F.to_json(F.array(F.col(f"`{key}`").alias("key"))).alias("row_key")  # never null
    texts = df.select(F.col(f"`{key}`").alias("key"), row_key, F.col(f"`{text}`").alias("text"))
    signed = texts.withColumn("s", sign("text")).select("key", "row_key", "s.n_shingles", "s.node", "s.keys")
    docs = steps.put("docs", signed)
    # Copies: the same node has the same shingles and keys, so any row of it will do.
    filled = docs.where("n_shingles > 0")
    nodes = filled.groupBy("node").agg(
        F.first("keys").alias("keys"), F.min("row_key").alias("row_key")
    )
    nodes = steps.put("nodes", nodes)
    buckets = steps.put("buckets", nodes.select(F.explode("keys").alias("bucket"), "node"))
    several = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("bucket")
    shared = steps.put("shared", buckets.join(steps.put("several", several), "bucket"))
    steps.drop("buckets", "several")
    # The full set of one document for each candidate: the others' texts are not read again.
    wanted = steps.put("wanted", shared.select("node").distinct().join(nodes, "node").select("row_key"))
    members = F.pandas_udf(member_batches(size), "node binary, members array<long>")
    again = texts.select("row_key", "text").join(wanted, "row_key", "left_semi").select(members("text").alias("s"))
    sets = steps.put("sets", again.select("s.*").dropDuplicates(["node"]))
    own, known = with_own(sets, steps)
    steps.drop("nodes", "wanted")

    shared = steps.put("shared", shared.join(own, "node"))
    centres = shared.groupBy("bucket").agg(F.min(F.struct("own", "node", "n")).alias("c"))
    centres = steps.put("centres", centres.select("bucket", *(F.col(f"c.{c}").alias(f"other_{c}") for c in ("own", "node", "n"))))
    pairs = shared.join(centres, "bucket").where((F.col("node") != F.col("other_node")) & may_be_similar(percent))
    pairs = pairs.select(F.least("node", "other_node").alias("a"), F.greatest("node", "other_node").alias("b"))
    pairs = steps.put("pairs", pairs.distinct())
    edges = steps.put("edges-0", confirmed(pairs, sets, percent))
    labels = label_components(edges, steps)

    marked = shared.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    # A set with too many shingles of its own has no link at all.
    marked = steps.put("marked", marked.where(f"100 * (n - own) >= {percent} * n"))
    spans = marked.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
    spans = steps.put("spans", spans.select("bucket"))
    open_nodes = marked.join(spans, "bucket", "left_semi").select("node", "n", "own", "label").distinct()
    crossing = cross_pairs(steps.put("open", open_nodes), known, percent, steps)
    fresh = steps.put("fresh", crossing.join(pairs, ["a", "b"], "left_anti"))
    found = steps.put("edges-1", confirmed(fresh, sets, percent))
    if not found.isEmpty():
        labels = label_components(steps.get("edges-0", "edges-1"), steps)
    steps.drop(*(n for n in [*steps.paths] if n not in {"docs", "labels"}))
    placed = docs.drop("row_key", "keys").join(labels, "node", "left")
    placed = placed.withColumn("label", F.when(F.col("n_shingles") > 0, F.coalesce("label", "node")))
    least = placed.where("label IS NOT NULL").groupBy("label").agg(F.min("key").alias("least"))
    least = steps.put("least", least)
    out = placed.join(least, "label", "left").withColumn("component_id", F.coalesce("least", "key"))
    return out.select(
        F.col("key").alias(key), "n_shingles", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept")
    )
