"""Near-duplicate embeddings by Euclidean p-stable hashing, confirmed by exact cosines.

Vectors are brought to length one. A table's key of a vector is made of several quantised random
projections, floor((a.x + b) / w) with normal a (2-stable): vectors at a small distance often
fall into the same cell, far ones seldom. Vectors that share a key in one of the tables are
compared. Equal vectors of a label are one class with a weight and are never compared.

A bucket with many classes is a group of copies with little noise. Its classes within half the
threshold's angle of the group's mean direction form a ball: any two of them are linked, by the
triangle inequality, and no pair of them is looked at. The angle to the centre and the ball's radius
settle most other cases too: a vector is linked to all of a ball, or to none. Only where neither
holds is it compared with the ball's members.

All other classes of a bucket are compared in chunks of bounded size: a task gets two chunks and
multiplies their matrices. It counts a linked pair in the first table in which the two meet, and
gives out counts for each class and a star of edges for each connected part, not the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import ship
from txnrisk.llm.neardup import label_components
from txnrisk.llm.steps import Steps

# Cells of width 3 and 24 projections: two vectors at cosine 0.93 share one of 40 keys in 96 of 100
# cases, at 0.95 in 99.4; vectors at right angles share a key in 1.5 of 100,000 cases.
WIDTH, HASHES, TABLES = 3.0, 24, 40
DENSE = 32  # classes of a bucket from which on it is tried as a ball
TABLE_BITS = 8  # of a key: its table; the rest is the hash of label and cells
CHUNK = 1024  # classes of a bucket that one side of a comparison holds
PAIRS = 65_536  # found pairs whose keys are looked at together
GRID = 2.0**24  # sums of directions are whole numbers, whatever the order of rows
MARGIN = 1e-9  # of angles, far above what doubles round off

UNITS = "unit binary, keys array<long>"
FOUND = "a long, b long, n long"


def projections(size: int, hashes: int, tables: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    """The same random directions and offsets on every machine."""
    draw = np.random.default_rng([17, size])
    return draw.standard_normal((size, hashes * tables)), draw.uniform(0, width, hashes * tables)


def unit(vector) -> np.ndarray | None:
    """The vector at length one; None for null, zero and non-finite ones."""
    if vector is None or not len(vector):
        return None
    values = np.array([np.nan if x is None else x for x in vector], np.float64)
    largest = np.abs(values).max()
    if not np.isfinite(values).all() or largest == 0:
        return None
    values = values / largest  # so that squares neither overflow nor vanish
    return values / np.sqrt(values @ values)


def unit_batches(hashes: int, tables: int, width: float):
    def units(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for labels, vectors in batches:
            out = []
            for label, vector in zip(labels, vectors, strict=True):
                x = None if label is None else unit(vector)
                if x is None:
                    out.append((None, None))
                    continue
                if len(x) not in known:
                    if len(known) > 8:
                        known.clear()
                    known[len(x)] = projections(len(x), hashes, tables, width)
                directions, offsets = known[len(x)]
                cells = np.floor((x @ directions + offsets) / width).astype(np.int32).reshape(tables, hashes)
                seed = xxhash.xxh3_64_intdigest(label)
                keys = np.array([xxhash.xxh3_64_intdigest(c.tobytes(), seed=seed) for c in cells], np.uint64)
                keys = (keys << np.uint64(TABLE_BITS)) | np.arange(tables, dtype=np.uint64)
                out.append((x.tobytes(), keys.view(np.int64)))
            yield pd.DataFrame(out, columns=["unit", "keys"])

    return units


def angle_batches(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Angles between packed directions; the form by chords is exact for small ones, too."""
    for left, right in batches:
        a, b = (np.frombuffer(b"".join(side), np.float64).reshape(len(side), -1) for side in (left, right))
        yield pd.Series(2 * np.arcsin(np.minimum(1.0, np.sqrt(((a - b) ** 2).sum(axis=1)) / 2)))


def sum_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of the directions of each ball, on a grid."""
    for batch in batches:
        for ball, part in batch.groupby("ball", sort=False):
            whole = np.rint(np.frombuffer(b"".join(part["unit"]), np.float64).reshape(len(part), -1) * GRID)
            total = whole.astype(np.int64).sum(axis=0)
            yield pd.DataFrame({"ball": ball, "dimension": np.arange(len(total)), "total": total})


def direction_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for sums in batches:
        yield pd.Series([None if (x := unit(s)) is None else x.tobytes() for s in sums], dtype=object)


def stars(linked: np.ndarray) -> np.ndarray:
    """For each place of a symmetric matrix, the least place that it reaches."""
    least, far = np.arange(len(linked)), len(linked)
    while True:
        near = np.where(linked, least[None, :], far).min(axis=1, initial=far)
        after = np.minimum(least, near)
        after = after[after]
        if (after == least).all():
            return least
        least = after


def compared(rows: dict[str, np.ndarray], cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Counts and edges (a, b, n) between two chunks, or within one.

    ``tbl`` says in which table the chunks meet; a pair that met in an earlier one, by the same keys as
    buckets are made of, is not counted again. Where it is negative, a pair meets only once.
    """
    within, table = rows["within"][0], int(rows["tbl"][0])
    left = len(rows["side"]) if within else int(np.searchsorted(rows["side"], 1))
    if left == 0 or not within and left == len(rows["side"]):
        return None
    matrix = np.frombuffer(b"".join(rows["unit"]), np.float64).reshape(len(rows["unit"]), -1)
    if within:
        i, j = np.nonzero(np.triu(matrix @ matrix.T >= cosine, 1))
    else:
        i, j = np.nonzero(matrix[:left] @ matrix[left:].T >= cosine)
        j = j + left
    if not len(i):
        return None
    new = np.ones(len(i), bool)
    if table > 0:
        keys = np.stack(rows["keys"])[:, :table]
        for start in range(0, len(i), PAIRS):
            some = slice(start, start + PAIRS)
            new[some] = ~(keys[i[some]] == keys[j[some]]).any(axis=1)
    nodes, weights = rows["node"], rows["weight"].astype(np.int64)
    counts = np.zeros(len(nodes), np.int64)
    np.add.at(counts, i[new], weights[j[new]])
    np.add.at(counts, j[new], weights[i[new]])
    linked = np.zeros((len(nodes), len(nodes)), bool)
    linked[i, j] = linked[j, i] = True
    least = stars(linked)
    some, moved = np.flatnonzero(counts), np.flatnonzero(least != np.arange(len(least)))
    return (
        np.concatenate([nodes[some], nodes[moved]]),
        np.concatenate([np.full(len(some), None, object), nodes[least[moved]]]),
        np.concatenate([counts[some], np.zeros(len(moved), np.int64)]),
    )


def task_rows(batches: Iterator[pd.DataFrame]) -> Iterator[dict[str, np.ndarray]]:
    """The rows of each task, two chunks at most, of a partition that is sorted by task and side."""
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        columns = {c: batch[c].to_numpy() for c in batch.columns}
        if held is not None:
            columns = {c: np.concatenate([held[c], v]) for c, v in columns.items()}
        task = columns["task"]
        cuts = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1).tolist()]
        for start, end in zip(cuts, cuts[1:], strict=False):
            yield {c: v[start:end] for c, v in columns.items()}
        held = {c: v[cuts[-1] :] for c, v in columns.items()}
    if held is not None:
        yield held


def compare_batches(cosine: float):
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting, size = [], 0
        for rows in task_rows(batches):
            out = compared(rows, cosine)
            if out is not None:
                waiting.append(out)
                size += len(out[0])
            if size >= PAIRS:
                yield found_frame(waiting)
                waiting, size = [], 0
        if waiting:
            yield found_frame(waiting)

    return compare


def found_frame(parts: list) -> pd.DataFrame:
    a, b, n = (np.concatenate(c) for c in zip(*parts, strict=True))
    return pd.DataFrame({"a": a, "b": pd.array(b, "Int64"), "n": n})


def chunks(rows: DataFrame, by: list[str], sizes: DataFrame, chunk: int) -> DataFrame:
    """Adds ``part``, a number below ``parts``: rows of a group of ``sizes`` go to chunks of about ``chunk``."""
    parts = F.ceil(F.col("size") / chunk).cast("int")
    hashed = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    return rows.join(sizes, by).withColumn("parts", parts).withColumn("part", hashed)


def task_name(*columns: str) -> Column:
    return F.to_json(F.array(*[F.col(c).cast("string") for c in columns])).alias("task")


def components(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = 0.93,
    width: float = WIDTH,
    hashes: int = HASHES,
    tables: int = TABLES,
    dense: int = DENSE,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per vector: ``key``, ``n_links``, ``component_id`` and ``kept``.

    Vectors of equal label, not null, are linked when their cosine in double precision is at least
    ``cosine`` (found as ``width``, ``hashes`` and at most 256 ``tables`` allow). ``n_links`` counts the other
    vectors linked directly, ``component_id`` is the least key reachable over links, and ``kept`` is true where
    that is the vector's own.

    Vectors that are null, empty, zero or hold null or non-finite components, or have no label, are linked with
    nothing, neither are vectors of different lengths. Rows with the same key, label and direction are
    one vector and each gets its row; rows with the same key but another label or direction are vectors of their
    own. A null key sorts after all others and stays null. Other columns take no part.
    """
    spark = df.sparkSession
    ship(spark)
    steps = Steps(spark, "euclid")
    angle, limit = F.pandas_udf(angle_batches, "double"), float(np.arccos(cosine))
    docs, nodes = classes(df, key, vector, label, F.pandas_udf(unit_batches(hashes, tables, width), UNITS), steps)
    buckets = steps.put("buckets", nodes.select(F.explode("keys").alias("bucket"), "node"))
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = steps.put("shared", buckets.join(steps.put("sizes", sizes), "bucket"))
    steps.drop("buckets", "sizes")
    ball_rows, balls = dense_balls(nodes, buckets.where(F.col("size") >= dense), angle, limit, steps)
    alone = steps.put("alone", buckets.drop("size").join(ball_rows.select("node"), "node", "left_anti"))
    presence = buckets.select("bucket", "node").join(ball_rows, "node").select("bucket", "ball").distinct()
    presence = steps.put("presence", presence)
    steps.drop("shared")

    # Classes outside balls, among themselves.
    met = alone.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    placed = chunks(alone, ["bucket"], steps.put("met", met), chunk)
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    placed = placed.select("node", "part", "bucket", other)
    placed = placed.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")})
    placed = placed.select(
        "node", task_name("bucket", "low", "high"), F.expr("low = high").alias("within"),
        F.expr("int(part = high AND low < high)").alias("side"), F.expr(f"int(bucket & {2**TABLE_BITS - 1})").alias("tbl"),
    )
    found = steps.put("found-0", compare(placed, nodes, cosine))

    # Balls and balls that meet; then classes and balls. All of a ball is linked, none, or some.
    all_linked, none_linked = limit - MARGIN, limit + MARGIN
    two = presence.withColumnRenamed("ball", "ball_2").join(presence, "bucket").where("ball < ball_2")
    two = two.select("ball", "ball_2").distinct().join(balls, "ball")
    two = two.join(balls.select(*(F.col(c).alias(f"{c}_2") for c in balls.columns)), "ball_2").where("label = label_2")
    two = two.withColumn("angle", angle("centre", "centre_2")).where(f"angle - radius - radius_2 <= {none_linked}")
    two = two.withColumn("whole", F.expr(f"angle + radius + radius_2 <= {all_linked}"))
    two = steps.put("two", two.select("ball", "ball_2", "total", "total_2", "first", "first_2", "whole"))
    near = alone.join(presence, "bucket").select("node", "ball").distinct()
    some = two.where("NOT whole").select("ball", F.col("ball_2").alias("met"))
    near = near.union(ball_rows.join(some, "ball").select("node", F.col("met").alias("ball")))
    own = nodes.select("node", "unit", "weight", F.col("label").alias("own_label"))
    single = near.join(own, "node").join(balls, "ball").where("label = own_label")
    single = single.withColumn("angle", angle("unit", "centre")).where(f"angle - radius <= {none_linked}")
    single = single.withColumn("whole", F.expr(f"angle + radius <= {all_linked}"))
    single = steps.put("single", single.select("node", "ball", "weight", "total", "first", "whole"))
    part = single.where("NOT whole").select("node", "ball")
    found = found.union(steps.put("found-1", compare(bipartite(part, ball_rows, balls, chunk), nodes, cosine)))

    # Counts: of comparisons, of whole balls, and of the own ball.
    gains = two.where("whole").select("ball", F.col("total_2").alias("gain"))
    gains = gains.union(two.where("whole").select("ball_2", "total"))
    gains = gains.union(single.where("whole").select("ball", "weight")).groupBy("ball").agg(F.sum("gain").alias("gain"))
    gains = steps.put("gains", balls.join(gains, "ball", "left").select("ball", F.expr("total + coalesce(gain, 0) AS gain"), "first"))
    inside = ball_rows.join(gains, "ball")
    counts = found.where("b IS NULL").select(F.col("a").alias("node"), "n")
    counts = counts.union(inside.join(nodes, "node").select("node", F.expr("gain - weight")))
    counts = counts.union(single.where("whole").select("node", "total"))
    counts = steps.put("counts", counts.groupBy("node").agg(F.sum("n").alias("n")))

    edges = found.where("b IS NOT NULL").select("a", "b").union(inside.where("node <> first").select("node", "first"))
    edges = edges.union(single.where("whole").select("node", "first")).union(two.where("whole").select("first", "first_2"))
    labels = label_components(steps.put("edges", edges.distinct()), steps)
    steps.drop(*(n for n in [*steps.paths] if n not in {"docs", "counts", "labels", "nodes"}))
    placed = docs.join(labels, "node", "left").withColumn("component", F.coalesce("label", "node")).drop("label")
    placed = placed.join(counts, "node", "left").join(nodes.select("node", "weight"), "node", "left")
    placed = placed.withColumn("n_links", F.expr("coalesce(n, 0) + coalesce(weight - 1, 0)"))
    placed = steps.put("placed", placed.select("key", "component", "n_links"))
    least = steps.put("least", placed.where("component IS NOT NULL").groupBy("component").agg(F.min("key").alias("least")))
    steps.drop("docs", "counts", "labels", "nodes")
    component = F.when(F.col("component").isNull(), F.col("key")).otherwise(F.col("least"))
    out = placed.join(least, "component", "left").select("key", "n_links", component.alias("component_id"))
    kept = F.col("key").eqNullSafe(F.col("component_id")).alias("kept")
    return out.select(F.col("key").alias(key), "n_links", "component_id", kept)


def classes(df: DataFrame, key: str, vector: str, label: str, units, steps: Steps) -> tuple[DataFrame, DataFrame]:
    """``key`` and ``node`` of all rows; and the classes of equal label, length and direction: ``node`` (a number),
    ``label``, ``unit``, ``keys`` and ``weight``, the vectors of the class."""
    kind = F.to_json(F.array(F.col(f"`{label}`").cast("string"), F.size(f"`{vector}`").cast("string")))
    rows = df.select(
        F.col(f"`{key}`").alias("key"),
        F.when(F.col(f"`{label}`").isNotNull(), kind).alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    ).withColumn("u", units("label", "vector"))
    name = F.unhex(F.md5(F.concat(F.col("u.unit"), F.col("label").cast("binary")))).alias("name")
    rows = steps.put("rows", rows.select("key", name, "label", "u.unit", "u.keys"))
    grouped = rows.where("name IS NOT NULL").groupBy("name").agg(
        *(F.first(c).alias(c) for c in ("label", "unit", "keys")),
        F.count_distinct(F.to_json(F.array("key"))).alias("weight"),
    )
    # Numbers are short, and fixed once they are written.
    nodes = steps.put("nodes", grouped.withColumn("node", F.monotonically_increasing_id()))
    docs = steps.put("docs", rows.select("key", "name").join(nodes.select("name", "node"), "name", "left").drop("name"))
    steps.drop("rows")
    return docs, nodes.drop("name")


def dense_balls(nodes: DataFrame, dense: DataFrame, angle, limit: float, steps: Steps) -> tuple[DataFrame, DataFrame]:
    """``node`` and ``ball`` of the classes in balls; and the balls: ``ball``, ``label``, ``centre``, ``radius``,
    ``size`` (classes), ``total`` (their weights) and ``first`` (the least class).

    A class goes to the largest of its dense buckets only, so it is in one ball at most.
    """
    mine = dense.groupBy("node").agg(F.max(F.struct("size", "bucket")).alias("m")).select("node", "m.bucket")
    mine = mine.join(nodes.select("node", "unit", "label", "weight"), "node")
    # Labels are part of a ball's name, should two of them have a key in common.
    mine = steps.put("mine", mine.withColumn("ball", F.to_json(F.array(F.col("bucket").cast("string"), "label"))).drop("bucket"))
    sums = mine.select("ball", "unit").mapInPandas(sum_batches, "ball string, dimension int, total long")
    sums = sums.groupBy("ball", "dimension").agg(F.sum("total").alias("total")).groupBy("ball")
    mean = sums.agg(F.array_sort(F.collect_list(F.struct("dimension", "total"))).alias("sums"))
    values = F.transform("sums", lambda s: s["total"].cast("double"))
    direction = F.pandas_udf(direction_batches, "binary")
    centres = steps.put("centres", mean.select("ball", direction(values).alias("centre")).where("centre IS NOT NULL"))
    inside = mine.join(centres, "ball").withColumn("angle", angle("unit", "centre")).where(F.col("angle") <= limit / 2 - MARGIN)
    inside = steps.put("inside", inside.select("node", "ball", "label", "angle", "weight"))
    balls = inside.groupBy("ball").agg(
        F.first("label").alias("label"), F.max("angle").alias("radius"), F.count(F.lit(1)).alias("size"),
        F.sum("weight").alias("total"), F.min("node").alias("first"),
    )
    return inside.select("node", "ball"), steps.put("balls", balls.join(centres, "ball"))


def bipartite(part: DataFrame, ball_rows: DataFrame, balls: DataFrame, chunk: int) -> DataFrame:
    """Rows of tasks that compare classes with the members of a ball."""
    ball = ["ball"]
    asked = part.groupBy("ball").agg(F.count(F.lit(1)).alias("size"))
    left = chunks(part, ball, asked, chunk)
    right = chunks(ball_rows.join(asked.select("ball"), ball), ball, balls.select("ball", "size"), chunk)
    n_left = asked.select("ball", F.ceil(F.col("size") / chunk).cast("int").alias("others"))
    n_right = balls.select("ball", F.ceil(F.col("size") / chunk).cast("int").alias("others"))
    every = F.explode(F.sequence(F.lit(0), F.col("others") - 1))
    left = left.drop("size").join(n_right, ball).select("node", "ball", F.col("part").alias("i"), every.alias("j"), F.lit(0).alias("side"))
    right = right.drop("size").join(n_left, ball).select("node", "ball", every.alias("i"), F.col("part").alias("j"), F.lit(1).alias("side"))
    both = left.unionByName(right)
    return both.select("node", task_name("ball", "i", "j"), F.lit(False).alias("within"), F.lit(-1).alias("tbl"), "side")


def compare(rows: DataFrame, nodes: DataFrame, cosine: float) -> DataFrame:
    """Runs the tasks. A task lies whole in one partition; labels that share a key are tasks of their own."""
    rows = rows.join(nodes, "node").withColumn("task", F.to_json(F.array("task", "label"))).drop("label")
    rows = rows.select("task", "side", "within", "tbl", "node", "unit", "keys", "weight")
    return rows.repartition("task").sortWithinPartitions("task", "side").mapInPandas(compare_batches(cosine), FOUND)
