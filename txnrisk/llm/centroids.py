"""Centroid clustering of whole-number vectors by scalar lookup tables.

A round needs the squared difference of every component and every centroid. The components are whole
numbers and few different ones occur in a dimension, so each is squared once: for a run of vectors
and each dimension a table holds the squared difference of every occurring value and every centroid,
and the distances are gathered from the tables and summed up.

A round is one pass over the staged vectors. Each task gives out the count and the sums of its
vectors by cluster, some hundred numbers; they are added up as decimals, and the new centroids are
exact floors of whole-number quotients. Neither the order nor the number of tasks changes a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import ship
from txnrisk.llm.steps import Steps
from txnrisk.llm.vectors import quantized, runs

ROWS = 4096  # vectors whose values are tabulated together


def distances(matrix: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of the rows to the centroids, from a table for each dimension."""
    reach = int(np.abs(matrix).max(initial=0)) + int(np.abs(centroids).max(initial=0))
    if matrix.shape[1] * reach**2 >= 1 << 63:
        raise ValueError("squared distances exceed 64 bits")
    total = np.zeros((len(matrix), len(centroids)), np.int64)
    for column, centres in zip(matrix.T, centroids.T, strict=True):
        values, place = np.unique(column, return_inverse=True)
        table = (values[:, None] - centres[None, :]) ** 2
        total += table[place]
    return total


def nearest(matrix: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller one) and the squared distance to it."""
    total = distances(matrix, centroids)
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(len(matrix)), cluster]


def sum_batches(centroids: np.ndarray):
    """Count and sums of a task's vectors by cluster and dimension. Dimension -1 holds the count."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k, size = centroids.shape
        counts, added = np.zeros(k, np.int64), [[0] * size for _ in range(k)]  # Python's numbers do not overflow
        for _, matrix in runs(batches, ROWS):
            cluster, _ = nearest(matrix, centroids)
            counts += np.bincount(cluster, minlength=k)
            for number in np.unique(cluster):
                part = matrix[cluster == number].sum(axis=0).tolist()
                added[number] = [a + b for a, b in zip(added[number], part, strict=True)]
        used = np.flatnonzero(counts).tolist()
        if used:
            rows = [(c, d, str(v)) for c in used for d, v in enumerate([int(counts[c]), *added[c]], -1)]
            yield pd.DataFrame(rows, columns=["cluster", "dimension", "total"])

    return sums


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round; one without vectors stays."""
    sums = vectors.mapInPandas(sum_batches(centroids), "cluster int, dimension int, total string")
    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    found = {(r["cluster"], r["dimension"]): int(r["total"]) for r in sums.groupBy("cluster", "dimension").agg(total).collect()}
    out = centroids.copy()
    for c in range(len(centroids)):
        if n := found.get((c, -1)):
            out[c] = [found[c, d] // n for d in range(centroids.shape[1])]
    return out


def assign_batches(centroids: np.ndarray):
    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, matrix in runs(batches, ROWS):
            cluster, distance = nearest(matrix, centroids)
            yield pd.DataFrame({"key": part["key"].to_numpy(), "cluster": cluster, "distance": distance})

    return assign


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    size: int = 64,
    k: int = 8,
    rounds: int = 10,
    scale: float = 1024.0,
    seed: str = "3",
) -> DataFrame:
    """One row per vector: ``key``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``
    and ``centroid_sha256``.

    Vectors of exactly ``size`` components take part, as floor(scale * x); those that are null, or
    hold a null or non-finite component, do not. The centroids start as the ``k`` vectors (all, if
    fewer) with the least sha256 of ``<seed>:<key>``; ties go by vector. Each round assigns every
    vector and replaces each centroid that has vectors by the floor of their mean.

    Rows repeat as often as they come, and each counts. A row with a null key is clustered like any
    other but starts no centroid. Other columns of ``df`` take no part. An empty table gives an
    empty one. Squared distances beyond 64 bits are an error, as are components.
    """
    spark = df.sparkSession
    ship(spark)
    steps = Steps(spark, "centroids")
    whole = quantized(df.where(F.size(f"`{vector}`") == size), key, vector, scale, null_keys=True)
    vectors = steps.put("vectors", whole)
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    first = vectors.where("key IS NOT NULL").select(drawn.alias("drawn"), "vector").orderBy("drawn", "vector").limit(k).collect()
    if not first:
        return spark.createDataFrame(
            [], f"`{key}` long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    centroids = np.frombuffer(b"".join(r["vector"] for r in first), np.int64).reshape(len(first), size)
    for _ in range(rounds):
        after = moved(vectors, centroids)
        if (after == centroids).all():  # further rounds change nothing
            break
        centroids = after
    assigned = steps.put("assigned", vectors.mapInPandas(assign_batches(centroids), "key long, cluster int, distance long"))
    steps.drop("vectors")
    within = F.sum(F.col("distance").cast("decimal(38,0)")).alias("within")
    inertia = {r["cluster"]: int(r["within"]) for r in assigned.groupBy("cluster").agg(within).collect()}

    def of_cluster(values: list, kind: str):
        return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster"))

    numbers = range(len(centroids))
    return assigned.select(
        F.col("key").alias(key),
        "cluster",
        "distance",
        of_cluster([inertia.get(c) for c in numbers], "long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        of_cluster([centroid_digest(centroids[c]) for c in numbers], "string").alias("centroid_sha256"),
    )
