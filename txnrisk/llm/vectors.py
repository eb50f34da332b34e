"""Vectors of whole numbers: quantized, packed, and given out as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LARGEST = 2.0**62  # scaled components below this fit 64 bits
ROWS = 2048  # vectors of a matrix
BUFFER = 200_000  # found rows that a task holds before it keeps the best of each window


def quantized_batches(scale: float):
    def quantize(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            out = []
            for vector in vectors:
                whole = None
                if vector is not None:
                    values = np.array([np.nan if x is None else x for x in vector], np.float64)
                    if np.isfinite(values).all():
                        scaled = np.floor(scale * values)
                        if np.abs(scaled).max(initial=0.0) >= LARGEST:
                            raise ValueError("a scaled component exceeds 64 bits")
                        whole = scaled.astype(np.int64).tobytes()
                out.append(whole)
            yield pd.Series(out, dtype=object)

    return quantize


def quantized(
    df: DataFrame, key: str, vector: str, scale: float, label: str | None = None, null_keys: bool = False
) -> DataFrame:
    """``key``, ``vector`` (floor(scale * x) of each component as 64-bit numbers, packed) and, if given, ``label``.

    Rows with a null vector, a null or non-finite component, a null label or (without ``null_keys``)
    a null key are left out. A component that does not fit 64 bits once scaled is an error.
    """
    pack = F.pandas_udf(quantized_batches(scale), "binary")
    for c in (key, label):
        if c is not None and not (c == key and null_keys):
            df = df.where(F.col(f"`{c}`").isNotNull())
    labels = [] if label is None else [F.col(f"`{label}`").alias("label")]
    values = F.col(f"`{vector}`").cast("array<double>")
    packed = df.select(F.col(f"`{key}`").cast("long").alias("key"), *labels, pack(values).alias("vector"))
    return packed.where("vector IS NOT NULL")


def runs(batches: Iterator[pd.DataFrame], rows: int = ROWS) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Rows whose vectors have one length, ``rows`` at most, and their matrix."""
    for batch in batches:
        for size, same in batch.groupby(batch["vector"].map(len), sort=False):
            for start in range(0, len(same), rows):
                part = same.iloc[start : start + rows]
                yield part, np.frombuffer(b"".join(part["vector"]), np.int64).reshape(len(part), size // 8)


class Best:
    """The first rows of each window, of those that a task has met."""

    def __init__(self, windows: int, size: int):
        self.size, self.floor = size, np.full(windows, -(2**63), np.int64)
        self.kept = [np.empty(0, np.int64)] * 3
        self.fresh: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0

    def add(self, window: np.ndarray, key: np.ndarray, score: np.ndarray) -> None:
        self.fresh.append((window, key, score))
        self.waiting += len(window)
        if self.waiting > BUFFER:
            self.settle()

    def settle(self) -> None:
        window, key, score = (np.concatenate(c) for c in zip(self.kept, *self.fresh, strict=True))
        order = np.lexsort((key, -score, window))
        window, key, score = window[order], key[order], score[order]
        begin = np.flatnonzero(np.r_[True, window[1:] != window[:-1]]) if len(window) else np.empty(0, np.int64)
        rank = np.arange(len(window)) - np.repeat(begin, np.diff(np.r_[begin, len(window)]))
        keep = rank < self.size
        full = rank == self.size - 1
        self.floor[window[full]] = score[full]  # what scores less is beyond a full window
        self.kept, self.fresh, self.waiting = [window[keep], key[keep], score[keep]], [], 0
