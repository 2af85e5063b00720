"""Embedding columns as Arrow batches of plain numbers, and k-means on a sample."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ref


def valid(vector: str) -> F.Column:
    """Neither null nor holding a null or a component that is not finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return ref(vector).isNotNull() & ~F.exists(ref(vector), bad)


def dimension(df: DataFrame, vector: str) -> int:
    """The largest number of components; shorter vectors count as padded with zeros."""
    return df.agg(F.max(F.size(ref(vector))).alias("n")).first().n or 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows in double precision, padded with zeros to the width."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def rows(column: pa.Array | pa.ChunkedArray, dtype: str, width: int) -> np.ndarray:
    """Fixed-width binaries as rows."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype).reshape(len(values), width)


def binaries(x: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in x], pa.binary())


def squared_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * x @ y.T, 0)


def kmeans(x: np.ndarray, k: int, steps: int, rng: np.random.Generator) -> np.ndarray:
    """Centres of at most k clusters of the rows; empty clusters start again at random rows."""
    k = min(k, len(x))
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(steps):
        near = np.concatenate([squared_distances(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)])
        sums, times = np.zeros_like(centres), np.bincount(near, minlength=k)
        np.add.at(sums, near, x)
        centres = np.where(times[:, None] > 0, sums / np.maximum(times, 1)[:, None], x[rng.integers(0, len(x), k)])
    return centres
