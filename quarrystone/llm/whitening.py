"""Whitening of embeddings by spectral divide-and-conquer with QDWH polar decompositions.

Components are scaled to whole numbers, x = floor(scale * c), and every distinct x-vector counts once in the fit.  Tasks
send column sums and then blocks of centred products, one row of the covariance each, which Spark adds up; the
driver holds only matrices of dimension x dimension.  Their eigenvectors come from polar decompositions: the unitary polar factor U of
V - shift * I has eigenvalues +1 and -1, so (I + U) / 2 projects on the components above the shift.  The polar
factor is computed by the QR-based dynamically weighted Halley iteration, an orthonormal basis of the projector's
range and of its complement splits the matrix into two smaller ones, and so on until each is one number.
The components, sorted by their eigenvalues, go to the tasks (components x dimension numbers), which whiten every row.

Defined results: vectors that are null or hold null or non-finite entries are dropped; shorter vectors count as padded with zeros;
rows that repeat an id or a vector are whitened each; components without variance (an eigenvalue below
the rounding of the largest one) are whitened to 0 and left out of the identity error; a deviation that does not
fit a long is null; an empty table gives no rows; other columns are ignored.  An entry of 2**53 / scale or more raises
ValueError, as it has no exact whole number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import written
from .common import ref, require
from .vectors import dimension, matrix, valid

SCALE, COMPONENTS = 256, 4
# The driver decomposes a matrix of this many rows at most.
MOST_DIMENSIONS = 4096
# Rows that one step of a task multiplies.
STEP_ROWS = 8192
_EPS = np.finfo(float).eps
# A polar factor is settled when a step moves it by less; more steps than the theory's six are never needed.
_SETTLED, _MOST_STEPS = 10 * _EPS, 12


# Spectral divide-and-conquer -------------------------------------------------------------------------------------


def polar(a: np.ndarray) -> np.ndarray:
    """The unitary polar factor of a symmetric matrix, by dynamically weighted Halley steps with QR."""
    n = len(a)
    x, low = a / np.linalg.norm(a), _EPS
    for _ in range(_MOST_STEPS):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square**2)
        wa = np.sqrt(1 + d) + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d))) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(n)]))
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x), new
        low = min(low * (wa + wb * square) / (1 + wc * square), 1.0)
        if moved <= _SETTLED * np.sqrt(n) or (low == 1.0 and moved <= np.sqrt(_EPS)):
            break
    return x


def _basis(projector: np.ndarray, rank: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the projector's range and of its complement."""
    n = len(projector)
    q, _ = np.linalg.qr(np.hstack([projector @ rng.standard_normal((n, rank)), rng.standard_normal((n, n - rank))]))
    q, _ = np.linalg.qr(np.hstack([projector @ q[:, :rank], q[:, rank:]]))  # a second pass mends an unlucky draw
    return q[:, :rank], q[:, rank:]


def _split(a: np.ndarray, scale: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of two invariant subspaces; None when the matrix is a number times the identity."""
    n, diagonal = len(a), np.diag(a)
    centre = diagonal.mean()
    spread = np.linalg.norm(a - centre * np.eye(n))
    if spread <= _EPS * scale:
        return None
    # The mean lies strictly between the extreme eigenvalues; the others serve balance and a shift that hits one.
    shifts = [np.median(diagonal), centre, *(centre + spread / n * k for k in (-0.11, 0.07, -0.31, 0.29))]
    best = None
    for shift in shifts:
        if np.linalg.norm(a - shift * np.eye(n)) == 0:
            continue
        projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < n:
            continue
        first, second = _basis(projector, rank, rng)
        left = np.linalg.norm(second.T @ a @ first)  # what couples the two parts
        if best is None or left < best[0]:
            best = (left, first, second)
        if left <= 8 * _EPS * scale * np.sqrt(n):
            break
    return best and best[1:]


def spectral(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix in falling order and its unit eigenvectors as columns."""
    n = len(a)
    a = (a + a.T) / 2
    scale, rng = float(np.linalg.norm(a)), np.random.default_rng(41)
    found: list[np.ndarray] = []
    waiting = [np.eye(n)]
    while waiting:
        base = waiting.pop()
        part = base.T @ a @ base
        halves = _split((part + part.T) / 2, scale, rng) if base.shape[1] > 1 else None
        if halves is None:
            found.append(base)
        else:
            waiting += [base @ half for half in halves]
    vectors = np.hstack(found) if found else np.zeros((0, 0))
    vectors, _ = np.linalg.qr(vectors) if n else (vectors, None)
    values = ((a @ vectors) * vectors).sum(0)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# Fit --------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """What tasks need: the number of fitted vectors, sums, and every component with its eigenvalue."""

    n: int
    width: int
    scale: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def used(self) -> np.ndarray:
        """Components that have variance beyond rounding."""
        return self.values > self.width * _EPS * max(self.trace, 0.0)

    def projection(self, components: int) -> np.ndarray:
        """Centred x-vectors times this are whitened."""
        k = min(components, self.width)
        use = self.used()[:k]
        return np.where(use, self.vectors[:, :k] / np.sqrt(np.where(use, self.values[:k], 1.0)), 0.0)

    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace > 0 else np.zeros(self.width)


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * value) as long."""
    floors = np.floor(scale * values)
    if floors.size and np.abs(floors).max() >= 2.0**53:
        raise ValueError(f"Entries of {2**53 // scale} or more have no exact whole number")
    return floors.astype(np.int64)


def _pack(x: np.ndarray) -> list[bytes]:
    """Each row in the narrowest width that holds it: equal rows give equal bytes."""
    top = np.abs(x).max(1, initial=0)
    kinds = np.where(top < 1 << 15, 2, np.where(top < 1 << 31, 4, 8))
    return [r.astype(f"<i{k}").tobytes() + bytes([k]) for r, k in zip(x, kinds)]


def _unpack(column: pa.Array, width: int) -> np.ndarray:
    values = column.to_pylist()
    if all(v[-1] == 2 for v in values):
        flat = np.frombuffer(b"".join([v[:-1] for v in values]), "<i2")
        return flat.reshape(len(values), width).astype(np.int64)
    return np.stack([np.frombuffer(v[:-1], f"<i{v[-1]}").astype(np.int64) for v in values])


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, STEP_ROWS):
            yield batch.slice(first, STEP_ROWS)


def _lists(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(0, rows.size + 1, max(rows.shape[1], 1), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).reshape(-1)))


def _packed(scale: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _steps(batches):
            x = whole(matrix(some.column(0), width), scale)
            yield pa.RecordBatch.from_arrays([pa.array(_pack(x), pa.binary())], ["x"])

    return run


def _sum_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(width, np.int64)
        for some in _steps(batches):
            n, sums = n + some.num_rows, sums + _unpack(some.column(0), width).sum(0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), _lists(sums[None])], ["n", "sums"])

    return run


def _products(n: int, sums: np.ndarray, projection: np.ndarray | None, shift: np.ndarray | None):
    """Rows of the sum of centred products, of x-vectors or of their projections less ``shift``."""
    width = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for some in _steps(batches):
            x = _unpack(some.column(0), width) - sums / n
            if projection is not None:
                x = x @ projection - shift
            total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), _lists(total)], ["i", "v"])

    return run


def _projected_sums(n: int, sums: np.ndarray, projection: np.ndarray):
    width = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(projection.shape[1])
        for some in _steps(batches):
            total += ((_unpack(some.column(0), width) - sums / n) @ projection).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([0]), _lists(total[None])], ["i", "v"])

    return run


def _added(rows: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """The sum over all tasks of rows i of a matrix; the driver gets one number for each place."""
    each = rows.select("i", F.posexplode("v").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros(shape)
    for i, j, v in each.collect():
        out[i, j] = v
    return out


def fit_list(df: DataFrame, vector_col: str, scale: int, width: int) -> DataFrame:
    """Each distinct x-vector once, as bytes; written."""
    vectors = df.where(valid(vector_col)).select(ref(vector_col).alias("v"))
    return written(vectors.mapInArrow(_packed(scale, width), "x binary").distinct())


def fit(fitted: DataFrame, scale: int, width: int) -> Whitening | None:
    """From the list of ``fit_list``; None for an empty one."""
    if width > MOST_DIMENSIONS:
        raise ValueError(f"At most {MOST_DIMENSIONS} dimensions, as the driver holds their covariance")
    parts = fitted.mapInArrow(_sum_rows(width), "n bigint, sums array<bigint>")
    each = parts.select("n", F.posexplode("sums").alias("j", "s"))
    rows = each.groupBy("j").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("j").collect()
    if not rows:
        return None
    n, sums = rows[0].n, np.array([r.s for r in rows], np.int64)
    products = fitted.mapInArrow(_products(n, sums, None, None), "i bigint, v array<double>")
    covariance = _added(products, (width, width)) / n
    values, vectors = spectral(covariance)
    return Whitening(n, width, scale, sums, values, vectors, float(np.trace(covariance)))


def identity_error(fitted: DataFrame, model: Whitening, components: int) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity, by two passes."""
    projection = model.projection(components)[:, model.used()[:components]]
    k = projection.shape[1]
    if not k:
        return 0.0
    kind = "i bigint, v array<double>"
    mean = _added(fitted.mapInArrow(_projected_sums(model.n, model.sums, projection), kind), (1, k))[0] / model.n
    products = fitted.mapInArrow(_products(model.n, model.sums, projection, mean), kind)
    return float(np.abs(_added(products, (k, k)) / model.n - np.eye(k)).max())


# Application ------------------------------------------------------------------------------------------------------


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The sum over dimensions of (n * x - sum)**2 in whole numbers."""
    most = n * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0))
    if most * most * max(len(sums), 1) < 1 << 63:
        return ((n * x - sums) ** 2).sum(1).tolist()
    exact = ((n * x.astype(object) - sums.astype(object)) ** 2).sum(1)
    return [v if v < 1 << 63 else None for v in exact]


def _apply(model: Whitening, components: int):
    projection, mean = model.projection(components), model.sums / model.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _steps(batches):
            x = whole(matrix(some.column(1), model.width), model.scale)
            yield pa.RecordBatch.from_arrays(
                [
                    some.column(0),
                    pa.array(deviations(x, model.n, model.sums), pa.int64()),
                    _lists((x - mean) @ projection),
                ],
                ["id", "deviation", "whitened"],
            )

    return run


def whiten(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
) -> tuple[DataFrame, Whitening | None, float]:
    """id, deviation and the whitened vector (an array) of each valid row; the model; the identity error."""
    require(df, id_col, vector_col)
    width = dimension(df.where(valid(vector_col)), vector_col)
    fitted = fit_list(df, vector_col, scale, width) if width else None
    model = fit(fitted, scale, width) if width else None
    rows = df.where(valid(vector_col)).select(ref(id_col).alias("id"), ref(vector_col).alias("v"))
    kind = f"id {rows.schema[0].dataType.simpleString()}, deviation bigint, whitened array<double>"
    if model is None:
        return df.sparkSession.createDataFrame([], kind), None, 0.0
    return rows.mapInArrow(_apply(model, components), kind), model, identity_error(fitted, model, components)


def whitened_components(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows, model, error = whiten(df, id_col, vector_col, components, scale)
    n, shares = (model.n, model.explained()[:components]) if model else (0, [])
    share = F.array(*[F.lit(float(s)) for s in shares]) if len(shares) else F.array().cast("array<double>")
    each = rows.select("id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return each.select(
        F.col("id").alias("vec_id"), (F.col("k") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"),
        "deviation", "whitened", F.element_at(share, F.col("k") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
