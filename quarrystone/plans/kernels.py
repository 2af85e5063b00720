"""Sums of Gaussian kernels over an even grid, added up in the tasks that read the values.

A task sorts the values of a batch, counts equal ones, and adds their kernels to the grid points within ``REACH``
bandwidths; what lies further away is below 3e-16 of a kernel's height.  It sends one row a group, however many values it
has read, so no value becomes a row for each grid point and no value is shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Executors need no copy of the package to add kernels.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

REACH = 8.5
# Values times grid points of one step, and groups a task holds before it sends them on.
STEP_CELLS, HELD_GROUPS = 1 << 21, 10_000


def kernel_sums(values: np.ndarray, start: float, step: float, h: float, points: int) -> np.ndarray:
    """The sum of exp(-((x - value) / h)**2 / 2) over the values at each grid point x = start + i * step."""
    out = np.zeros(points)
    distinct, times = np.unique(values, return_counts=True)
    a = 0
    while a < len(distinct):
        b = min(a + max(STEP_CELLS // points, 1), len(distinct))
        first = max(int(np.ceil((distinct[a] - REACH * h - start) / step)), 0) if step > 0 else 0
        last = min(int(np.floor((distinct[b - 1] + REACH * h - start) / step)), points - 1) if step > 0 else points - 1
        if first <= last:
            x = start + np.arange(first, last + 1) * step
            z = (x[:, None] - distinct[a:b]) / h
            out[first : last + 1] += np.exp(-0.5 * z * z) @ times[a:b]
        a = b
    return out


def _summed(points: int):
    """Rows (group, value, start, step, h) to rows (group, sums)."""

    def sent(held: dict[int, np.ndarray]) -> pa.RecordBatch:
        flat = np.concatenate(list(held.values()))
        lists = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, points, dtype=np.int32), pa.array(flat))
        return pa.RecordBatch.from_arrays([pa.array([*held], pa.int64()), lists], ["g", "sums"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            group, value, start, step, h = (c.to_numpy() for c in batch.columns)
            order = np.argsort(group, kind="stable")
            edges = np.flatnonzero(np.r_[True, np.diff(group[order]) != 0, True]) if len(order) else [0]
            for a, b in zip(edges[:-1], edges[1:]):
                own = order[a:b]
                k = own[0]
                sums = kernel_sums(value[own], start[k], step[k], h[k], points)
                g = int(group[k])
                held[g] = held[g] + sums if g in held else sums
            if len(held) >= HELD_GROUPS:
                yield sent(held)
                held = {}
        if held:
            yield sent(held)

    return run


def grid_sums(rows: DataFrame, points: int) -> DataFrame:
    """``g, i, sum`` from rows ``g`` (bigint), ``v``, ``start``, ``step``, ``h``, the last three the same in a group."""
    coded = rows.select("g", "v", "start", "step", "h")
    parts = coded.mapInArrow(_summed(points), "g bigint, sums array<double>")
    each = parts.select("g", F.posexplode("sums").alias("i", "s"))
    return each.groupBy("g", "i").agg(F.sum("s").alias("sum"))
