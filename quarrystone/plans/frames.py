"""Weighted means over row frames in one sort, with a rim exchange between neighbouring tasks.

The rows are range-partitioned and sorted once.  A task finishes every frame that lies in its own partition while the
rows pass through it.  Only rows near its two ends need others: these rim rows, a frame's length at either end,
are marked in the written table, put next to the neighbour's and finished there.  A partition shorter than a rim
is rim as a whole and joins its neighbours, so frames may reach over any number of partitions.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ref
from .ordering import dealt_in_order, with_positions
from .scratch import written

# Executors need no copy of the package to run the kernels.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Cells of frames that one step multiplies.
STEP_CELLS = 1 << 22
DONE, RIM, OPEN = 0, 1, 2
_X, _SERIES, _MEAN, _STATE = "__x", "__series", "__mean", "__state"


def weighted(x: np.ndarray, series: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weighted mean of each run of ``len(weights)`` values; NaN where one is missing or of another series."""
    width = len(weights)
    n = max(len(x) - width + 1, 0)
    out = np.empty(n)
    for a in range(0, n, max(STEP_CELLS // width, 1)):
        b = min(a + max(STEP_CELLS // width, 1), n)
        frames = np.lib.stride_tricks.sliding_window_view(x[a : b + width - 1], width)
        out[a:b] = frames @ weights / weights.sum()
    # Rows are sorted by series, so a frame of one series begins and ends in it.
    out[series[:n] != series[width - 1 :][:n]] = np.nan
    return out


def _framed(before: int, after: int, weights: np.ndarray):
    """Rows of a sorted partition with their mean and state; the last rows are held until the end is known."""
    rim = before + after

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        past = (np.zeros(0), np.zeros(0, np.int64))  # values and series of up to ``before`` rows sent on
        sent = 0

        def out(rows: pa.RecordBatch, ready: int, last: bool) -> pa.RecordBatch:
            """The first ``ready`` rows, given those after them."""
            nonlocal past, sent
            x = np.concatenate([past[0], _numbers(rows, _X)])
            series = np.concatenate([past[1], rows.column(_SERIES).to_numpy()])
            known = len(past[0])
            mean = np.full(ready, np.nan)
            found = weighted(x, series, weights)
            # Frame i of ``found`` belongs to row i + before - known of the rows at hand.
            first = before - known
            some = np.arange(first, min(ready, first + len(found)))
            mean[some] = found[some - first]
            at = sent + np.arange(ready)
            state = np.where(at < rim, RIM, DONE)
            state[at < before] = OPEN
            if last:
                end = sent + ready
                state = np.maximum(state, np.where(at >= end - rim, RIM, DONE))
                state[at >= end - after] = OPEN
            keep = max(known + ready - before, 0)
            past, sent = (x[keep : known + ready], series[keep : known + ready]), sent + ready
            own = rows.slice(0, ready).drop_columns([_X, _SERIES])
            columns = [*own.columns, pa.array(mean, from_pandas=True), pa.array(state.astype(np.int32))]
            return pa.RecordBatch.from_arrays(columns, [*own.schema.names, _MEAN, _STATE])

        for batch in batches:
            held.append(batch)
            size = sum(b.num_rows for b in held)
            if size > 2 * rim + 1:
                rows = _one(held)
                yield out(rows, size - rim, False)
                held = [rows.slice(size - rim)]
        if sum(b.num_rows for b in held):
            rows = _one(held)
            yield out(rows, rows.num_rows, True)

    return run


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _numbers(rows: pa.RecordBatch, name: str) -> np.ndarray:
    return rows.column(name).to_numpy(zero_copy_only=False).astype(float)


def _met(before: int, after: int, weights: np.ndarray):
    """Open rows of rims that were put together, with their means."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = _one(held)
        x, series, state = _numbers(rows, _X), rows.column(_SERIES).to_numpy(), rows.column(_STATE).to_numpy()
        mean = np.full(rows.num_rows, np.nan)
        found = weighted(x, series, weights)
        mean[before : before + len(found)] = found
        mask = pa.array(state == OPEN)
        own = rows.drop_columns([_X, _SERIES, _STATE, _MEAN, "__seg"])
        made = pa.RecordBatch.from_arrays(
            [*own.columns, pa.array(mean, from_pandas=True)], [*own.schema.names, _MEAN]
        )
        yield made.filter(mask)

    return run


def frame_means(
    df: DataFrame,
    value: Column,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    weights: Sequence[float],
    before: int,
    name: str,
    position: str | None = None,
) -> DataFrame:
    """Add the weighted mean of the rows from ``before`` ahead to as many behind as ``weights`` goes on.

    Missing where the frame is not full, holds a missing value or reaches into another series.  ``position``
    adds the place of each row in the order of ``partition_by`` and ``order_by``.
    """
    weights = np.asarray(weights, float)
    after = len(weights) - 1 - before
    series = F.xxhash64(*[ref(c) for c in partition_by]) if partition_by else F.lit(0).cast("bigint")
    slot = "__slot"
    dealt = dealt_in_order(df, [*partition_by, *order_by], slot)
    fields = [*df.schema.fields, T.StructField(slot, T.LongType())]
    extra = [T.StructField(_MEAN, T.DoubleType()), T.StructField(_STATE, T.IntegerType())]
    coded = dealt.withColumns({_X: value, _SERIES: series})
    stored = written(coded.mapInArrow(_framed(before, after, weights), T.StructType([*fields, *extra])))

    part = F.shiftright(slot, 33)
    rims = stored.where(F.col(_STATE) != DONE).withColumns({_X: value, _SERIES: series, "__part": part})
    # Rims meet between long partitions: a long one's head belongs to the meeting before it, its tail to the next.
    rim = before + after
    within = F.col(slot).bitwiseAND(F.lit((1 << 33) - 1))
    sizes = rims.groupBy("__part").agg((F.max(within) >= 2 * rim).cast("int").alias("long"))
    meetings = sizes.withColumn("meeting", F.sum("long").over(Window.orderBy("__part")))  # one row a partition
    placed = rims.join(written(meetings), "__part")
    head = (F.col("long") == 1) & (within < rim)
    seg = F.col("meeting") - head.cast("int")
    # One series of one meeting is a series of its own; rows of different meetings never share a frame.
    apart = placed.withColumns({"__seg": seg, _SERIES: F.xxhash64(_SERIES, seg)})
    kinds = T.StructType([*fields, extra[0]])
    ordered = apart.select(*[f.name for f in fields], *[f.name for f in extra], _X, _SERIES, "__seg")
    ordered = ordered.repartition("__seg").sortWithinPartitions("__seg", slot)
    finished = ordered.mapInArrow(_met(before, after, weights), kinds)
    inner = stored.where(F.col(_STATE) != OPEN).drop(_STATE)
    both = inner.unionByName(finished)
    both = with_positions(both, stored, slot, position) if position else both
    return both.drop(slot, *[c for c in df.columns if c == name]).withColumnRenamed(_MEAN, name)
