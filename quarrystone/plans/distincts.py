"""Exact distinct counts of many columns in one pass, without a row per column and value.

Several distinct counts in one aggregate expand every row once a column.  Here each value becomes two 64-bit hashes in the
scan; a task keeps the distinct pairs of its rows, column by column, and only these are shuffled and counted.  Two
values count as one when both hashes agree (128 bits; the first alone tells whole numbers apart).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import value

# Executors need no copy of the package to collect hashes.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Pairs of hashes a task holds; beyond that the largest column is sent on, and repeats across parts meet in the shuffle.
HELD_PAIRS = 1 << 20
# New pairs of a column before its repeats are taken out.
NEW_PAIRS = 1 << 16


def _hashes(df: DataFrame, name: str) -> list[Column]:
    """Two hashes with different seeds, null where the value is missing."""
    own = value(df, name)
    if isinstance(df.schema[name].dataType, T.MapType):
        own = F.array_sort(F.map_entries(own))
    return [F.when(own.isNotNull(), h) for h in (F.xxhash64(own), F.xxhash64(F.lit("second"), own))]


def _distinct(parts: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    return pa.Table.from_batches(parts).group_by(["a", "b"], use_threads=False).aggregate([]).to_batches()


def _rows(parts: list[pa.RecordBatch]) -> int:
    return sum(p.num_rows for p in parts)


def _pairs(width: int, held_pairs: int, new_pairs: int):
    """The distinct pairs of each column in the rows of a task, then how many values it has and lacks."""

    def sent(place: int, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            n, none = part.num_rows, pa.nulls(part.num_rows, pa.int64())
            columns = [pa.array(np.full(n, place, np.int32)), part.column(0), part.column(1), none, none]
            yield pa.RecordBatch.from_arrays(columns, ["position", "a", "b", "known", "missing"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[pa.RecordBatch]] = [[] for _ in range(width)]
        size, limit = np.zeros(width, np.int64), np.full(width, new_pairs)
        known, rows = np.zeros(width, np.int64), 0

        def compact(i: int) -> None:
            held[i] = _distinct(held[i])
            size[i] = _rows(held[i])
            limit[i] = size[i] + max(size[i], new_pairs)

        for batch in batches:
            rows += batch.num_rows
            for i in range(width):
                part = pa.RecordBatch.from_arrays([batch.column(2 * i), batch.column(2 * i + 1)], ["a", "b"])
                if part.column(0).null_count:
                    part = part.filter(part.column(0).is_valid())
                if not part.num_rows:
                    continue
                known[i] += part.num_rows
                held[i].append(part)
                size[i] += part.num_rows
                if size[i] > limit[i]:
                    compact(i)
            while size.sum() > held_pairs:
                most, before = int(size.argmax()), int(size.max())
                compact(most)
                if 2 * size[most] > before:
                    yield from sent(most, held[most])
                    held[most], size[most], limit[most] = [], 0, new_pairs
        for i in range(width):
            if held[i]:
                yield from sent(i, _distinct(held[i]))
        none = pa.nulls(width, pa.int64())
        counts = [pa.array(np.arange(width, dtype=np.int32)), none, none, pa.array(known), pa.array(rows - known)]
        yield pa.RecordBatch.from_arrays(counts, ["position", "a", "b", "known", "missing"])

    return run


def distinct_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row with ``u0, k0, m0, u1, ...``: distinct, known and missing values of each column."""
    flat = [h.alias(f"h{i}_{side}") for i, c in enumerate(names) for side, h in zip("ab", _hashes(df, c))]
    kind = "position int, a bigint, b bigint, known bigint, missing bigint"
    pairs = df.select(*flat).mapInArrow(_pairs(len(names), HELD_PAIRS, NEW_PAIRS), kind)
    # Sums ride along, so that the one shuffle by pair serves both.
    once = pairs.groupBy("position", "a", "b").agg(F.sum("known").alias("known"), F.sum("missing").alias("missing"))
    columns = once.groupBy("position").agg(F.count("a").alias("u"), F.sum("known").alias("k"), F.sum("missing").alias("m"))
    return columns.agg(
        *[
            F.coalesce(F.max(F.when(F.col("position") == i, F.col(stat))), F.lit(0)).alias(f"{stat}{i}")
            for i in range(len(names))
            for stat in ("u", "k", "m")
        ]
    )
