"""Delimited records over many tasks, although quoted fields may hold line ends.

Whether a line begins a record depends on all quotes before it in its file.  Every split is therefore read for both
answers: a task counts the quotes of each of its splits and where the last record would begin if the split began
outside or inside a quoted field.  Running parities over the splits of a file (one row each) settle which it was.  A
second read then puts records together: those that lie in one split in the task that reads it, and those that reach over
split borders by a small aggregation of their lines.

A doubled quote keeps the parity, as does a quote in the middle of a field that is doubled to escape it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Executors need no copy of the package to read records.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _splits(batches: Iterator[pa.RecordBatch], skip: int) -> Iterator[tuple[str, int, int, pa.Array, np.ndarray]]:
    """Runs of lines of one split: file, where the split begins, number of the first line, lines, quotes before each.

    The first ``skip`` lines of a file are left out; quotes are counted from the beginning of the split.
    """
    own, at, quotes = None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        start = batch.column(2).to_numpy()
        file = batch.column(1).dictionary_encode().indices.to_numpy()
        bounds = np.flatnonzero(np.r_[True, (file[1:] != file[:-1]) | (start[1:] != start[:-1]), True])
        for a, b in zip(bounds[:-1], bounds[1:]):
            key = (batch.column(1)[int(a)].as_py(), int(start[a]))
            if key != own:
                own, at, quotes = key, 0, 0
            lines, first = batch.column(0).slice(a, b - a), at
            at += len(lines)
            drop = max(0, min(skip - first, len(lines))) if key[1] == 0 else 0
            lines = lines.slice(drop)
            counts = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64)
            yield *key, first + drop, lines, quotes + np.cumsum(counts) - counts
            quotes += int(counts.sum())


def _both_states(skip: int):
    """One row a run of lines: what the split would be if it began outside (0) or inside (1) a quoted field."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, start, first, lines, before in _splits(batches, skip):
            if not len(lines):
                continue
            last = [np.flatnonzero(before % 2 == s) for s in (0, 1)]
            ends = int(before[-1]) + int(pc.count_substring(lines.slice(len(lines) - 1), '"')[0].as_py())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([file]), pa.array([start], pa.int64()), pa.array([ends], pa.int64()),
                    *[pa.array([first + int(at[-1]) if len(at) else None], pa.int64()) for at in last],
                ],
                ["file", "start", "quotes", "last0", "last1"],
            )

    return run


def _records(skip: int, inside: dict[tuple[str, int], tuple[int, int]], whole: bool):
    """Records that end in the split they begin in, or (not ``whole``) the lines of all others.

    ``inside`` has, for each split that begins in a quoted field, the split and the line where its record began.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, at = None, [], None  # lines of the record that is open, and where it began

        def open_parts() -> pa.RecordBatch:
            n = len(held)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([own[0]] * n, pa.string()), pa.array([at[0]] * n, pa.int64()), pa.array([at[1]] * n, pa.int64()),
                    pa.array([own[1]] * n, pa.int64()), pa.array([i for i, _ in held], pa.int64()),
                    pa.array([v for _, v in held], pa.string()),
                ],
                ["file", "split", "line", "part", "i", "value"],
            )

        for file, start, first, lines, before in _splits(batches, skip):
            if (file, start) != own:
                if held and not whole:
                    yield open_parts()
                own, held, at = (file, start), [], inside.get((file, start))
            state = (before + ((file, start) in inside)) % 2
            counts = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
            after = (state + counts) % 2
            alone = (state == 0) & (after == 0)
            if whole:
                done, place = lines.filter(pa.array(alone)), first + np.flatnonzero(alone)
            values, places = [], []
            for k in np.flatnonzero(~alone):  # lines of records of several lines
                if state[k] == 0:
                    held, at = [], (start, first + int(k))
                held.append((first + int(k), lines[int(k)].as_py()))
                if after[k] == 0:
                    if at[0] == start:
                        values.append("\n".join(v for _, v in held))
                        places.append(at[1])
                    elif not whole:
                        yield open_parts()
                    held = []
            if whole and len(lines):
                n = len(place) + len(values)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file] * n, pa.string()), pa.array([start] * n, pa.int64()),
                        pa.array(np.append(place, np.array(places, np.int64))),
                        pa.concat_arrays([done.cast(pa.string()), pa.array(values, pa.string())]),
                    ],
                    ["file", "split", "line", "value"],
                )
        if held and not whole:
            yield open_parts()

    return run


def read_records(spark: SparkSession, path: str, *, encoding: str = "utf-8", skip: int = 0) -> DataFrame:
    """``file, split, line, value``: the records of all files and where each begins.

    Lines end with a line feed, with or without a carriage return; the first ``skip`` lines of each file are left out.
    The driver gets one row for each split that begins inside a quoted field.
    """
    text = spark.read.option("encoding", encoding).option("lineSep", "\n").text(path)
    lines = text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    kind = "file string, start bigint, quotes bigint, last0 bigint, last1 bigint"
    runs = lines.mapInArrow(_both_states(skip), kind)
    splits = runs.groupBy("file", "start").agg(*[F.max(c).alias(c) for c in ("quotes", "last0", "last1")])
    order = Window.partitionBy("file").orderBy("start")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    state = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2
    told = splits.withColumn("state", state).withColumn("last", F.when(F.col("state") == 0, F.col("last0")).otherwise(F.col("last1")))
    began = F.when(F.col("last").isNotNull(), F.struct("start", "last"))
    opened = told.withColumn("began", F.last(began, ignorenulls=True).over(earlier)).where("state = 1")
    inside = {(r.file, r.start): (r.began.start, r.began.last) for r in opened.select("file", "start", "began").collect()}
    found = lines.mapInArrow(_records(skip, inside, True), "file string, split bigint, line bigint, value string")
    if inside:
        kind = "file string, split bigint, line bigint, part bigint, i bigint, value string"
        parts = lines.mapInArrow(_records(skip, inside, False), kind).groupBy("file", "split", "line")
        pieces = F.array_sort(F.collect_list(F.struct("part", "i", "value")))
        joined = parts.agg(F.array_join(pieces["value"], "\n").alias("value"))
        found = found.unionByName(joined)
    return found.withColumn("value", F.regexp_replace("value", "\r$", ""))
