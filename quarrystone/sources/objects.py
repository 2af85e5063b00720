"""The objects of large JSON documents over many tasks.

A document is read in fragments that end with a closing brace, which Spark cuts from any byte range of a file.  What a brace
means depends on everything before it: whether it stands in a string, and how deep.  A first read counts for each
split the quotes and, for both answers to whether it begins inside a string, how far the depth moves.  Running sums
over the splits of a file (one row each) settle where every split begins.  A second read cuts the objects
out: those that lie in one split in the task that reads it, those that reach over borders by a small aggregation of
their pieces.  A task holds one batch of fragments and one object.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Executors need no copy of the package to cut objects out.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUOTE, BACKSLASH, OPEN, CLOSE = (ord(c) for c in '"\\{}')
BLANKS = b" \t\r\n"
MARK = b"\xef\xbb\xbf"  # byte order mark
# What may stand between the objects of a document.
BETWEEN = BLANKS + b",[]}" + MARK


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, np.ndarray]]:
    """Bytes of consecutive fragments of one split, each with the brace that ended it."""
    for batch in batches:
        if not batch.num_rows:
            continue
        start = batch.column(2).to_numpy()
        file = batch.column(1).dictionary_encode().indices.to_numpy()
        bounds = np.flatnonzero(np.r_[True, (file[1:] != file[:-1]) | (start[1:] != start[:-1]), True])
        for a, b in zip(bounds[:-1], bounds[1:]):
            text = "}".join(batch.column(0).slice(a, b - a).to_pylist()) + "}"
            yield batch.column(1)[int(a)].as_py(), int(start[a]), np.frombuffer(text.encode(), np.uint8)


def _first(data: np.ndarray) -> str:
    """The first character of a document; fragments reach at least to its first brace."""
    return data.tobytes().lstrip(BLANKS + MARK)[:1].decode("latin-1")


def structure(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of quotes and brackets, the step each means for the depth, and the quotes up to each.

    A quote after an odd number of backslashes is escaped.  A run begins after a closing brace, so never within an escape.
    """
    mark = np.zeros(256, bool)
    mark[[QUOTE, OPEN, CLOSE, ord("["), ord("]")]] = True
    step = np.zeros(256, np.int64)
    step[[OPEN, ord("[")]], step[[CLOSE, ord("]")]] = 1, -1
    at = np.flatnonzero(mark[data])
    quote = data[at] == QUOTE
    plain = data != BACKSLASH
    if not plain.all():
        last = np.maximum.accumulate(np.where(plain, np.arange(len(data)), -1))
        before = np.where(at > 0, at - 1 - last[at - 1], 0)
        quote &= before % 2 == 0
    return at, step[data[at]], np.cumsum(quote)


def _both_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a run: its quotes, its first character, and the change of depth if the split began outside or inside a string."""
    own, quotes = None, 0
    for file, start, data in _runs(batches):
        first = None
        if (file, start) != own:
            own, quotes = (file, start), 0
            first = _first(data) if start == 0 else None
        _, step, seen = structure(data)
        moved = [int(step[(seen + quotes + s) % 2 == 0].sum()) for s in (0, 1)]
        count = int(seen[-1]) if len(seen) else 0
        quotes += count
        columns = [[file], [start], [count], [moved[0]], [moved[1]], [first]]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "start", "quotes", "moved0", "moved1", "first"]
        )


def _cut(told: dict[tuple[str, int], tuple[int, int, int]]):
    """``file, start, place, part, value``: objects of one split (part 0), and the pieces (1 begins an object, 2 goes on) of others.

    ``told`` has for each split but the first of a file whether it begins in a string, how deep, and how deep objects lie.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state, depth, base, place = None, 0, 0, 0, 0
        held: list[bytes] = []  # of the object that began in this split and is still open
        head = False  # inside an object that began in an earlier split

        def rows(found: list[tuple[int, int, bytes]], key) -> pa.RecordBatch:
            n = len(found)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.int64()),
                    pa.array([p for p, _, _ in found], pa.int64()), pa.array([k for _, k, _ in found], pa.int32()),
                    pa.array([v.decode() for _, _, v in found], pa.string()),
                ],
                ["file", "start", "place", "part", "value"],
            )

        for file, start, data in _runs(batches):
            if (file, start) != own:
                if held:
                    yield rows([(place, 1, b"".join(held))], own)
                own, held, place = (file, start), [], 0
                if start == 0:
                    state, depth, base = 0, 0, int(_first(data) == "[")
                else:
                    state, depth, base = told[own]
                head = depth > base
            at, step, seen = structure(data)
            count = int(seen[-1]) if len(seen) else 0
            outside = (seen + state) % 2 == 0
            after = depth + np.cumsum(np.where(outside, step, 0))
            kind = data[at]
            begins = at[outside & (kind == OPEN) & (after == base + 1)]
            ends = at[outside & (kind == CLOSE) & (after == base)] + 1
            within = head or bool(held)
            begins = np.r_[0, begins] if within else begins
            whole = min(len(begins), len(ends))
            edge = np.zeros(len(data) + 1, np.int64)
            edge[begins] += 1
            edge[ends] -= 1
            between = data[np.cumsum(edge[:-1]) == 0]
            if np.isin(between, np.frombuffer(BETWEEN, np.uint8), invert=True).any():
                raise ValueError(f"{file} holds something else than objects near byte {start + place}")
            text, found = data.tobytes(), []
            for k in range(whole):
                piece = text[begins[k] : ends[k]]
                if k == 0 and head:
                    found.append((place, 2, piece))
                    head = False
                elif k == 0 and held:
                    found.append((place, 0, b"".join([*held, piece])))
                    held = []
                else:
                    found.append((place + int(begins[k]), 0, piece))
            if whole < len(begins):
                rest = text[begins[whole] :]
                if head:
                    found.append((place, 2, rest))
                else:
                    held.append(rest)
            if found:
                yield rows(found, own)
            state, depth, place = (state + count) % 2, int(after[-1]) if len(after) else depth, place + len(data)
        if held:
            yield rows([(place, 1, b"".join(held))], own)

    return run


def read_objects(spark: SparkSession, path: str, *, encoding: str = "utf-8") -> DataFrame:
    """``file, start, place, value``: every object of the documents under ``path`` as text, with the split and place where it ends or begins.

    A document is an array of objects, or objects one after the other.  An array of anything else raises when it
    is read, a document that ends within an object or string at once.  The driver gets one row of three numbers
    for every split of a file but its first.
    """
    if encoding.lower().startswith(("utf-16", "utf16", "utf-32", "utf32")):
        # Characters of two or four bytes can't be found from any byte on: such documents are one fragment each.
        whole = spark.read.format("binaryFile").load(path)
        text = F.decode("content", encoding).alias("value")
        parts = whole.select(text, F.col("path").alias("file"), F.lit(0).cast("bigint").alias("start"))
    else:
        text = spark.read.option("encoding", encoding).option("lineSep", "}").text(path)
        parts = text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    kind = "file string, start bigint, quotes bigint, moved0 bigint, moved1 bigint, first string"
    splits = parts.mapInArrow(_both_states, kind).groupBy("file", "start").agg(
        *[F.sum(c).alias(c) for c in ("quotes", "moved0", "moved1")], F.max(F.col("first") == "[").alias("array")
    )
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    file = Window.partitionBy("file")
    state = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2
    moved = splits.withColumn("state", state).withColumn("moved", F.when(F.col("state") == 0, F.col("moved0")).otherwise(F.col("moved1")))
    begun = moved.select(
        "file", "start", "state", F.coalesce(F.sum("moved").over(earlier), F.lit(0)).alias("depth"),
        F.coalesce(F.max("array").over(file), F.lit(False)).cast("int").alias("base"),
        F.sum("quotes").over(file).alias("quotes"), F.sum("moved").over(file).alias("left"),
    )
    # The last fragment may end with the file instead of a brace, which then counts as one step too many.
    broken = (F.col("quotes") % 2 != 0) | ~F.col("left").isin(0, -1)
    wanted = begun.where((F.col("start") > 0) | broken).select("file", "start", "state", "depth", "base", broken.alias("broken"))
    told = {}
    for row in wanted.toLocalIterator():
        if row.broken:
            raise ValueError(f"{row.file} is not a whole JSON document")
        told[row.file, row.start] = (row.state, row.depth, row.base)
    cut = parts.mapInArrow(_cut(told), "file string, start bigint, place bigint, part int, value string")
    found = cut.where("part = 0").select("file", "start", "place", "value")
    if not told:
        return found
    order = Window.partitionBy("file").orderBy("start", "place")
    number = F.sum(F.when(F.col("part") == 1, 1).otherwise(0)).over(order)
    pieces = F.array_sort(F.collect_list(F.struct("start", "place", "value")))
    joined = cut.where("part > 0").withColumn("number", number).groupBy("file", "number").agg(pieces.alias("p"))
    place = F.get("p", F.lit(0))
    return found.unionByName(
        joined.select("file", place["start"].alias("start"), place["place"].alias("place"), F.array_join("p.value", "").alias("value"))
    )
