"""Similarity self-join of documents on sets of five-word shingles by chosen paths.

Documents with the same set become one representative first.  Each set is embedded as ``POSITIONS``
sampled tokens (the token that is least under one random function per position; two sets sample the same
token with the probability of their Jaccard similarity).  A run starts with all sets in one bucket and splits
recursively: the path to a bucket chooses one or two positions, 1/threshold on average, and the sets
go to one child bucket for each of them and its token.  Buckets of up to ``SMALL`` sets are compared
by brute force on their samples, larger ones are split again.  All runs draw from the same samples, so a pair
at the threshold whose samples happen to agree less is weak in every run.  Runs are therefore repeated until what
they miss, averaged over the agreements that may come, is below 1 - recall at the deepest level.

What may be similar is then joined into groups, and every pair inside a group is decided exactly
on the full sets, in cells: a large group is cut into blocks by a hash, and each pair of blocks is one cell, so no
task holds more than two blocks and no pair is ever a row.  A cell emits a count and one link per
document.  Buckets that no path can split (many sets that are all much alike) become such a group as they are.

Result: one row for each document id: ``class_id``, the smallest id reachable by links of similarity >= threshold;
``n_links``, the other documents linked directly, copies included; ``rep_id``, the smallest id with the same set; ``kept``.

Defined results: texts that are null or hold no word link with nothing; texts of fewer than five words are one
shingle; rows with a null id have no result; an id that is there several times counts once, with
the least of its sets by fingerprint; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import written
from .common import group_starts, ref, require, roots, slices, whole_groups
from .components import components
from .shingles import mixed, shingle_sets

THRESHOLD, RECALL = 0.8, 0.999
POSITIONS = 64
# Largest bucket that is compared by brute force, and levels after which a bucket counts as one group.
SMALL, MAX_DEPTH = 96, 4
# A pair whose samples agree on fewer positions than this share has next to no chance (5 standard deviations).
SAMPLE_SHARE = 0.55
# Drawn agreements that the miss is averaged over, so many at a time, and the most runs that are considered.
AGREEMENTS, DRAWN_ROWS, MAX_RUNS = 20_000, 500, 64
# A block of a group holds about so many documents or shingles.
BLOCK_DOCS, BLOCK_SHINGLES = 256, 1 << 20
TEXT_BYTES = 1 << 20

_rng = np.random.default_rng(17)
_FACTOR = (_rng.integers(0, 1 << 31, POSITIONS, dtype=np.int64) * 2 + 1).astype(np.uint32)
_SHIFT = _rng.integers(0, 1 << 32, POSITIONS, dtype=np.int64).astype(np.uint32)


def missed(depth: int, threshold: float, most: int) -> np.ndarray:
    """The chance that a pair at the threshold shares no bucket after so many levels, by 1 to ``most`` runs.

    Averaged over drawn agreements of the samples.  The first positions of each run are known; those of
    deeper levels depend on the tokens, so a pair meets them with its own share of agreement.
    """
    draw, total = np.random.default_rng(23), np.zeros(most)
    first, second, both = _positions(np.arange(most, dtype=np.uint64))
    for _ in range(AGREEMENTS // DRAWN_ROWS):
        agree = draw.random((DRAWN_ROWS, POSITIONS)) < threshold
        share, s = agree.mean(1), 1.0
        for _ in range(depth - 1):
            s = 1 - (1 - share * s) * (1 - (1 / THRESHOLD - 1) * share * s)
        s = np.reshape(s, (-1, 1))
        lost = np.cumprod((1 - agree[:, first] * s) * (1 - both * agree[:, second] * s), axis=1)
        lost[agree.sum(1) < math.ceil(SAMPLE_SHARE * POSITIONS)] = 1  # met, but not taken for alike
        total += lost.sum(0)
    return total / AGREEMENTS


@lru_cache
def runs_needed(depth: int, threshold: float, recall: float) -> int:
    enough = np.flatnonzero(missed(depth, threshold, MAX_RUNS) <= 1 - recall)
    if not len(enough):
        raise ValueError(f"The samples do not allow a recall of {recall}")
    return int(enough[0]) + 1


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for some in slices(batch, 1, TEXT_BYTES):
            values, until = shingle_sets(some.column(1))
            n, size = some.num_rows, np.diff(until)
            there = np.flatnonzero(size)
            starts = until[there]
            sums = np.zeros((2, n), np.uint64)
            samples = np.zeros((n, POSITIONS), np.uint32)
            if len(there):
                for k in range(2):
                    sums[k, there] = np.add.reduceat(mixed(values + np.uint64(k + 1)), starts)
                short = (values >> np.uint64(32)).astype(np.uint32)
                for k in range(POSITIONS):
                    samples[there, k] = np.minimum.reduceat(short * _FACTOR[k] + _SHIFT[k], starts)
            yield pa.RecordBatch.from_arrays(
                [
                    some.column(0), pa.array(size.astype(np.int64)), *[pa.array(s.view(np.int64)) for s in sums],
                    pa.array([r.tobytes() for r in samples], pa.binary()),
                ],
                ["id", "size", "f1", "f2", "sample"],
            )


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Samples as rows of numbers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    data = np.frombuffer(column.buffers()[2] or b"", np.uint32)
    first = np.frombuffer(column.buffers()[1], np.int32)[column.offset] // 4
    return data[first : first + len(column) * POSITIONS].reshape(-1, POSITIONS)


def _start(runs: range):
    """Level one: the bucket of each set in each run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            samples = _matrix(batch.column(1))
            for r in runs:
                yield from _children(np.full(len(samples), r, np.uint64), samples, batch.column(0))

    return run


def _positions(path: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first and the second position that each path chooses, and whether it takes the second too."""
    draw = mixed(path + np.uint64(0xA0761D6478BD642F))
    first = (draw % np.uint64(POSITIONS)).astype(np.int64)
    step = ((draw >> np.uint64(16)) % np.uint64(POSITIONS - 1)).astype(np.int64) + 1
    both = (draw >> np.uint64(40)).astype(float) / (1 << 24) < 1 / THRESHOLD - 1
    return first, (first + step) % POSITIONS, both


def _children(path: np.ndarray, samples: np.ndarray, ids: pa.Array) -> Iterator[pa.RecordBatch]:
    """One child bucket for a position of each path, and for some paths a second."""
    first, second, both = _positions(path)
    for position, some in ((first, slice(None)), (second, both)):
        row = np.arange(len(path))[some]
        token = samples[row, position[some]].astype(np.uint64)
        child = mixed(mixed(path[some] + np.uint64(1)) ^ mixed(token + (position[some].astype(np.uint64) << np.uint64(32))))
        yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), ids.take(pa.array(row))], ["bucket", "id"])


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        path = batch.column(0).to_numpy().view(np.uint64)
        yield from _children(path, _matrix(batch.column(2)), batch.column(1))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Brute force inside small buckets on the samples; one link per set to the first of those alike."""
    least = math.ceil(SAMPLE_SHARE * POSITIONS)
    for rows in whole_groups(batches, 0):
        bucket, ids, samples = rows.column(0).to_numpy(), rows.column(1).to_numpy(), _matrix(rows.column(2))
        n, left, right = len(ids), [], []
        for apart in range(1, n):
            a = np.flatnonzero(bucket[apart:] == bucket[: n - apart])
            if not len(a):
                break
            alike = a[(samples[a] == samples[a + apart]).sum(1) >= least]
            left.append(alike)
            right.append(alike + apart)
        if left:
            root = roots(n, np.concatenate(left), np.concatenate(right))
            linked = np.flatnonzero(root != np.arange(n))
            yield pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(ids[root[linked]])], ["a", "b"])


def _candidates(reps: DataFrame, runs: range) -> DataFrame:
    """Links between sets that may be similar; each level's are written, so no plan spans two levels."""
    samples = reps.select("id", "sample")
    rows = samples.mapInArrow(_start(runs), "bucket bigint, id bigint")
    links = []
    for level in range(1, MAX_DEPTH + 1):
        rows = written(rows)
        sizes = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("least")).where("n > 1")
        sized = written(rows.join(sizes, "bucket"))
        small = sized.where(F.col("n") <= SMALL).select("bucket", "id").join(samples, "id")
        ordered = small.select("bucket", "id", "sample").repartition("bucket").sortWithinPartitions("bucket")
        links.append(written(ordered.mapInArrow(_compare, "a bigint, b bigint")))
        large = sized.where(F.col("n") > SMALL)
        if large.isEmpty():
            break
        if level == MAX_DEPTH:
            links.append(large.select(F.col("id").alias("a"), F.col("least").alias("b")))
        else:
            chosen = large.select("bucket", "id").join(samples, "id").select("bucket", "id", "sample")
            rows = chosen.mapInArrow(_split, "bucket bigint, id bigint")
    return reduce(DataFrame.union, links)


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for some in slices(batch, 1, TEXT_BYTES):
            values, until = shingle_sets(some.column(1))
            sets = [values[a:b].tobytes() for a, b in zip(until, until[1:])]
            starts = until[:-1][np.diff(until) > 0]
            own = np.zeros(some.num_rows, np.uint64)
            if len(starts):
                own[np.diff(until) > 0] = np.add.reduceat(mixed(values + np.uint64(1)), starts)
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array(own.view(np.int64)), pa.array(sets, pa.binary())], ["id", "f1", "set"]
            )


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two of the sets share, by products of 0/1 matrices over slices of the tokens."""
    n = len(sets)
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(tokens, kind="stable")
    starts = group_starts(tokens[order])
    times = np.diff(starts)
    owner, token = owner[order], np.repeat(np.arange(len(times)), times)
    several = np.repeat(times > 1, times)  # what one set alone holds is not shared
    owner, token = owner[several], token[several]
    token = np.cumsum(np.diff(token, prepend=token[:1]) != 0) if len(token) else token
    shared = np.zeros((n, n), np.float32)
    width = max(256, (4 << 20) // n)
    edges = np.searchsorted(token, np.arange(0, (int(token[-1]) if len(token) else -1) + 1, width))
    for a, b in zip(edges, [*edges[1:], len(token)]):
        part = np.zeros((n, width), np.float32)
        part[owner[a:b], token[a:b] - token[a]] = 1
        shared += part @ part.T
    return shared


def _verify(threshold: float):
    """Exact links inside each cell: how many documents each one links with, and one link towards its group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, 0):
            cell, side, ids, copies = (rows.column(k).to_numpy() for k in range(4))
            sets = [np.frombuffer(s, np.uint64) for s in rows.column(4).to_pylist()]
            bounds = group_starts(cell)
            out: list[list[np.ndarray]] = [[], [], []]
            for a, b in zip(bounds, bounds[1:]):
                if b - a < 2:
                    continue
                size = np.array([len(s) for s in sets[a:b]], np.float32)
                shared = _shared(sets[a:b])
                linked = shared >= threshold * (size[:, None] + size - shared) - 1e-3
                np.fill_diagonal(linked, False)
                across = side[a:b] != 0
                if across.any():  # pairs inside a block are decided in its own cell
                    linked &= across[:, None] != across
                low, high = np.nonzero(np.triu(linked))
                some = np.flatnonzero(linked.any(1))
                out[0].append(ids[a:b][some])
                out[1].append(ids[a:b][roots(b - a, low, high)[some]])
                out[2].append((linked @ copies[a:b])[some])
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c).astype(np.int64)) for c in out], ["id", "root", "links"]
                )

    return run


def _cells(groups: DataFrame, reps: DataFrame) -> DataFrame:
    """Which cells each document goes to: its block against every block of its group."""
    members = groups.join(reps.select("id", "size", "copies"), "id")
    totals = members.groupBy("component").agg(F.count("*").alias("n"), F.sum("size").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_DOCS), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    cut = members.join(totals.select("component", blocks.alias("blocks")), "component")
    own = cut.withColumn("own", F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks")))
    pairs = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    return pairs.select(
        F.xxhash64("component", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "id",
        "copies",
    )


def similar_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> DataFrame:
    """doc_id, class_id, n_links, rep_id, kept; see the module's text."""
    require(docs, id_col, text_col)
    if not THRESHOLD <= threshold <= 1:
        raise ValueError(f"The threshold must lie between {THRESHOLD} and 1")
    texts = docs.select(ref(id_col).cast("bigint").alias("id"), ref(text_col).alias("text")).where("id is not null")
    sketches = texts.mapInArrow(_sketch, "id bigint, size bigint, f1 bigint, f2 bigint, sample binary")
    least = F.min(F.struct("f1", "f2", "size", "sample")).alias("s")
    known = written(sketches.groupBy("id").agg(least).select("id", "s.*"))
    same = ["f1", "f2", "size"]
    full = known.where("size > 0")
    classes = written(full.groupBy(*same).agg(F.min("id").alias("rep_id"), F.count("*").alias("copies")))
    reps = written(
        full.join(classes.select(F.col("rep_id").alias("id"), "copies"), "id").select(
            "id", "size", "f1", "sample", "copies"
        )
    )
    candidates = _candidates(reps, range(runs_needed(MAX_DEPTH, threshold, recall)))
    groups = written(components(candidates).withColumnRenamed("node", "id"))
    wanted = groups.join(reps.select("id", "f1"), "id").select("id", "f1")
    mine = texts.join(wanted.select("id"), "id", "left_semi").mapInArrow(_with_sets, "id bigint, f1 bigint, set binary")
    sets = mine.join(wanted, ["id", "f1"], "left_semi").dropDuplicates(["id"])
    cells = _cells(groups, reps).join(sets.select("id", "set"), "id").select("cell", "side", "id", "copies", "set")
    ordered = cells.repartition("cell").sortWithinPartitions("cell", "side")
    decided = written(ordered.mapInArrow(_verify(threshold), "id bigint, root bigint, links bigint"))
    linked = decided.groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(decided.select(F.col("id").alias("a"), F.col("root").alias("b")))
    found = joined.withColumnRenamed("node", "id").join(linked, "id", "left")
    by_class = classes.join(found, classes.rep_id == found.id, "left").select(
        *same, "rep_id", F.coalesce("component", "rep_id").alias("class_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    result = known.select("id", *same).join(by_class, same, "left")
    own = F.coalesce("class_id", "id")
    return result.select(
        F.col("id").alias("doc_id"), own.alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("rep_id", "id").alias("rep_id"), (F.col("id") == own).alias("kept"),
    )
