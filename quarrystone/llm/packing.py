"""Packing documents into sequences by patterns of piece lengths.

Only the histogram of piece lengths (at most one number for each length up to the capacity)
reaches the driver.  There, patterns of two to four lengths that fill a sequence are enumerated, a
non-negative least-squares fit finds how often each should be used to spend the histogram,
the counts are rounded down, and what is left is packed best fit, many equal sequences at a
time.  The plan says for each length which of its pieces (by rank) go to which sequences at which
offset; tasks look their pieces up in it.  The plan's size depends on the capacity alone.

Defined results: a null or empty text is one piece that holds the end id; an empty table gives
no rows; rows that repeat a document id are packed each on their own; other columns are
ignored.  Texts of any length are streamed in slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.scratch import written
from .common import crc, give_back, ref, require, slices, spans
from .tokens import encoder

CAPACITY = 1024
# Patterns of three and four lengths: so many second and third lengths are tried for each longest one.
SECOND_LENGTHS, THIRD_LENGTHS = 24, 4
# Sequences a pattern may leave unfilled by so many tokens.
WASTE = 2
FIT_STEPS = 400
# Pattern sizes that are fitted one after the other; of these plans the one with the fewest sequences is taken.
FITS = (((2, 3, 4),), ((2,), (2, 3, 4)))

PIECES = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, place bigint"
)


def patterns(histogram: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of four lengths, descending, zero for none, that fill a sequence up to a little waste.

    The lengths are such that occur.  All fitting pairs are listed; of the triples and quadruples
    those with second and third lengths spread evenly over what fits.  Lengths below a quarter of the
    capacity only come after a longer one: if there are no others, best fit does all the work.
    """
    there = np.flatnonzero(histogram)
    out = []
    for waste in range(WASTE + 1):
        first = there[there * 2 >= capacity - waste]
        second = capacity - waste - first
        keep = (second > 0) & (histogram[np.maximum(second, 0)] > 0)
        out.append(np.stack([first, second, 0 * first, 0 * first], 1)[keep])
    for a in there[(there * 3 >= capacity) & (there < capacity)]:
        room = capacity - a
        for b in np.unique(np.linspace(max(1, room // 2), min(a, room), SECOND_LENGTHS).astype(int)):
            c = room - b
            if 0 < c <= b and histogram[b] and histogram[c]:
                out.append(np.array([[a, b, c, 0]]))
            for third in np.unique(np.linspace(max(1, c // 2), min(b, c), THIRD_LENGTHS).astype(int)):
                d = c - third
                if 0 < d <= third and histogram[b] and histogram[third] and histogram[d]:
                    out.append(np.array([[a, b, third, d]]))
    for a in there[(there * 4 >= capacity) & (there * 3 < capacity)]:  # four of them at least
        room = capacity - a
        for b in np.unique(np.linspace(-(-room // 3), a, SECOND_LENGTHS).astype(int)):
            rest = room - b
            for third in np.unique(np.linspace(-(-rest // 2), min(b, rest), SECOND_LENGTHS).astype(int)):
                d = rest - third
                if 0 < d <= third <= b and histogram[b] and histogram[third] and histogram[d]:
                    out.append(np.array([[a, b, third, d]]))
    return np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 4), int)


def fit(chosen: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """How often each pattern is used: least squares against the histogram, never negative.

    Accelerated projected gradient steps; a column of the matrix has four entries at most, so a
    step is two passes over the patterns.
    """
    if not len(chosen):
        return np.zeros(0)
    size, real = len(histogram), chosen > 0
    goal = histogram.astype(float)

    def spent(x: np.ndarray) -> np.ndarray:
        return np.bincount(chosen[real], (x[:, None] * real)[real], size)

    # The largest eigenvalue of A'A, by a few power steps, bounds the step.
    v = np.ones(len(chosen))
    for _ in range(20):
        v = (spent(v)[chosen] * real).sum(1)
        bound = np.linalg.norm(v)
        v /= bound
    x = y = np.zeros(len(chosen))
    momentum = 1.0
    for _ in range(FIT_STEPS):
        slope = ((spent(y) - goal)[chosen] * real).sum(1)
        new = np.maximum(y - slope / (1.05 * bound), 0)
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        y, x, momentum = new + (momentum - 1) / following * (new - x), new, following
    return x


def _use(pattern: list[int], left: np.ndarray) -> int:
    """How often a pattern can be taken from what is left."""
    lengths, times = np.unique(pattern, return_counts=True)
    return int((left[lengths] // times).min())


def rounded(chosen: np.ndarray, x: np.ndarray, left: np.ndarray) -> list[tuple[list[int], int]]:
    """Patterns with whole counts, largest first, never more than is there; ``left`` is reduced."""
    out = []
    for k in np.argsort(-x, kind="stable"):
        if x[k] < 1:
            break
        pattern = [int(n) for n in chosen[k] if n]
        count = min(int(x[k]), _use(pattern, left))
        if count:
            np.subtract.at(left, pattern, count)
            out.append((pattern, count))
    return out


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """The rest: the longest piece, then always the longest that still fits, repeated while it lasts.

    Each step uses up one length at least, so there are as many steps as lengths.
    """
    out = []
    while left.any():
        pattern, room, own = [], capacity, left.copy()
        while room > 0 and own[1 : room + 1].any():
            n = int(np.flatnonzero(own[: room + 1])[-1])
            # As many of this length as fit at once.
            times = min(room // n, int(own[n]))
            pattern += [n] * times
            own[n] -= times
            room -= n * times
        count = _use(pattern, left)
        np.subtract.at(left, pattern, count)
        out.append((pattern, count))
    return out


@dataclass
class Plan:
    """By length and rank: runs of pieces that go to consecutive sequences at one offset."""

    first_run: np.ndarray  # of each length, and one past the last
    first_rank: np.ndarray  # of each run; a run goes up to the next run of its length
    first_sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def look_up(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # Runs are in order of length and rank, so one search finds the run of each piece.
        width = int(self.first_rank.max(initial=0) + rank.max(initial=0)) + 1
        lengths = np.repeat(np.arange(len(self.first_run) - 1), np.diff(self.first_run))
        run = np.searchsorted(lengths * width + self.first_rank, length * width + rank, side="right") - 1
        return self.first_sequence[run] + rank - self.first_rank[run], self.offset[run]


def _packed(histogram: np.ndarray, capacity: int, fits: tuple[tuple[int, ...], ...]) -> list[tuple[list[int], int]]:
    left, out = histogram.astype(np.int64).copy(), []
    for sizes in fits:
        chosen = patterns(left, capacity)
        chosen = chosen[np.isin((chosen > 0).sum(1), sizes)]
        out += rounded(chosen, fit(chosen, left), left)
    return out + best_fit(left, capacity)


def plan(histogram: np.ndarray, capacity: int) -> Plan:
    """``histogram[n]`` pieces have length n, for n below the capacity."""
    packed = min((_packed(histogram, capacity, f) for f in FITS), key=lambda p: sum(count for _, count in p))
    taken = np.zeros(len(histogram), np.int64)
    runs, sequence = [], 0
    for pattern, count in packed:
        offset = 0
        for n in pattern:
            runs.append((n, int(taken[n]), sequence, offset))
            taken[n] += count
            offset += n
        sequence += count
    runs.sort()
    columns = np.array(runs, np.int64).reshape(-1, 4).T
    first_run = np.searchsorted(columns[0], np.arange(len(histogram) + 1))
    return Plan(first_run, columns[1], columns[2], columns[3], sequence)


def _cut(path: str, end_id: int, capacity: int):
    """Pieces of each document; ``place`` numbers the pieces of one length within the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for some in slices(batch, 1):
                ids, until = encoder(path).encode(some.column(1))
                total = np.diff(until) + 1
                count = -(-total // capacity)
                doc = np.repeat(np.arange(len(total)), count)
                piece = spans(np.zeros(len(total), np.int64), count)
                # The first piece is the one that may be shorter.
                head = total - (count - 1) * capacity
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[doc], capacity)
                digests = []
                for d in range(len(total)):
                    own = np.append(ids[until[d] : until[d + 1]], end_id)
                    edges = [0, *range(int(head[d]), len(own) + 1, capacity)]
                    digests += [crc(own[a:b]) for a, b in zip(edges, edges[1:])]
                order = np.argsort(length, kind="stable")
                _, first, times = np.unique(length[order], return_index=True, return_counts=True)
                place = np.empty(len(length), np.int64)
                place[order] = np.arange(len(length)) - np.repeat(first, times) + seen[length[order]]
                seen += np.bincount(length, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start),
                        pa.array(length), pa.array(digests, pa.int64()),
                        pa.array(np.full(len(doc), part), pa.int32()), pa.array(place),
                    ],
                    [c.split()[0] for c in PIECES.split(", ")],
                )
        give_back()

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces with their sequence and offset; sequences are gapless from offset 0.

    Full pieces have a sequence each, with a negative number made from task and place.  The others
    are ranked within their length by task and place: the counts by task and length are summed
    up over the tasks, so no length, however common, meets in one task.
    """
    require(docs, id_col, text_col)
    own = docs.select(ref(id_col).cast("bigint").alias("doc_id"), ref(text_col).alias("text"))
    pieces = written(own.mapInArrow(_cut(tokenizer_path, end_id, capacity), PIECES))
    whole = pieces.where(F.col("length") == capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (-1 - F.shiftleft(F.col("part").cast("bigint"), 40) - F.col("place")).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    short = pieces.where(F.col("length") < capacity)
    counts = written(short.groupBy("part", "length").agg(F.count("*").alias("n")))
    histogram = np.zeros(capacity, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[r.length] = r.n
    packing = plan(histogram, capacity)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = short.join(before, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place")).alias("rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = packing.look_up(batch.column(3).to_numpy(), batch.column(5).to_numpy())
            columns = [*batch.columns[:5], pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:5], "sequence_id", "offset"])

    packed = ranked.mapInArrow(
        place,
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    )
    return packed.unionByName(whole)
