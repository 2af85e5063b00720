"""Substring dedup by seed and extend: repeated passages of ``length`` words or more go, but for their first place.

Seeds are winnowed: of the ``seed`` consecutive words that begin anywhere in a window of ``length`` words, the one with
the least hash is the window's anchor (the first of equals).  Equal windows have equal anchors at equal places, so a
repeat can only be found where an anchor stands more than once; about one word in six is an anchor, and anchors that
occur once, most of them, go after one count.  An anchor is extended both ways to the span of all windows that chose it.

* Spans that are equal in every word form one group.  All but the first of a group are repeats as a whole: one
  minimum for each group, however many copies there are, and one join back to it.
* Groups that share an anchor but differ further out are extended step by step: every window of ``length`` words
  around the anchor, one for each reach to the left, is compared between the groups' first members only, again by one minimum
  for each window and one join back.

No pair of places is ever a row, and a passage that a third of all documents hold costs each of them one row a
seed.  All joins are on keys with a single row on one side and deal both sides anew, so hot keys split.  Repeats that overlap or touch are
merged into maximal ones.

A window is a repeat when its words also start earlier: in a document with a smaller id, or further left in the same
document.  Windows are judged on the input, not on what is left.  Words are compared by hashes of 64 bits for the
anchor and 64 for the rest.

Defined results: a null text has no words and comes back null; texts of fewer than ``length`` words stay; white space becomes
one blank between kept words; a null id comes after all others (2**63 - 1 stands for it); rows that repeat an id are documents of their own in the
order of a hash of their texts, and the same one where the texts are equal too; an empty table gives no rows; other columns
are kept, and those named n_words or n_removed are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import written
from .common import dealt_join, ref, require, slices, spans, text_bytes
from .shingles import mixed

LENGTH, SEED = 20, 8
TEXT_BYTES = 4 << 20
# Blank and the control characters from tab to carriage return.
_SPACES = np.zeros(256, bool)
_SPACES[[32, *range(9, 14)]] = True
_LAST_ID = (1 << 63) - 1
_BYTE_BASE = np.uint64(0xD1342543DE82EF95)
_WORD_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xF1357AEA2E62A9C5))
_MANY = 8  # bits of a place that hold the number of windows


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


class _Sums:
    """Hashes of ranges of a sequence: running sums weighted by powers of an odd base, taken back by its inverse."""

    def __init__(self, values: np.ndarray, base: np.uint64) -> None:
        n = len(values)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(values * _powers(base, n), dtype=np.uint64)])
        self.down = _powers(np.uint64(pow(int(base), -1, 1 << 64)), n + 1)

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mixed((self.sums[last] - self.sums[first]) * self.down[first])


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, unchanged, and the offsets of the texts in them."""
    data, offsets = text_bytes(texts)
    inside = np.concatenate([[False], ~_SPACES[data], [False]])
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    last = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    sums = _Sums(data.astype(np.uint64) + np.uint64(1), _BYTE_BASE)
    return mixed(sums.of(first, last) + (last - first).astype(np.uint64)), np.searchsorted(first, offsets)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Where the first least value of each ``width`` consecutive ones stands."""
    at = np.arange(len(values))
    reach = 1
    while reach < width:  # from windows of ``reach`` to windows of up to twice that
        step = min(reach, width - reach)
        a, b = at[: len(at) - step], at[step:]
        at = np.where(values[b] < values[a], b, a)
        reach += step
    return at


def _anchored(texts: pa.Array, length: int, seed: int):
    """Anchor hash, span hash, first window, number of windows and text of every anchor."""
    words, until = word_hashes(texts)
    if len(words) < length:
        return [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, np.int64)] * 3
    near, far = (_Sums(words, base) for base in _WORD_BASES)
    starts = np.arange(len(words) - seed + 1)
    anchor = near.of(starts, starts + seed)
    chosen = _least(anchor, length - seed + 1)
    count = np.maximum(np.diff(until) - length + 1, 0)
    start = spans(until[:-1], count)
    owner, chosen = np.repeat(np.arange(len(count)), count), chosen[start]
    new = np.ones(len(start), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(new)
    many = np.diff(np.append(head, len(start)))
    first, at = start[head], chosen[head]
    # The words of the span, how many they are, and where the anchor stands among them.
    shape = ((at - first) * 1024 + many).astype(np.uint64)
    span = mixed(far.of(first, first + many - 1 + length) ^ mixed(shape))
    return anchor[at], span, first - until[:-1][owner[head]], many, owner[head]


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _places(length: int, seed: int, whole: bool):
    """Rows (anchor, span, doc, f, place) of the anchors of each text, or the anchors alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, 2, TEXT_BYTES):
                anchor, span, first, many, owner = _anchored(some.column(2), length, seed)
                if not whole:
                    yield pa.RecordBatch.from_arrays([_long(anchor)], ["anchor"])
                    continue
                of = pa.array(owner)
                place = (first << _MANY) | many
                yield pa.RecordBatch.from_arrays(
                    [_long(anchor), _long(span), some.column(0).take(of), some.column(1).take(of), pa.array(place)],
                    ["anchor", "span", "doc", "f", "place"],
                )

    return run


def _windows(length: int, seed: int):
    """Rows (anchor, window, doc, f, start) of the windows that begin at the listed places of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, 2, TEXT_BYTES):
                words, until = word_hashes(some.column(2))
                lists = some.column(3)
                size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
                place = lists.flatten().to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(some.num_rows), size)
                many = place & ((1 << _MANY) - 1)
                start = spans((place >> _MANY) + until[owner], many)
                owner = np.repeat(owner, many)
                near, far = (_Sums(words, base) for base in _WORD_BASES)
                starts = np.arange(len(words) - seed + 1)
                anchor = near.of(starts, starts + seed)
                at = _least(anchor, length - seed + 1)[start]
                window = far.of(start, start + length)
                of = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        _long(anchor[at]), _long(window), some.column(0).take(of), some.column(1).take(of),
                        pa.array(start - until[owner]),
                    ],
                    ["anchor", "window", "doc", "f", "start"],
                )

    return run


def _later(rows: DataFrame, keys: list[str], place: str, shift: int) -> DataFrame:
    """The rows whose key has an earlier place, by document and start (``place`` without its lowest bits)."""
    start = F.shiftright(place, shift) if shift else F.col(place)
    at = F.struct("doc", "f", start.alias("start"))
    least = rows.groupBy(*keys).agg(F.min(at).alias("least"), F.max(at).alias("most"))
    several = least.where("least < most").select(*keys, "least")
    return dealt_join(rows, several, keys).where(at > F.col("least"))


def _keyed(docs: DataFrame, id_col: str, text_col: str, rest: list[str] = ()) -> DataFrame:
    """doc, f and text: documents by id and a hash of the text, as one id may stand on several rows; others as o0, o1, ..."""
    doc = F.coalesce(ref(id_col).cast("bigint"), F.lit(_LAST_ID))
    others = [ref(c).alias(f"o{k}") for k, c in enumerate(rest)]
    return docs.select(doc.alias("doc"), F.xxhash64(ref(text_col)).alias("f"), ref(text_col).alias("text"), *others)


def _repeats(docs: DataFrame, keyed: DataFrame, length: int, seed: int) -> DataFrame:
    """doc, f and place of spans and windows that are repeats."""
    if not 0 < seed <= length or length - seed + 1 >= 1 << _MANY:
        raise ValueError("The seed must be shorter than the length, by less than 255 words")
    anchors = keyed.mapInArrow(_places(length, seed, False), "anchor bigint")
    several = anchors.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    rows = keyed.mapInArrow(
        _places(length, seed, True), "anchor bigint, span bigint, doc bigint, f bigint, place bigint"
    )
    seeded = written(dealt_join(rows, several, ["anchor"]))
    whole = _later(seeded, ["anchor", "span"], "place", _MANY).select("doc", "f", "place")
    # One member of each group of equal spans, for anchors that have several groups.
    first = seeded.groupBy("anchor", "span").agg(F.min(F.struct("doc", "f", "place")).alias("m"))
    groups = written(first.select("anchor", "m.*"))
    split = groups.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    lists = dealt_join(groups, split, ["anchor"]).groupBy("doc", "f").agg(F.collect_list("place").alias("places"))
    held = keyed.join(lists, ["doc", "f"]).select("doc", "f", "text", "places")
    windows = held.mapInArrow(
        _windows(length, seed), "anchor bigint, window bigint, doc bigint, f bigint, start bigint"
    )
    parts = _later(windows, ["anchor", "window"], "start", 0)
    single = F.shiftleft("start", _MANY).bitwiseOR(F.lit(1).cast("bigint"))
    return whole.unionByName(parts.select("doc", "f", single.alias("place")))


def _merged(places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of the maximal repeats that the places make up."""
    places = np.sort(places)
    first = places >> _MANY
    end = np.maximum.accumulate(first + (places & ((1 << _MANY) - 1)) - 1 + length)
    new = np.ones(len(first), bool)
    new[1:] = first[1:] > end[:-1]
    head = np.flatnonzero(new)
    return first[head], end[np.append(head[1:], len(first)) - 1] if len(first) else end


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, seed: int = SEED
) -> DataFrame:
    """The maximal repeats of each document: id, f (a hash of its text), first word and number of words."""
    require(docs, id_col, text_col)
    found = _repeats(docs, _keyed(docs, id_col, text_col), length, seed)
    lists = found.groupBy("doc", "f").agg(F.collect_list("place").alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                first, end = _merged(np.array(batch.column(2)[k].as_py(), np.int64), length)
                own = pa.array(np.full(len(first), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(own), batch.column(1).take(own), pa.array(first), pa.array(end - first)],
                    ["doc", "f", "first", "n"],
                )

    spread = lists.mapInArrow(run, "doc bigint, f bigint, first bigint, n bigint")
    return spread.select(F.nullif(F.col("doc"), F.lit(_LAST_ID)).alias("doc_id"), "f", "first", "n")


def _removed(length: int):
    """The text without its repeats, the number of words before and how many went."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, 0, TEXT_BYTES):
                out: list[list] = [[], [], []]
                for text, places in zip(some.column(0).to_pylist(), some.column(1)):
                    words = [] if text is None else text.encode().split()
                    n, kept = len(words), words
                    if places.is_valid:
                        kept, at = [], 0
                        for first, end in zip(*_merged(places.values.to_numpy(), length)):
                            kept += words[at:first]
                            at = end
                        kept += words[at:]
                    out[0].append(None if text is None else b" ".join(kept).decode())
                    out[1].append(n)
                    out[2].append(n - len(kept))
                rest = some.drop_columns(some.schema.names[:2]).columns
                made = [pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())]
                yield pa.RecordBatch.from_arrays([*made, *rest], [f"c{k}" for k in range(3 + len(rest))])

    return run


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, seed: int = SEED
) -> DataFrame:
    """The documents with each repeat gone from the text, and n_words and n_removed beside it."""
    require(docs, id_col, text_col)
    keyed = _keyed(docs, id_col, text_col)
    found = _repeats(docs, keyed, length, seed)
    lists = found.groupBy("doc", "f").agg(F.collect_list("place").alias("places"))
    rest = [c for c in docs.columns if c not in (id_col, text_col, "n_words", "n_removed")]
    own = _keyed(docs, id_col, text_col, rest)  # without other columns the texts are shuffled once for both joins
    others = [f"o{k}" for k in range(len(rest))]
    joined = own.join(lists, ["doc", "f"], "left").select("text", "places", "doc", *others)
    kinds = ["string", "bigint", "bigint", "bigint", *[docs.schema[c].dataType.simpleString() for c in rest]]
    made = joined.mapInArrow(_removed(length), ", ".join(f"c{k} {kind}" for k, kind in enumerate(kinds)))
    own_id = F.nullif(F.col("c3"), F.lit(_LAST_ID)).cast(docs.schema[id_col].dataType)
    columns = {id_col: own_id, text_col: F.col("c0"), **{c: F.col(f"c{k + 4}") for k, c in enumerate(rest)}}
    kept = [columns[c].alias(c) for c in docs.columns if c in columns]
    return made.select(*kept, F.col("c1").alias("n_words"), F.col("c2").alias("n_removed"))


def kept_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and the sha256 of what is left of each text."""
    left = remove_repeats(docs.select(ref(id_col).alias("doc_id"), ref(text_col).alias("text")))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return left.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))
