"""SentencePiece unigram encoding and decoding over whole columns.

Pieces and their log scores come from a model file of the sentencepiece library; the encoder here takes them
as a unigram model: of all ways to write a text as pieces, the one with the greatest sum of scores.
A text is escaped (blanks become the marker U+2581, one more in front) and cut before each run of markers; as no
piece reaches over such a cut, the best path of a text is that of its parts.  Distinct parts of a slice go through
Viterbi together: for each byte position a double-array trie is walked by all parts at once.
A character that no piece covers costs the least score minus ten and becomes its bytes.  On ties, the path
whose last piece begins first wins.

Decoding joins the pieces, byte pieces give their byte, markers become blanks, the one in front goes, and
bytes that are no UTF-8 become U+FFFD.

Defined results: null and empty texts have no pieces and decode to an empty text; a text that holds the marker
itself decodes to blanks there, so it does not round-trip; rows that repeat an id are encoded each; other columns are
ignored; a part of any length takes memory in proportion to it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import crc, ref, require, slices, spans
from .tokens import WordTable

MARKER = "▁"
UNKNOWN_PENALTY = 10.0
# Bytes of the parts that go through Viterbi together, padding included.
VITERBI_BYTES = 4 << 20
TEXT_BYTES = 4 << 20
_ODD = f"  |^ | $|{MARKER}"


@dataclass
class Trie:
    """A double-array trie over bytes: the child of state s by byte b is base[s]+b if check there is s."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray  # the id of the key that ends in a state, or -1
    depth: int

    @classmethod
    def of(cls, keys: dict[bytes, int]) -> Trie:
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for key, value in keys.items():
            node = 0
            for b in key:
                if b not in children[node]:
                    children[node][b] = len(children)
                    children.append({})
                    ends.append(-1)
                node = children[node][b]
            ends[node] = value
        size = 2 * len(children) + 8192
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        taken = np.zeros(size, bool)
        taken[0] = True
        state, free, waiting = {0: 0}, 1, [0]
        for node in waiting:
            own = state[node]
            value[own] = ends[node]
            labels = sorted(children[node])
            if not labels:
                continue
            while taken[free]:
                free += 1
            at = max(free - labels[0], 1)
            while len(labels) > 1 or taken[at + labels[0]]:
                window = np.arange(at, min(at + 4096, size - 256))
                fits = ~taken[window + labels[0]]
                for b in labels[1:]:
                    fits &= ~taken[window + b]
                if fits.any():
                    at += int(fits.argmax())
                    break
                at += 4096
                if at + 4096 + 256 > size:
                    grown = size
                    size *= 2
                    more = ((base, 0), (check, -1), (value, -1))
                    base, check, value = (np.append(x, np.full(grown, v, np.int32)) for x, v in more)
                    taken = np.append(taken, np.zeros(grown, bool))
            base[own] = at
            for b in labels:
                taken[at + b] = True
                check[at + b] = own
                state[children[node][b]] = at + b
                waiting.append(children[node][b])
        return cls(base, check, value, max(map(len, keys), default=0))

    def step(self, states: np.ndarray, bytes_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and which of them exist."""
        following = self.base[states] + bytes_
        return following, (self.check[following] == states) & (following != states)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of the fields of a protocol buffer message (integers and byte strings)."""

    def number(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[i] & 127) << shift
            shift, i = shift + 7, i + 1
            if data[i - 1] < 128:
                return value, i

    i = 0
    while i < len(data):
        tag, i = number(i)
        kind = tag & 7
        if kind == 0:
            value, i = number(i)
        else:
            length, i = number(i) if kind == 2 else ({1: 8, 5: 4}[kind], i)
            value, i = data[i : i + length], i + length
        yield tag >> 3, value


@dataclass
class Pieces:
    """What encoding and decoding need of a model; its size follows the vocabulary."""

    trie: Trie
    scores: np.ndarray
    byte_ids: np.ndarray  # of the 256 byte pieces
    unknown_score: float
    texts: list[bytes]  # what each id decodes to, blanks restored

    @classmethod
    def load(cls, path: str) -> Pieces:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        proto = dict(_fields(model.serialized_model_proto()))
        normal = dict(_fields(proto.get(3, b"")))
        # Fields of the normaliser: 2 character map, 3 marker in front, 4 squeezing of blanks, 5 escaping.
        if normal.get(2) or not normal.get(3, 1) or normal.get(4, 1) or not normal.get(5, 1):
            raise ValueError("Only models that keep their text, escape blanks and put one in front are supported")
        keys, texts, byte_ids = {}, [], np.full(256, -1, np.int64)
        scores = np.array([model.get_score(i) for i in range(len(model))])
        for i in range(len(model)):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                texts.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                texts.append(" ⁇ ".encode() if model.is_unknown(i) else b"")
            else:
                if re.search(f"[^{MARKER}]{MARKER}", piece):
                    raise ValueError(f"The piece {piece!r} reaches over a blank")
                keys[piece.encode()] = i
                texts.append(piece.replace(MARKER, " ").encode())
        if (byte_ids < 0).any():
            raise ValueError("The model has no byte pieces to fall back on")
        least = float(scores[list(keys.values())].min())
        return cls(Trie.of(keys), scores, byte_ids, least - UNKNOWN_PENALTY, texts)


class Unigram(WordTable):
    """Best paths of parts; a part is kept by its text without its first marker."""

    def __init__(self, pieces: Pieces, **bounds) -> None:
        super().__init__(**bounds)
        self.pieces = pieces
        lengths = np.array([len(t) for t in pieces.texts], np.int64)
        self.lengths, self.text_starts = lengths, np.cumsum(lengths) - lengths
        self.text_pool = np.frombuffer(b"".join(pieces.texts), np.uint8)

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts = [(MARKER + w).encode() for w in words.to_pylist()]
        length = np.array([len(p) for p in parts], np.int64)
        order = np.argsort(length, kind="stable")
        counts = np.zeros(len(parts), np.int64)
        a, results = 0, []
        while a < len(order):
            # Parts of similar length, so that padding stays small.
            most = max(16, int(length[order[a]] * 1.25))
            b = int(np.searchsorted(length[order], most, side="right"))
            b = min(b, a + max(1, VITERBI_BYTES // most))
            some = order[a:b]
            ids, own = self.viterbi([parts[i] for i in some], length[some])
            counts[some] = own
            results.append(ids)
            a = b
        ids = np.concatenate(results)
        # Back from length order to the order of the words.
        starts = np.empty(len(parts), np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        return ids[spans(starts, counts)], counts

    def viterbi(self, parts: list[bytes], length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p, n, width = self.pieces, len(parts), int(length.max())
        text = np.zeros((width, n), np.int32)
        data = np.frombuffer(b"".join(parts), np.uint8)
        part = np.repeat(np.arange(n), length)
        text[np.arange(len(data)) - np.repeat(np.cumsum(length) - length, length), part] = data
        best = np.full((width + 1, n), -np.inf)
        best[0] = 0
        begin, chosen = np.zeros((width + 1, n), np.int32), np.full((width + 1, n), -1, np.int32)
        char = np.where(text < 0x80, 1, np.where(text < 0xE0, 2, np.where(text < 0xF0, 3, 4)))
        for i in range(width):
            rows = np.flatnonzero((length > i) & (best[i] > -np.inf))
            if not len(rows):
                continue
            # A character that is a piece of its own needs no fallback.
            single = np.zeros(len(rows), bool)
            at, states, score = np.arange(len(rows)), np.zeros(len(rows), np.int32), best[i, rows]
            first = char[i, rows]
            for k in range(i, min(i + p.trie.depth, width)):
                states, there = p.trie.step(states, text[k, rows[at]])
                there &= length[rows[at]] > k
                at, states = at[there], states[there]
                if not len(at):
                    break
                ids = p.trie.value[states]
                ends = ids >= 0
                own, ids = at[ends], ids[ends]
                single[own[first[own] == k + 1 - i]] = True
                total = score[own] + p.scores[ids]
                better = total > best[k + 1, rows[own]]
                who = rows[own[better]]
                best[k + 1, who], begin[k + 1, who], chosen[k + 1, who] = total[better], i, ids[better]
            lacking = np.flatnonzero(~single)
            if len(lacking):
                end, who = i + first[lacking], rows[lacking]
                total = score[lacking] + p.unknown_score
                better = total > best[end, who]
                end, who = end[better], who[better]
                best[end, who], begin[end, who], chosen[end, who] = total[better], i, -1
        marked = np.full((n, width), -1, np.int64)
        at, rows = length.copy(), np.arange(n)
        while len(rows):
            start, ids = begin[at[rows], rows], chosen[at[rows], rows]
            known = ids >= 0
            marked[rows[known], start[known]] = ids[known]
            for r, a in zip(rows[~known], start[~known]):
                marked[r, a : at[r]] = p.byte_ids[text[a : at[r], r]]
            at[rows] = start
            rows = rows[start > 0]
        there = marked >= 0
        return marked[there].astype(np.uint32), there.sum(1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end and the offsets of each text."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        split = pc.split_pattern(texts, " ")
        words, until = split.flatten(), split.offsets.to_numpy().astype(np.int64)
        counts = np.diff(until)
        # An empty text has no parts; in a text with runs of blanks a part begins with the whole run.
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        if odd.any() or empty.any():
            keep = np.repeat(~odd & ~empty, counts)
            pieces = {i: [] for i in np.flatnonzero(empty)}
            for i in np.flatnonzero(odd):
                escaped = MARKER + texts[int(i)].as_py().replace(" ", MARKER)
                pieces[i] = [u[1:] for u in re.findall(f"{MARKER}+[^{MARKER}]*", escaped)]
            extra = [u for i in sorted(pieces) for u in pieces[i]]
            owner = np.concatenate(
                [np.repeat(np.arange(len(texts)), counts)[keep], np.repeat(sorted(pieces), [len(pieces[i]) for i in sorted(pieces)])]
            ).astype(np.int64)
            words = pa.concat_arrays([words.filter(pa.array(keep)), pa.array(extra, words.type)])
            order = np.argsort(owner, kind="stable")
            words, counts = words.take(pa.array(order)), np.bincount(owner, minlength=len(texts))
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        coded = words.dictionary_encode()
        places = self.places(coded.dictionary)[coded.indices.to_numpy()]
        ids = self.pool[spans(self.starts[places], self.counts[places])]
        ends = np.concatenate([[0], np.cumsum(self.counts[places])])
        return ids, ends[np.concatenate([[0], np.cumsum(counts)])]

    def decode(self, ids: np.ndarray, until: np.ndarray) -> list[str]:
        counts = self.lengths[ids]
        data = self.text_pool[spans(self.text_starts[ids], counts)].tobytes()
        ends = np.concatenate([[0], np.cumsum(counts)])[until]
        texts = [data[a:b] for a, b in zip(ends, ends[1:])]
        return [t[t.startswith(b" ") :].decode(errors="replace") for t in texts]


_loaded: dict[int, Unigram] = {}


def _encoder(pieces: Pieces) -> Unigram:
    """One per worker process; a task brings the pieces along."""
    key = hash((len(pieces.texts), pieces.scores.tobytes(), b"".join(pieces.texts)))
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Unigram(pieces)
    return _loaded[key]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and pieces: the ids of every whole text."""
    require(docs, id_col, text_col)
    pieces = Pieces.load(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(pieces)
        for batch in batches:
            for some in slices(batch, 1, TEXT_BYTES):
                ids, until = encoder.encode(some.column(1))
                lists = pa.ListArray.from_arrays(pa.array(until, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([some.column(0), lists], ["doc_id", "pieces"])

    own = docs.select(ref(id_col).cast("bigint").alias("doc_id"), ref(text_col).alias("text"))
    return own.mapInArrow(run, "doc_id bigint, pieces array<int>")


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text of rows (doc_id, pieces); null pieces decode to an empty text."""
    pieces = Pieces.load(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(pieces)
        for batch in batches:
            lists = pc.fill_null(batch.column(1), [])
            until = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())]).astype(np.int64)
            texts = encoder.decode(lists.flatten().to_numpy().astype(np.int64), until)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "pieces").mapInArrow(run, "doc_id bigint, text string")


def piece_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pieces, ids_crc32 of the ids, and whether they decode to the text, in one pass."""
    require(docs, id_col, text_col)
    pieces = Pieces.load(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(pieces)
        for batch in batches:
            for some in slices(batch, 1, TEXT_BYTES):
                ids, until = encoder.encode(some.column(1))
                back = pa.array(encoder.decode(ids, until), pa.string())
                digests = [crc(ids[a:b]) for a, b in zip(until, until[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0), pa.array(np.diff(until)), pa.array(digests, pa.int64()),
                        pc.equal(back, pc.fill_null(some.column(1), "").cast(pa.string())),
                    ],
                    ["doc_id", "n_pieces", "ids_crc32", "round_trip"],
                )

    own = docs.select(ref(id_col).cast("bigint").alias("doc_id"), ref(text_col).alias("text"))
    return own.mapInArrow(run, "doc_id bigint, n_pieces bigint, ids_crc32 bigint, round_trip boolean")
