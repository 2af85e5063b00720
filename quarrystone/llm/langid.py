"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its subwords: windows of two to four bytes of the lower-cased
text that do not reach over a word boundary, a boundary itself included, hashed into a
fixed number of buckets.  Training is stochastic gradient descent in numpy on a bounded sample
of labelled documents; each also trains as a few of its subwords, so that short texts
are known too.  Confidence is calibrated by one temperature on documents kept back, and a document is
rejected when its confidence lies below what all but ``REJECT_SHARE`` of the documents kept back and
rightly predicted reach (never above ``REJECT_BELOW``).

As the model is linear after the average, embeddings and softmax weights multiply out to one
row of scores per bucket, and a prediction is a sum of rows over the text: tasks gather and add them
over byte positions, in chunks, so a text of any length takes bounded memory.

Defined results: a null text or one without a letter is ``und`` with score 0 and rejected; with no
labelled documents at all every prediction is ``und``; rows that repeat an id are predicted each; other
columns are ignored; equal scores go to the language first in alphabetical order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, id_remainder, ref, require, slices, text_bytes

BUCKET_BITS = 13
BUCKETS = 1 << BUCKET_BITS
WINDOWS = (2, 3, 4)
DIMENSIONS = 16
# Labelled documents that are trained on: the bound of the sample.
TRAIN_DOCS = 3_000
CALIBRATION_SHARE = 0.25
EPOCHS, BATCH, RATE = 12, 16, 2.0
# Subwords of a training document that stand for a short text.
THIN = (4, 60)
REJECT_SHARE, REJECT_BELOW = 0.001, 0.5
CHUNK = 1 << 19
UNDETERMINED = "und"

# Bytes that separate words: everything in ASCII but letters.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32


def subwords(data: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    """For each window size the bucket of the window at each place; BUCKETS where there is none.

    ``ends`` holds for each place where its text ends.
    """
    folded = np.append(_FOLD[data], np.full(max(WINDOWS), 32, np.uint8))
    space = folded == 32
    places = np.arange(len(data))
    for n in WINDOWS:
        mixed = np.full(len(data), 2166136261 + n, np.uint32)
        whole = places + n <= ends
        for k in range(n):
            mixed = (mixed ^ folded[k : k + len(data)]) * np.uint32(16777619)
            if 0 < k < n - 1:
                whole &= ~space[k : k + len(data)]
        if n == 2:
            whole &= ~(space[: len(data)] & space[1 : 1 + len(data)])
        mixed ^= mixed >> 15
        mixed *= np.uint32(2246822519)
        yield np.where(whole, mixed >> (32 - BUCKET_BITS), BUCKETS)


def _chunks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Bytes in pieces with overlap: (bytes, ends of texts by place, text of each place, own places)."""
    reach = max(WINDOWS) - 1
    for a in range(0, len(data), CHUNK):
        b = min(a + CHUNK, len(data))
        # A window may look a little beyond its piece.
        text = np.searchsorted(offsets, np.arange(a, min(b + reach, len(data))), side="right") - 1
        yield data[a : b + reach], offsets[text + 1] - a, text, b - a


def bucket_counts(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and how often each occurs, text by text."""
    data, offsets = text_bytes(pc.utf8_lower(texts))
    counts = np.zeros((len(texts), BUCKETS + 1), np.int64)
    for piece, ends, text, own in _chunks(data, offsets):
        for found in subwords(piece, ends):
            flat = text[:own] * (BUCKETS + 1) + found[:own]
            counts += np.bincount(flat, minlength=counts.size).reshape(counts.shape)
    for row in counts[:, :BUCKETS]:
        there = np.flatnonzero(row)
        yield there, row[there]


def score_sums(texts: pa.Array, rows: np.ndarray) -> np.ndarray:
    """For each text the sum of its subwords' rows; ``rows`` has a last row of zeros."""
    data, offsets = text_bytes(pc.utf8_lower(texts))
    out = np.zeros((len(texts), rows.shape[1]))
    for piece, ends, text, own in _chunks(data, offsets):
        texts_here, first = np.unique(text[:own], return_index=True)
        for found in subwords(piece, ends):
            out[texts_here] += np.add.reduceat(rows[found[:own]], first, axis=0)
    return out


@dataclass
class Model:
    languages: list[str]
    rows: np.ndarray  # by bucket: the score of each language and a one; a last row of zeros
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, sums: np.ndarray) -> np.ndarray:
        logits = (sums[:, :-1] / np.maximum(sums[:, -1:], 1) + self.bias) / self.temperature
        return softmax(logits)


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(1, keepdims=True))
    return raised / raised.sum(1, keepdims=True)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for some in slices(batch, 1, CHUNK):
            for first in range(0, some.num_rows, 64):
                few = some.slice(first, 64)
                found = list(bucket_counts(few.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [
                        few.column(0), few.column(2),
                        pa.array([b.astype("<u2").tobytes() for b, _ in found], pa.binary()),
                        pa.array([c.astype("<u4").tobytes() for _, c in found], pa.binary()),
                    ],
                    ["id", "lang", "buckets", "counts"],
                )


def _sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> list:
    """Features of about TRAIN_DOCS labelled documents: at most 48 KB each, however long the text."""
    learn = docs.where((id_remainder(id_col, 4) != 2) & ref(lang_col).isNotNull()).select(
        ref(id_col).cast("string").alias("id"), ref(text_col).alias("text"), ref(lang_col).alias("lang")
    )
    chosen = hash_sample(learn, "id", TRAIN_DOCS, learn.select("id").count())
    rows = chosen.mapInArrow(_features, "id string, lang string, buckets binary, counts binary").collect()
    return sorted((r for r in rows if r.buckets), key=lambda r: (r.id, r.lang, r.buckets))


def train(rows: list, seed: int = 7) -> Model | None:
    """Gradient descent over the sample; None if there is nothing to learn from."""
    languages = sorted({r.lang for r in rows})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    bags = [(np.frombuffer(r.buckets, "<u2").astype(np.int64), np.frombuffer(r.counts, "<u4") * 1.0) for r in rows]
    goal = np.array([languages.index(r.lang) for r in rows])
    kept_back = rng.random(len(rows)) < CALIBRATION_SHARE
    kept_back[[int(np.flatnonzero(goal == k)[0]) for k in range(len(languages))]] = False

    def thinned(bag: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        buckets, counts = bag
        return rng.choice(buckets, int(rng.integers(*THIN)), p=counts / counts.sum()), None

    def batch(bags: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        buckets = np.concatenate([b for b, _ in bags])
        shares = np.concatenate([np.full(len(b), 1 / len(b)) if c is None else c / c.sum() for b, c in bags])
        return buckets, shares, np.cumsum([0, *[len(b) for b, _ in bags[:-1]]])

    embeddings = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    weights, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    own = np.flatnonzero(~kept_back)
    steps, step = EPOCHS * -(-2 * len(own) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(np.concatenate([own, own + len(bags)]))
        for a in range(0, len(order), BATCH):
            some = order[a : a + BATCH]
            texts = [thinned(bags[i - len(bags)]) if i >= len(bags) else bags[i] for i in some]
            buckets, shares, first = batch(texts)
            average = np.add.reduceat(embeddings[buckets] * shares[:, None], first, axis=0)
            error = softmax(average @ weights + bias)
            error[np.arange(len(some)), goal[some % len(bags)]] -= 1
            rate = RATE * (1 - step / steps) / len(some)
            step += 1
            back = error @ weights.T
            owner = np.repeat(np.arange(len(some)), np.diff(np.append(first, len(buckets))))
            np.add.at(embeddings, buckets, -rate * back[owner] * shares[:, None] * len(first))
            weights -= rate * average.T @ error
            bias -= rate * error.sum(0)
    table = np.zeros((BUCKETS + 1, len(languages) + 1), np.float32)
    table[:BUCKETS, :-1], table[:BUCKETS, -1] = embeddings @ weights, 1
    model = Model(languages, table, bias, 1.0, 0.0)
    held = [bags[i] for i in np.flatnonzero(kept_back)]
    if held:
        truth = np.tile(goal[kept_back], 2)
        sums = np.array(
            [(table[b] * c[:, None]).sum(0) for b, c in held] + [table[thinned(bag)[0]].sum(0) for bag in held]
        )

        def loss(t: float) -> float:
            model.temperature = t
            return -np.log(model.probabilities(sums)[np.arange(len(truth)), truth] + 1e-12).mean()

        model.temperature = min(np.geomspace(0.1, 10, 41), key=loss)
        found = model.probabilities(sums)
        right = found.max(1)[found.argmax(1) == truth]
        if len(right):
            model.threshold = min(REJECT_BELOW, float(np.quantile(right, REJECT_SHARE)))
    return model


def predict(model: Model | None, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text the place of its language (one past the last: undetermined), the score, and whether it is rejected."""
    letters = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False).to_numpy(zero_copy_only=False)
    best, score = np.full(len(texts), len(model.languages) if model else 0), np.zeros(len(texts))
    if model:
        found = model.probabilities(score_sums(texts, model.rows))
        best, score = np.where(letters, found.argmax(1), best), np.where(letters, found.max(1), 0.0)
    return best, score, ~letters | (score < (model.threshold if model else 1.0))


def _predict(model: Model | None):
    names = pa.array([*(model.languages if model else []), UNDETERMINED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, 2):
                best, score, rejected = predict(model, some.column(2))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), names.take(pa.array(best)), pa.array(score), pa.array(rejected)],
                    ["doc_id", "held_out", "lang_pred", "score", "rejected"],
                )

    return run


def recognised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows that are not rejected, with their columns as they are; decided row by row, without a join.

    Without any labelled document there is nothing to recognise by, and only texts without a letter go.
    """
    require(docs, id_col, text_col, lang_col)
    model = train(_sample(docs, id_col, text_col, lang_col))
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, place):
                texts = some.column(place)
                letters = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False)
                yield some.filter(pa.array(~predict(model, texts)[2]) if model else letters)

    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every row; learned from the rows themselves.

    Learns from text and language of rows whose id's crc32 modulo 4 is not 2.
    """
    require(docs, id_col, text_col, lang_col)
    model = train(_sample(docs, id_col, text_col, lang_col))
    whole = docs.select(
        ref(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(id_remainder(id_col, 4) == 2, F.lit(False)).alias("held_out"),
        ref(text_col).alias("text"),
    )
    return whole.mapInArrow(
        _predict(model), "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean"
    )
