"""Document quality by positive-unlabelled learning.

Trusted positives are labelled documents of quality 1; everything else is learned from unlabelled
web text.  A first classifier tells positives from unlabelled text on one half of the samples;
on the other half, the smallest ratio of the share of unlabelled to that of positive documents above
a score estimates the class prior.  The final classifier minimises the non-negative unbiased
risk with that prior: the positive part plus the larger of zero and what the unlabelled part holds
beyond the prior's share of positives; where that difference falls below zero, a step climbs back.
Last, the outputs are shifted so that the threshold stands where the estimated errors are fewest.

Features describe the whole text and need one pass over its bytes: frequencies of pairs of
character classes, shares of repeated and distinct words, capitals, and lengths.

Defined results: null and empty texts have all features zero and get the score of that point; without
any trusted positive the score is the same for every row (0.5); label rows with a null are ignored, and a document
with several labels is a positive if all of them are 1; rows that repeat an id are scored each; other columns
are ignored.
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

# Bounds of the two samples.
POSITIVE_DOCS, UNLABELLED_DOCS = 2_000, 4_000
THRESHOLD = 0.3
EPOCHS, BATCH, RATE, DECAY = 60, 256, 0.01, 5e-3
# Cuts whose estimated errors differ by less count as equally good; the chosen one keeps so far below the highest.
# Where the least errors would cost more than LOST of the trusted positives, the cut stays below those.
EQUAL, MARGIN, LOST = 2e-4, 0.5, 0.005
# The unlabelled part may fall below zero by so much before a step climbs back.
SLACK = 0.0
# Shares of positives above a score from which the prior is read.
PRIOR_SHARES = np.linspace(0.5, 1.0, 51)
CHUNK = 1 << 20

# Character classes, one for each group of bytes; bytes beyond ASCII and the rest have their own.
GROUPS = (
    "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\r", "\t",
    ".", ",", ";:", "!", "?", "\"'`", "-_", "()", "[]{}", "<>", "|", "#", "$%", "&", "*", "=+~^", "/\\", "@",
)
CLASSES = len(GROUPS) + 2
_CLASS = np.full(256, CLASSES - 1, np.int32)
_CLASS[128:] = CLASSES - 2
for _k, _group in enumerate(GROUPS):
    _CLASS[[ord(c) for c in _group]] = _k
EXTRAS = 6
FEATURES = CLASSES * CLASSES + EXTRAS


def _pair_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """By text: how often each pair of classes stands side by side."""
    texts, pairs = len(offsets) - 1, CLASSES * CLASSES
    counts = np.zeros(texts * pairs, np.float64)
    for a in range(0, len(data) - 1, CHUNK):
        kinds = _CLASS[data[a : a + CHUNK + 1]]
        text = np.searchsorted(offsets, np.arange(a, a + len(kinds)), side="right") - 1
        flat = text[:-1] * pairs + kinds[:-1] * CLASSES + kinds[1:]
        first, last = int(text[0]) * pairs, (int(text[-1]) + 1) * pairs
        counts[first:last] += np.bincount(flat[text[:-1] == text[1:]] - first, minlength=last - first)
    return counts.reshape(texts, pairs)


def features(texts: pa.Array) -> np.ndarray:
    """One row for each text; an empty text is all zero."""
    texts = pc.fill_null(texts, "")
    data, offsets = text_bytes(texts)
    length = np.diff(offsets)
    pairs = _pair_counts(data, offsets)
    total = np.maximum(pairs.sum(1, keepdims=True), 1)
    split = pc.split_pattern_regex(texts, r"[ \n]")
    until = split.offsets.to_numpy().astype(np.int64)
    until -= until[0]
    word = split.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
    words = np.diff(until)
    owner = np.repeat(np.arange(len(texts)), words)
    again = np.bincount(owner[1:], (word[1:] == word[:-1]) & (owner[1:] == owner[:-1]), len(texts))
    distinct = np.bincount(np.unique(owner * (word.max(initial=0) + 1) + word) // (word.max(initial=0) + 1),
                           minlength=len(texts))
    lower, upper = (pairs.reshape(-1, CLASSES, CLASSES)[:, k].sum(1) for k in (0, 1))
    extras = np.stack(
        [
            again / np.maximum(words, 1), distinct / np.maximum(words, 1), upper / np.maximum(upper + lower, 1),
            np.log1p(length) / 10, np.log1p(words) / 10, length / np.maximum(words, 1) / 10,
        ],
        1,
    ).astype(np.float64)
    extras[length == 0] = 0
    return np.concatenate([np.sqrt(pairs / total), extras], 1).astype(np.float32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    mean: np.ndarray
    spread: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return logistic(((x - self.mean) / self.spread) @ self.weights + self.bias)


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _adam(positive: np.ndarray, unlabelled: np.ndarray, slopes, rng: np.random.Generator) -> tuple[np.ndarray, float]:
    """Weights and bias after EPOCHS passes; ``slopes(p, u)`` are the risk's derivatives by the outputs."""
    size = positive.shape[1] + 1
    w, m, v, step = np.zeros(size), np.zeros(size), np.zeros(size), 0
    rounds = max(-(-len(unlabelled) // BATCH), 1)
    for epoch in range(EPOCHS):
        p_order, u_order = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
        for p, u in zip(np.array_split(p_order, rounds), np.array_split(u_order, rounds)):
            if not len(p) or not len(u):
                continue
            xp, xu = positive[p], unlabelled[u]
            dp, du = slopes(xp @ w[:-1] + w[-1], xu @ w[:-1] + w[-1])
            slope = np.append(dp @ xp + du @ xu, dp.sum() + du.sum())
            slope[:-1] += DECAY * w[:-1]
            step += 1
            m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
            rate = RATE * (1 - epoch / EPOCHS) + 1e-4
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def _told_apart(p: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the logistic loss of positives against unlabelled."""
    return -logistic(-p) / len(p), logistic(u) / len(u)


def _unbiased(prior: float):
    """Slopes of the non-negative unbiased risk under the logistic loss."""

    def slopes(p: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rest = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
        if rest < -SLACK:  # climb back
            return prior * logistic(p) / len(p), -logistic(u) / len(u)
        return prior * (-logistic(-p) - logistic(p)) / len(p), logistic(u) / len(u)

    return slopes


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The smallest ratio of shares above a score, with an allowance for the sizes of the samples."""
    if not len(positive) or not len(unlabelled):
        return 0.5
    allowance = np.sqrt(np.log(20) / (2 * len(unlabelled))) + np.sqrt(np.log(20) / (2 * len(positive)))
    cuts = np.quantile(positive, 1 - PRIOR_SHARES)
    above = lambda x: (x[:, None] >= cuts).mean(0)
    p, u = np.maximum(above(positive), 1e-9), above(unlabelled)
    best = np.argmin((u + allowance) / p)
    return float(np.clip(u[best] / p[best], 0.05, 0.98))


def train(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 11) -> Model | None:
    if not len(positive) or not len(unlabelled):
        return None
    rng = np.random.default_rng(seed)
    both = np.concatenate([positive, unlabelled])
    mean, spread = both.mean(0), np.maximum(both.std(0), 0.02)
    p, u = (((x - mean) / spread).astype(np.float64) for x in (positive, unlabelled))
    p, u = p[rng.permutation(len(p))], u[rng.permutation(len(u))]
    halves, priors = [(p[k::2], u[k::2]) for k in (0, 1)], []
    for own, other in (halves, halves[::-1]):
        w, b = _adam(*own, _told_apart, rng)
        priors.append(estimate_prior(*[x @ w + b for x in other]))
    prior = float(np.mean(priors))
    w, b = _adam(p, u, _unbiased(prior), rng)
    b += np.log(THRESHOLD / (1 - THRESHOLD)) - cut(p @ w + b, u @ w + b, prior)
    return Model(w, b, mean, spread, prior)


def cut(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """The output that THRESHOLD should stand for: where the estimated share of errors is least.

    Errors are the positives below and the unlabelled above that the prior does not account for.
    Where many outputs do equally well, one near their upper end: a wrong prior then costs little.
    """
    cuts = np.unique(np.concatenate([positive, unlabelled]))
    p = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    u = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    errors = prior * (1 - p) + np.maximum(u - prior * p, 0)
    best = cuts[errors <= errors.min() + EQUAL]
    top = min(best[-1], np.quantile(positive, LOST))
    return float(min(max(best[0], top - MARGIN), top))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for some in slices(batch, 1):
            rows = features(some.column(1)).astype("<f4")
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], ["id", "features"]
            )


def _collected(chosen: DataFrame) -> np.ndarray:
    """Features of a bounded sample, in an order that does not depend on the layout."""
    rows = chosen.mapInArrow(_extract, "id string, features binary").collect()
    rows = sorted((r.id, bytes(r.features)) for r in rows)
    return np.frombuffer(b"".join(f for _, f in rows), "<f4").reshape(-1, FEATURES)


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> Model | None:
    """Learn from trusted positives and unlabelled text of rows whose id's crc32 modulo 5 is not 0."""
    require(docs, id_col, text_col)
    require(labels, id_col, label_col)
    learn = id_remainder(id_col, 5) != 0
    trusted = (
        labels.where(learn & ref(label_col).isNotNull())
        .groupBy(ref(id_col).alias("__id"))
        .agg(F.min(ref(label_col)).alias("__worst"))
        .where(F.col("__worst") == 1)
    )
    ids = hash_sample(trusted, "__id", POSITIVE_DOCS, trusted.count()).select("__id")
    own = docs.where(learn).select(ref(id_col).alias("__id"), ref(text_col).alias("text"))
    pick = lambda df: df.select(F.col("__id").cast("string").alias("id"), "text")
    positive = _collected(pick(own.join(ids, "__id", "left_semi")))
    total = docs.where(learn).select(ref(id_col)).count()
    unlabelled = _collected(pick(hash_sample(own, "__id", UNLABELLED_DOCS, total)))
    return train(positive, unlabelled)


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    require(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, 2):
                found = model.score(features(some.column(2))) if model else np.full(some.num_rows, 0.5)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0), some.column(1), pa.array(found, pa.float64()),
                        pa.array((found >= THRESHOLD).astype(np.int32)),
                    ],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    whole = docs.select(
        ref(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(id_remainder(id_col, 5) == 0, F.lit(False)).alias("held_out"),
        ref(text_col).alias("text"),
    )
    return whole.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def kept(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows whose text reaches the threshold, with their columns as they are; decided row by row, without a join."""
    require(docs, text_col)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, place):
                stays = model.score(features(some.column(place))) >= THRESHOLD if model else np.ones(some.num_rows, bool)
                yield some.filter(pa.array(stays))

    return docs.mapInArrow(run, docs.schema)
