"""Sets of five-word shingles of many texts at once, as 64-bit hashes.

Words are what white space separates (blanks, tabs, line ends and the other control characters below it),
in lower case.  A text of fewer than five words has one shingle, all its words; a text without words has
none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import spans, text_bytes

WORDS = 5
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = [np.uint64(k) for k in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_PLACE = [np.uint64(k) for k in np.random.default_rng(5).integers(0, 1 << 63, WORDS, dtype=np.int64) * 2 + 1]
_powers: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _power(which: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_powers.get(which, ())) < n:
        steps = np.full(max(n, 1 << 20), base)
        steps[0] = 1
        _powers[which] = np.cumprod(steps, dtype=np.uint64)
    return _powers[which][:n]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and the offsets of the texts in them."""
    data, offsets = text_bytes(pc.utf8_lower(texts))
    # Byte sums weighted with powers of an odd base: a word is a difference of running sums.
    sums = np.concatenate([[np.uint64(0)], np.cumsum(data * _power("up", _BASE, len(data)), dtype=np.uint64)])
    inside = np.concatenate([[False], data > 32, [False]])
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    last = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    values = (sums[last] - sums[first]) * _power("down", _INVERSE, len(data) + 1)[first]
    return mixed(values + (last - first).astype(np.uint64)), np.searchsorted(first, offsets)


def _few(words: np.ndarray) -> np.uint64:
    """The one shingle of a short text: its words and their number."""
    total = (words * np.array(_PLACE[: len(words)])).sum(dtype=np.uint64)
    return mixed(np.array([total]) + np.uint64(len(words)))[0]


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text in ascending order, end to end, and their offsets."""
    words, until = word_hashes(texts)
    count = np.diff(until)
    padded = np.append(words, np.zeros(WORDS - 1, np.uint64))
    sums = np.zeros(len(words), np.uint64)
    for k in range(WORDS):
        sums += padded[k : k + len(words)] * _PLACE[k]
    own = np.where(count >= WORDS, count - WORDS + 1, 0)
    values = mixed(sums[spans(until[:-1], own)])
    owner = np.repeat(np.arange(len(count)), own)
    few = [(t, _few(words[until[t] : until[t + 1]])) for t in np.flatnonzero((count > 0) & (count < WORDS))]
    if few:
        at = np.searchsorted(owner, [t for t, _ in few])
        values = np.insert(values, at, np.array([v for _, v in few], np.uint64))
        owner = np.insert(owner, at, [t for t, _ in few])
    starts = np.searchsorted(owner, np.arange(len(count) + 1))
    for a, b in zip(starts, starts[1:]):
        values[a:b].sort()
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(count) + 1))
