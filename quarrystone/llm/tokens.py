"""Byte-level BPE ids of many texts at once.

The tokenizers library does the encoding.  Its pattern never lets a pre-token reach over a
space that stands between two other characters, so a text is the sequence of its space-separated
words, each with its space in front.  A column is cut into words, every distinct word is
encoded once per task and kept in a bounded table, and the ids of the texts are gathered from
it.  Texts where a space touches other white space or an added token occurs, and tokenizers of
another kind, go through the library whole.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import spans

# Distinct words a task remembers before it starts over.
CACHE_WORDS = 500_000
# Words joined into one call of the library.
CALL_WORDS = 8_192
# Characters of the texts of one call; what the library returns for a token is many times its id.
CALL_CHARS = 1 << 18
# Ids gathered from the table at once.
GATHERED = 1 << 18
_BLANK = r"[\s\v\x{85}\p{Z}\x1c-\x1f]"


class WordTable:
    """Ids of distinct words, remembered in Arrow and numpy arrays up to a bound."""

    def __init__(self, cache_words: int = CACHE_WORDS) -> None:
        self.cache_words = cache_words
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.string())
        self.pool, self.starts, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end and how many belong to each."""
        raise NotImplementedError

    def places(self, words: pa.Array) -> np.ndarray:
        """Where each distinct word stands in the table, after adding those it lacks."""
        if len(self.words) > self.cache_words:
            self._forget()
        found = pc.index_in(words, value_set=self.words)
        places, new = pc.fill_null(found, 0).to_numpy().astype(np.int64), pc.is_null(found)
        missing = words.filter(new)
        if len(missing):
            places[new.to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(len(missing))
            ids, counts = self.encode_words(missing)
            self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(counts) - counts])
            self.counts, self.pool = np.concatenate([self.counts, counts]), np.concatenate([self.pool, ids])
            self.words = pa.concat_arrays([self.words, missing])
        return places


class Encoder(WordTable):
    """Ids without special tokens, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS) -> None:
        super().__init__(cache_words)
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        layout = json.loads(self.library.to_str())
        before = layout.get("pre_tokenizer") or {}
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.by_words = (
            before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space")
            and before.get("use_regex", True)
            and layout["model"]["type"] == "BPE"
            and not any(layout.get(k) for k in ("normalizer", "truncation", "padding"))
        )
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for piece, i in vocabulary.items():
            self.width[i] = len(piece)  # a byte-level piece has one character for each byte
        self.odd = "|".join([f"{_BLANK} | {_BLANK}|^ | $", *map(re.escape, added)])

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        ids, first, chars = [], 0, 0
        for i, text in enumerate(texts):
            chars += len(text)
            if chars >= CALL_CHARS or i == len(texts) - 1:
                some = self.library.encode_batch_fast(texts[first : i + 1], add_special_tokens=False)
                ids += [np.array(e.ids, np.uint32) for e in some]
                first, chars = i + 1, 0
        return ids

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """With a space in front of each."""
        words = words.to_pylist()
        calls = [words[i : i + CALL_WORDS] for i in range(0, len(words), CALL_WORDS)]
        ids = self.whole(["".join([" " + w for w in call]) for call in calls])
        counts = []
        for k, call in enumerate(calls):
            ends = np.cumsum([len(w.encode()) + 1 for w in call])
            reached = np.cumsum(self.width[ids[k]])
            last = np.searchsorted(reached, ends)
            if len(reached) != last[-1] + 1 or (reached[last] != ends).any():  # not cut at the words
                each = self.whole([" " + w for w in call])
                ids[k], last = np.concatenate(each), np.cumsum([len(e) for e in each]) - 1
            counts.append(np.diff(last, prepend=-1))
        return np.concatenate(ids), np.concatenate(counts)

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.split_pattern(texts, " ")
        offsets = split.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        words = split.flatten().dictionary_encode()
        places = self.places(words.dictionary)[words.indices.to_numpy()]
        # The first word of a text has no space in front.
        first = pc.take(words.dictionary, words.indices.take(pa.array(offsets[:-1]))).dictionary_encode()
        heads = self.whole(first.dictionary.to_pylist())
        sizes = np.array([len(h) for h in heads], np.int64)
        pool = np.concatenate([self.pool, *heads])
        starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(sizes) - sizes])
        counts = np.concatenate([self.counts, sizes])
        places[offsets[:-1]] = len(self.starts) + first.indices.to_numpy()
        until = np.concatenate([[0], np.cumsum(counts[places])])
        ids = np.empty(until[-1], np.uint32)
        edges = np.searchsorted(until, np.arange(0, len(ids), GATHERED))
        for a, b in zip(edges, [*edges[1:], len(places)]):
            some = places[a:b]
            ids[until[a] : until[b]] = pool[spans(starts[some], counts[some])]
        return ids, until[offsets]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end and the offsets of each text; a null text has none."""
        texts = pc.fill_null(texts, "")
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        odd = odd if self.by_words else np.ones(len(texts), bool)
        if not odd.any():
            return self._plain(texts)
        each: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        for i, ids in zip(np.flatnonzero(odd), self.whole(texts.filter(pa.array(odd)).to_pylist())):
            each[i] = ids
        if not odd.all():
            ids, until = self._plain(texts.filter(pa.array(~odd)))
            for k, i in enumerate(np.flatnonzero(~odd)):
                each[i] = ids[until[k] : until[k + 1]]
        return np.concatenate(each), np.concatenate([[0], np.cumsum([len(e) for e in each])])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    return Encoder(path)
