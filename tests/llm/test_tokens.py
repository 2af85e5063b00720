"""Token files, packing and pieces against the libraries, and exact round trips."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quarrystone.llm import packing, pieces, token_files
from quarrystone.llm.pieces import _fields
from quarrystone.llm.tokens import Encoder
from quarrystone.plans.scratch import scratch_folder

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " a", "a ", "a  b", "a   b", "a \n b", "\n\n a", "x  y", "x 　y", "<|endoftext|> hi", "it's",
       "日本 語", "a\tb c", "tail\n", "   ", "123 456,7 ", "\x1c a", "the the the", "é à", "word " * 3000]
SCHEMA = "doc_id bigint, text string, n_tokens string, start int"


def _noise(n):
    draw = random.Random(3)
    return ["".join(draw.choice(" \n\ta1,é'# ") for _ in range(draw.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


def _ids(library, text, end):
    return library.encode(text or "", add_special_tokens=False).ids + [end]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_the_library(library):
    texts = ODD + _noise(800)
    small = Encoder(BPE, cache_words=5)  # starts over again and again
    for encoder in (Encoder(BPE), small):
        for part in (texts, texts[:7], texts):
            ids, until = encoder.encode(pa.array(part))
            for text, a, b in zip(part, until, until[1:]):
                assert ids[a:b].tolist() == library.encode(text or "", add_special_tokens=False).ids


def _documents(spark, texts):
    return spark.createDataFrame([(7 * i - 9, t, "x", 0) for i, t in enumerate(texts)], SCHEMA).repartition(5)


def test_token_files_round_trip(spark, library):
    texts = ODD + _noise(60)
    docs = _documents(spark, texts)
    docs = docs.union(docs.where("doc_id = 5"))  # a repeated row
    rows = {}
    for r in token_files.round_trip(docs, BPE).collect():
        rows.setdefault(r.doc_id, []).append(r)
    start = 0
    for i, text in enumerate(texts):
        ids = _ids(library, text, 0)
        for r in sorted(rows[7 * i - 9], key=lambda r: r.start):
            assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), _crc(ids))
            start += len(ids)
    assert len(rows[5]) == 2


def test_single_documents_are_read_alone(spark, library):
    folder = scratch_folder(spark)
    token_files.write_token_files(_documents(spark, ODD), folder, BPE)
    found = {r.doc_id: r.ids for r in token_files.read_token_ids(spark, folder, [-9, 5, 1_000]).collect()}
    assert found == {-9: _ids(library, ODD[0], 0), 5: _ids(library, ODD[2], 0)}


def test_a_wrong_dictionary_is_refused(spark):
    one, other = scratch_folder(spark), scratch_folder(spark)
    token_files.write_token_files(_documents(spark, ODD), one, BPE)
    token_files.write_token_files(_documents(spark, _noise(50)), other, BPE)
    mixed = scratch_folder(spark)
    spark.read.parquet(f"{one}/blocks").write.parquet(f"{mixed}/blocks")
    spark.read.parquet(f"{other}/dictionary").write.parquet(f"{mixed}/dictionary")
    with pytest.raises(Exception, match="another dictionary"):
        token_files.token_digests(spark, mixed).collect()


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert token_files.round_trip(none, BPE).collect() == []
    assert packing.pack(none, BPE).collect() == []
    assert pieces.piece_digests(none, PIECES).collect() == []


@pytest.mark.parametrize("capacity", [16, 64, 1024])
def test_packing_is_gapless_and_whole(spark, library, capacity):
    texts = ODD + _noise(300)
    rows = packing.pack(_documents(spark, texts), BPE, capacity=capacity).collect()
    own, sequences, total = defaultdict(list), defaultdict(list), 0
    for r in rows:
        own[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, text in enumerate(texts):
        ids, at = _ids(library, text, 2), 0
        total += len(ids)
        for k, r in enumerate(sorted(own[7 * i - 9], key=lambda r: r.piece)):
            assert (r.piece, r.start, r.ids_crc32) == (k, at, _crc(ids[at : at + r.length]))
            assert r.length == capacity or k == 0
            at += r.length
        assert at == len(ids)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) <= 1.1 * total / capacity + 2


def test_short_pieces_go_by_patterns_of_four():
    assert len(packing.patterns(np.bincount([256] * 8, minlength=1024), 1024)) == 1
    histogram = np.zeros(1024, np.int64)
    histogram[200:341] = np.random.default_rng(1).integers(0, 2000, 141)
    assert packing.plan(histogram, 1024).sequences <= 1.06 * (histogram * np.arange(1024)).sum() / 1024


def test_plan_is_near_the_bound_for_any_amount():
    rng = np.random.default_rng(1)
    for histogram in (rng.integers(0, 50, 1024), rng.integers(0, 5_000_000, 1024), np.eye(1024, dtype=int)[600] * 10**9,
                      np.zeros(1024, int)):
        histogram[0] = 0
        found = packing.plan(histogram, 1024)
        tokens = int((histogram * np.arange(1024)).sum())
        assert found.sequences >= -(-tokens // 1024)
        if histogram[600] < 10**9 and tokens:
            assert found.sequences <= 1.02 * tokens / 1024 + 5


def _unigram_library():
    """The library's own unigram encoder with the same pieces: the model file with another model type."""

    def varint(n):
        out = b""
        while True:
            out += bytes([(n & 127) | (128 if n > 127 else 0)])
            n >>= 7
            if not n:
                return out

    out = b""
    proto = sentencepiece.SentencePieceProcessor(model_file=PIECES).serialized_model_proto()
    for number, value in _fields(proto):
        if number == 2:
            body = b""
            for k, v in _fields(value):
                v = 1 if k == 3 else v
                if isinstance(v, int):
                    body += varint(k << 3) + varint(v)
                elif k in (10, 15, 51):
                    body += varint(k << 3 | 5) + v
                else:
                    body += varint(k << 3 | 2) + varint(len(v)) + v
            value = body
        out += varint(number << 3 | 2) + varint(len(value)) + value
    return sentencepiece.SentencePieceProcessor(model_proto=out)


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces.load(PIECES)


def test_pieces_equal_the_library(model):
    library = _unigram_library()
    draw = random.Random(5)
    words = "the thing of and other interesting éclair über nación, end. (yes) under-score mañana".split()
    texts = ["", None, "a", "b", *[" ".join(draw.choices(words, k=draw.randint(1, 30))) for _ in range(300)]]
    encoder = pieces.Unigram(model, cache_words=50)
    for part in (texts[:40], texts):
        ids, until = encoder.encode(pa.array(part))
        back = encoder.decode(ids, until)
        for text, a, b, decoded in zip(part, until, until[1:], back):
            own = ids[a:b].tolist()
            assert decoded == (text or "") == library.decode(own)
            # The first of several paths comes from the library's lattice; ties may differ.
            best = library.nbest_encode_as_ids(text, 2)[0] if text else []
            assert own == best or model.scores[own].sum() == model.scores[best].sum()


def _best_path(model, text):
    """Scores of whole texts by trying every piece everywhere."""
    known = {t: i for i, t in enumerate(model.texts) if t and model.trie_ids.get(t) == i}
    data = b"" if not text else (" " + text).encode()
    best = {0: 0.0}
    for i in range(len(data)):
        if i not in best:
            continue
        for j in range(i + 1, min(len(data), i + 48) + 1):
            if data[i:j] in known:
                best[j] = max(best.get(j, -np.inf), best[i] + model.scores[known[data[i:j]]])
        j = i + len(data[i:].decode()[0].encode())
        if data[i:j] not in known:
            best[j] = max(best.get(j, -np.inf), best[i] + model.unknown_score)
    return best[len(data)]


def test_fallback_paths_are_the_best(model):
    byte_ids = set(model.byte_ids.tolist())
    model.trie_ids = {t: i for i, t in enumerate(model.texts) if t and i not in byte_ids and model.scores[i] < 0}
    draw = random.Random(6)
    texts = ["".join(draw.choice(" \nabcé日\U0001f600#the") for _ in range(30)) for _ in range(60)]
    encoder = pieces.Unigram(model)
    ids, until = encoder.encode(pa.array(texts))
    for text, a, b, decoded in zip(texts, until, until[1:], encoder.decode(ids, until)):
        score, fallback = 0.0, b""
        for i in ids[a:b].tolist():
            if i in byte_ids:
                fallback += model.texts[i]
            else:
                score += model.scores[i]
        score += model.unknown_score * len(fallback.decode())
        assert decoded == text
        assert score == pytest.approx(_best_path(model, text), abs=1e-3)


def test_markers_and_broken_bytes(spark, model):
    encoder = pieces.Unigram(model)
    ids, until = encoder.encode(pa.array(["a▁b"]))
    assert encoder.decode(ids, until) == ["a b"]
    broken = np.array([model.byte_ids[0xE6]])
    assert encoder.decode(broken, np.array([0, 1])) == ["�"]
    docs = spark.createDataFrame([(1, "a b", "x", 0), (1, "a b", "x", 0), (2, None, "x", 0), (3, "x" * 70_000, "x", 0)], SCHEMA)
    encoded = pieces.encode_documents(docs, PIECES)
    assert sorted((r.doc_id, r.text[:9]) for r in pieces.decode_documents(encoded, PIECES).collect()) == [
        (1, "a b"), (1, "a b"), (2, ""), (3, "x" * 9)
    ]
    assert all(r.round_trip for r in pieces.piece_digests(docs, PIECES).collect())


def test_calls_and_gathers_are_bounded(monkeypatch):
    """A slice of any size goes to the library and through the table in small portions, with the same ids."""
    import public_tokenizers
    import pyarrow as pa

    from quarrystone.llm import tokens

    texts = ["plain words here " + "again and again" * (i % 5) + f" {i}" for i in range(60)] + ["two  blanks", "", None, " ", "x\n y"] * 9
    path = public_tokenizers.path("byte_bpe_50k.json")
    expected = tokens.Encoder(path).encode(pa.array(texts, pa.string()))
    monkeypatch.setattr(tokens, "CALL_CHARS", 40)
    monkeypatch.setattr(tokens, "GATHERED", 7)
    encoder = tokens.Encoder(path)
    sizes, encode = [], encoder.library.encode_batch_fast

    class Watched:
        def encode_batch_fast(self, some, **kwargs):
            sizes.append(sum(map(len, some)) - len(some[-1]))
            return encode(some, **kwargs)

    encoder.library = Watched()
    ids, until = encoder.encode(pa.array(texts, pa.string()))
    assert (ids == expected[0]).all() and (until == expected[1]).all()
    assert len(sizes) > 5 and max(sizes) < 40
