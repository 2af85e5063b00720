"""Similarity joins and search against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarrystone.llm import components, ngram_join, topk, vector_join

DOCS = "doc_id bigint, text string, n_links string, class_id int"


def _sets(texts):
    out = {}
    for i, text in texts:
        w = (text or "").lower().split()
        shingles = [tuple(w[k : k + 5]) for k in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []
        out[i] = frozenset(shingles)
    return out


def _brute(ids, linked):
    links = {i: sum(linked(i, j) for j in ids if j != i) for i in ids}
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if i != j and label[j] < label[i] and linked(i, j):
                    label[i], changed = label[j], True
    return {i: (label[i], links[i]) for i in ids}


def _copies(seed):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefgh", k=3))
    texts = [" ".join(word() for _ in range(draw.choice((1, 4, 5, 30, 120)))) for _ in range(25)]
    near = [word() for _ in range(100)]
    for _ in range(60):  # a large group of near copies
        one = list(near)
        for _ in range(draw.randint(0, 4)):
            one[draw.randrange(100)] = word()
        texts.append(" ".join(one))
    for _ in range(20):
        one = texts[draw.randrange(25)].split()
        one[draw.randrange(len(one))] = word()
        texts.append(draw.choice([" ", "\n", "\t "]).join(one).upper())
    texts += [texts[3]] * 15 + ["", None, "  ", "x " * 50_000, "x " * 40_000 + "y"]
    return list(enumerate(texts, 100))


@pytest.mark.parametrize("small,block", [(96, 256), (5, 7)])
def test_ngram_join(spark, monkeypatch, small, block):
    monkeypatch.setattr(ngram_join, "SMALL", small)
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", block)
    texts = _copies(small)
    sets = _sets(texts)

    def linked(i, j):
        both = len(sets[i] & sets[j])
        return bool(both) and 10 * both >= 8 * (len(sets[i]) + len(sets[j]) - both)

    rows = [(i, t, "x", 1) for i, t in texts]
    docs = spark.createDataFrame(rows + rows[:3] + [(None, "a b c", "x", 1)], DOCS).repartition(4)
    found = ngram_join.similar_documents(docs).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in found} == _brute(list(sets), linked)
    assert len(found) == len(texts)
    assert all(r.kept == (r.doc_id == r.class_id) for r in found)


@pytest.mark.parametrize("depth", [1, 2, 3, 4])
def test_planted_pairs_are_found_at_every_depth(depth):
    pairs, rng = 20_000, np.random.default_rng(depth)
    x, other = rng.integers(0, 1 << 32, (2, pairs, ngram_join.POSITIONS), dtype=np.uint32)
    both = np.concatenate([x, np.where(rng.random(x.shape) < 0.8, x, other)])
    found = np.zeros(pairs, bool)
    for run in range(ngram_join.runs_needed(depth, 0.8, 0.999)):
        path, ids = np.full(2 * pairs, run, np.uint64), np.arange(2 * pairs)
        for _ in range(depth):
            children = list(ngram_join._children(path, both[ids], pa.array(ids)))
            path = np.concatenate([c.column(0).to_numpy().view(np.uint64) for c in children])
            ids = np.concatenate([c.column(1).to_numpy() for c in children])
        ends = path ^ ngram_join.mixed((ids % pairs).astype(np.uint64))  # the bucket, and which pair
        met = np.intersect1d(ends[ids < pairs], ends[ids >= pairs])
        found[ids[np.isin(ends, met)] % pairs] = True
    assert (~found).mean() <= 0.0015  # 0.001, and over two standard deviations of 20,000 pairs


def test_empty_joins(spark):
    assert ngram_join.similar_documents(spark.createDataFrame([], DOCS)).collect() == []
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert vector_join.similar_vectors(none).collect() == []
    assert topk.exact_top_k(none).collect() == []
    one = spark.createDataFrame([(3, None), (4, [0.0, 0.0])], "vec_id bigint, embedding array<double>")
    assert sorted(tuple(r) for r in vector_join.similar_vectors(one).collect()) == [(3, 0, 3, True), (4, 0, 4, True)]


def test_components_of_a_long_chain(spark):
    chain = spark.range(1, 400).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    more = spark.createDataFrame([(1000, 1000 + k) for k in range(1, 50)] + [(7, 7), (1001, 1000)], "a bigint, b bigint")
    found = {r.node: r.component for r in components.components(chain.union(more)).collect()}
    assert found == {i: 1 for i in range(1, 401)} | {i: 1000 for i in range(1000, 1050)}


def _vectors(kind):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(120, 20))
    near = base[rng.integers(0, 5, 150)] + rng.normal(size=(150, 20)) * rng.uniform(0, 0.5, (150, 1))
    rows = [[float(np.float32(v)) for v in x] for x in np.concatenate([base, near])]
    rows += [rows[0], [2 * v for v in rows[0]], rows[7]] + [rows[1]] * 20
    rows += [None, [0.0] * 20, [float("nan")] * 20, [1.0, None], [float("inf")] + [0.0] * 19, rows[2][:12]]
    return [(5 * i, r, 1) for i, r in enumerate(rows)], f"vec_id bigint, embedding array<{kind}>, n_links int"


def _plain(rows):
    good = {}
    for i, r, _ in rows:
        if r is not None and all(v is not None and np.isfinite(v) for v in r):
            good[i] = np.array(r + [0.0] * (20 - len(r)))
    return good


@pytest.mark.parametrize("kind,block", [("float", 1024), ("double", 9)])
def test_vector_join(spark, monkeypatch, kind, block):
    for name, value in (("MEMBER_BLOCK", block), ("PROBE_BLOCK", block), ("LIST_SIZE", 40)):
        monkeypatch.setattr(vector_join, name, value)
    rows, schema = _vectors(kind)
    good = {i: x / np.linalg.norm(x) for i, x in _plain(rows).items() if x.any()}
    near = {i: {j for j in good if good[i] @ good[j] >= 0.95} for i in good}
    expected = _brute([i for i, _, _ in rows], lambda i, j: i in near and j in near[i])
    df = spark.createDataFrame(rows + rows[:4], schema).repartition(3)
    found = vector_join.similar_vectors(df).collect()
    assert len(found) == len(rows)
    wrong = [r for r in found if (r.component_id, r.n_links) != expected[r.vec_id]]
    assert len(wrong) <= 0.01 * len(rows)  # links at the very threshold may lie beyond the probes
    assert all(r.n_links <= expected[r.vec_id][1] for r in found)


@pytest.mark.parametrize("block", [4096, 30])
def test_exact_top_k(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    rows, schema = _vectors("double")
    whole = {i: np.floor(256 * x).astype(int) for i, x in _plain(rows).items()}
    expected = set()
    for q in whole:
        if q % 50 == 0:
            best = sorted((-int(whole[q] @ whole[i]), i) for i in whole if i != q)[:5]
            expected |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    df = spark.createDataFrame(rows + rows[:4], schema).repartition(3)
    assert {tuple(r) for r in topk.exact_top_k(df).collect()} == expected


@pytest.mark.parametrize("block", [4096, 500])
def test_groups_out_of_reach_are_left_out(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", block)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(60, 16))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    x = centres[rng.integers(0, 60, 6000)] + rng.normal(size=(6000, 16)) * 0.03
    x[:2000] = x[0]  # a third of all rows are copies of one
    whole = np.floor(256 * x)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>").repartition(5)
    found = topk.exact_top_k(df, evaluated=True).collect()
    expected, scores = set(), whole[::50] @ whole.T
    for q, row in zip(range(0, 6000, 50), scores):
        row[q] = -np.inf
        best = np.lexsort((np.arange(6000), -row))[:5]
        expected |= {(q, k + 1, int(i), int(row[i])) for k, i in enumerate(best)}
    assert {tuple(r)[:4] for r in found} == expected
    # Of a copy's query the other copies are all candidates for a tie.
    single = {r.query_id: r.evaluated for r in found if r.query_id >= 2000}
    assert sum(single.values()) < 0.2 * 6000 * len(single)


def test_few_candidates(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [0.5]), (50, [-1.0])], "vec_id bigint, embedding array<float>")
    found = sorted(tuple(r) for r in topk.exact_top_k(df).collect())
    assert found == [(0, 1, 1, 32768), (0, 2, 50, -65536), (50, 1, 1, -32768), (50, 2, 0, -65536)]


def test_bounds_stop_early():
    rng = np.random.default_rng(0)
    x = np.floor(rng.normal(size=(4000, 3)) * 200)
    square = (x * x).sum(1)
    points = topk._lifted(x, square, square.max())
    pivots = topk.choose_pivots(points, 32)
    known = np.sqrt(topk.squared_distances(points, pivots))
    to = np.sqrt(topk.squared_distances(np.append(x[5], 0)[None], pivots))[0]
    bounds = np.abs(known - to).max(1) ** 2
    place, score, done = topk.nearest(x[5], 5, x, np.arange(4000), bounds, square[5] + square.max(), 5, 1.0)
    best = sorted((-(x[5] @ x[i]), i) for i in range(4000) if i != 5)[:5]
    assert [(-s, i) for s, i in zip(score, place)] == best and done < 4000


def test_bounds_from_codes_stay_below_distances():
    """Distances in 16-bit steps: no bound exceeds the true one, and the loss is two steps at most."""
    rng = np.random.default_rng(1)
    known, to = rng.normal(300, 40, (500, 70)), rng.normal(300, 40, (3, 70))
    codes, own, unit = topk._coded(known, to)
    assert codes.dtype == np.uint16 and codes.shape == (70, 500)
    for far, plain in zip(own.T, to):
        gap = topk._gaps(codes, far)
        true = np.abs(known - plain).max(1)
        bound = np.maximum(gap - 1.0, 0) * unit
        assert (bound <= true + 1e-9).all() and (bound >= true - 2 * unit - 1e-9).all()
    same = topk._coded(np.ones((4, 2)), np.ones((1, 2)))
    assert not topk._gaps(same[0], same[1][:, 0]).any()
