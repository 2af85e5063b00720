"""Filter audit, whitening and substring dedup against plain computations."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrystone.llm import filter_audit, substring, whitening

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, mask int, hash string, doc string, part string"
LABELS = "doc_id bigint, quality int, toxic int"


# Filter audit ----------------------------------------------------------------------------------------------------


def _fails(rows):
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    out = []
    for i, text, lang in rows:
        text = text or ""
        words = WORD.findall(text)
        out.append((i, lang or "", {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and i > least[text],
        }))
    return out


def _audit(rows, labels):
    good, toxic = ({i for i, *marks in labels if i is not None and marks[k] == 1} for k in (0, 1))
    found, fails = {}, _fails(rows)
    for part in {p for _, p, _ in fails}:
        own = [(i, f) for i, p, f in fails if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if f[letter]]
                earlier = [f for _, f in own if f[letter] and any(f[x] for x in order[: step - 1])]
                left = [(i, f) for i, f in left if not f[letter]]
                shapley[letter] += len(gone)
                found[part, "".join(order), step] = [
                    len(left), len(gone), len(earlier), sum(f[letter] and sum(f.values()) == 1 for _, f in own),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
        for (p, order, step), values in found.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in found.items()}


def _texts():
    draw = random.Random(4)
    word = lambda: "".join(draw.choices("abcdefghij", k=4))
    rows = []
    for i in range(160):
        words = [word() for _ in range(draw.choice((3, 99, 100, 140)))]
        if draw.random() < 0.3:
            words = [draw.choice(words[:60]) for _ in words]
        if draw.random() < 0.3:
            words = [w.upper() if draw.random() < 0.2 else w for w in words]
        if draw.random() < 0.2:
            words[0] = draw.choice(("#tag", "a|b", "5%", "R&D", "*", "$", "€"))
        rows.append((i, draw.choice((" ", "\n", "\t \v")).join(words), draw.choice(("en", "de", "", None))))
    rows += [(200 + k, rows[0][1], "en") for k in range(60)]  # a hot text
    rows += [(300, None, "en"), (301, "", None), (302, "  \n", "de"), (303, "x\x1cy\xa0z", "fr"), (5, rows[7][1], "de")]
    rows += [(7, rows[7][1], "en"), (None, rows[9][1], "en"), (None, None, None), (304, "Ab " * 60_000, "long")]
    rows += [(305, "ÄÖÜ" * 30, "fr"), (306, "A" + "é" * 9, "fr"), (307, "A" + "é" * 8, "fr")]
    return rows


def test_filter_audit(spark):
    rows = _texts()
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 310, 3)] + [(6, None, 1), (None, 1, 1), (9, 1, None), (9, 0, 0)]
    docs = spark.createDataFrame([(*r, 1, "h", "d", "p") for r in rows], DOCS).repartition(5)
    found = filter_audit.filter_audit(docs, spark.createDataFrame(labels, LABELS).withColumn("part", F.lit(1)))
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found.collect()}
    assert got == _audit(rows, labels)
    assert found.columns == [
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    ]


def test_filter_audit_of_other_filters_and_empty_tables(spark):
    rows = [(1, "a b", "x"), (2, "a b", "x"), (3, "a", None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    found = filter_audit.filter_audit(docs, None, {"S": F.col("words") < 2}).collect()
    assert sorted(tuple(r) for r in found) == [
        ("", "ES", 1, 1, 0, 0, 0, 0, 0, 0), ("", "ES", 2, 0, 1, 0, 1, 0, 0, 2),
        ("", "SE", 1, 0, 1, 0, 1, 0, 0, 2), ("", "SE", 2, 0, 0, 0, 0, 0, 0, 0),
        ("x", "ES", 1, 1, 1, 0, 1, 0, 0, 2), ("x", "ES", 2, 1, 0, 0, 0, 0, 0, 0),
        ("x", "SE", 1, 2, 0, 0, 0, 0, 0, 0), ("x", "SE", 2, 1, 1, 0, 1, 0, 0, 2),
    ]
    assert filter_audit.filter_audit(docs.limit(0), None).collect() == []
    with pytest.raises(ValueError):
        filter_audit.filter_audit(docs, None, {"E": F.lit(True)})


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 4097])
def test_positional_popcounts(n):
    words = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    expected = [int(((words >> np.uint32(b)) & np.uint32(1)).sum()) for b in range(32)]
    assert filter_audit.positional_popcounts(words).tolist() == expected


def test_survival_words():
    words = filter_audit.survival_words(5)
    for failed, subset in itertools.product(range(32), repeat=2):
        assert bool(int(words[failed]) >> subset & 1) == (failed & subset == 0)


# Whitening -------------------------------------------------------------------------------------------------------


def _symmetric(values, seed):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize(
    "values",
    [[3.0], [2.0, 1.0], [5.0] * 7, list(range(40)), [1.0] * 9 + [0.0] * 9 + [4.0] * 3, [2.0**-k for k in range(50)], [0.0] * 5,
     [1e9, 1.0, 1.0, 1e-3], [-3.0, -1.0, 0.0, 2.0]],
)
def test_spectral_divide_and_conquer(values):
    a = _symmetric(values, len(values))
    found, vectors = whitening.spectral(a)
    scale = max(abs(np.array(values)).max(), 1e-300)
    assert np.allclose(found, sorted(values, reverse=True), atol=1e-13 * scale * len(values))
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-13)
    assert np.linalg.norm(a @ vectors - vectors * found) <= 1e-13 * scale * len(values)


def test_polar_factor():
    a = _symmetric([4.0, 1e-9, -2.0, -1e-6, 7.0], 1)
    u = whitening.polar(a)
    assert np.allclose(u @ u, np.eye(5), atol=1e-12) and np.allclose(u @ a, (u @ a).T, atol=1e-12)
    assert (np.linalg.eigvalsh(u @ a) > -1e-12).all()


VECTORS = "vec_id bigint, embedding array<float>, n int, deviation string, x string"


def _rows():
    rng = np.random.default_rng(8)
    base = rng.normal(size=(200, 12)) * np.linspace(1, 3, 12)
    rows = [[float(np.float32(v)) for v in x] for x in base]
    rows += [rows[0]] * 80 + [[v + 1e-6 for v in rows[1]], rows[2][:7]]
    bad = [None, [1.0, None], [float("nan")] * 12, [float("inf")] + [0.0] * 11]
    return [(i, r, 1, "d", "x") for i, r in enumerate(rows + bad)] + [(3, rows[5], 1, "d", "x"), (None, rows[6], 1, "d", "x")]


def test_whitening(spark):
    rows = _rows()
    good = [(r[0], np.array(r[1] + [0.0] * (12 - len(r[1])), np.float32)) for r in rows
            if r[1] is not None and all(v is not None and np.isfinite(v) for v in r[1])]
    x = np.floor(256 * np.stack([v for _, v in good]).astype(float)).astype(np.int64)
    fitted = np.unique(x, axis=0)
    n, sums = len(fitted), fitted.sum(0)
    centred = fitted - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    expected = (x - sums / n) @ vectors[:, :4] / np.sqrt(values[:4])
    found = whitening.whitened_components(spark.createDataFrame(rows, VECTORS).repartition(4)).collect()
    assert len(found) == 4 * len(good)
    sign = {}
    for k in range(4):
        first = next(r for r in found if r.vec_id == 10 and r.component == k + 1)
        sign[k] = np.sign(first.whitened * expected[10, k])
    by = sorted(((-1 if i is None else i), k, d, w) for (i, _), w, d in zip(good, expected, ((n * x - sums) ** 2).sum(1))
                for k, w, d in [(k, w[k] * sign[k], d) for k in range(4)])
    got = sorted((-1 if r.vec_id is None else r.vec_id, r.component - 1, r.deviation, r.whitened) for r in found)
    assert [g[:3] for g in got] == [b[:3] for b in by]
    assert np.allclose([g[3] for g in got], [b[3] for b in by], atol=1e-9)
    assert {r.n for r in found} == {n} and {r.identity_error for r in found} == {found[0].identity_error}
    assert found[0].identity_error < 1e-10
    for r in found:
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)


def test_whitening_of_few_or_no_vectors(spark):
    kind = "vec_id bigint, embedding array<double>"
    none = spark.createDataFrame([(1, None), (2, [float("nan")])], kind)
    assert whitening.whitened_components(none).collect() == []
    assert whitening.whitened_components(none.limit(0)).collect() == []
    assert whitening.whitened_components(spark.createDataFrame([(1, [])], kind)).collect() == []
    one = whitening.whitened_components(spark.createDataFrame([(1, [0.5, 2.0]), (2, [0.5, 2.0])], kind)).collect()
    assert sorted(tuple(r) for r in one) == [(i, c, 1, 0, 0.0, 0.0, 0.0) for i in (1, 2) for c in (1, 2)]
    flat = spark.createDataFrame([(k, [float(k), 1.0, float(k)]) for k in range(5)], kind)  # rank one
    found = {(r.vec_id, r.component): r for r in whitening.whitened_components(flat).collect()}
    assert all(found[k, c].whitened == 0.0 for k in range(5) for c in (2, 3))
    assert abs(found[4, 1].whitened) == pytest.approx(2 / np.sqrt(2)) and found[0, 1].explained == pytest.approx(1)
    large = spark.createDataFrame([(1, [1e8]), (2, [-1e8])], kind)
    assert [r.deviation for r in whitening.whitened_components(large).collect()] == [None, None]
    with pytest.raises(Exception, match="whole number"):
        whitening.whitened_components(spark.createDataFrame([(1, [1e30])], kind)).collect()


def test_exact_deviations():
    x, sums = np.array([[1 << 20, -3], [5, 7]]), np.array([(1 << 20) + 5, 4])
    for n in (2, 1 << 12, 1 << 40):
        exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums)) for r in x]
        assert whitening.deviations(x, n, sums) == [v if v < 1 << 63 else None for v in exact]


# Substring dedup --------------------------------------------------------------------------------------------------


def _plain_repeats(rows, length):
    """rows: (order of the document, words); removed words by the definition."""
    first = {}
    for key, words in sorted(rows):
        for s in range(len(words) - length + 1):
            first.setdefault(tuple(words[s : s + length]), (key, s))
    out = {}
    for key, words in rows:
        gone = [False] * len(words)
        for s in range(len(words) - length + 1):
            if first[tuple(words[s : s + length])] < (key, s):
                gone[s : s + length] = [True] * length
        out[key] = [w for w, g in zip(words, gone) if not g]
    return out


def _passages(seed, length):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefghijklm", k=3))
    passage = [word() for _ in range(3 * length)]
    rows = []
    for i in range(90):
        words = [word() for _ in range(draw.choice((0, 3, length, 4 * length)))]
        for _ in range(draw.randint(0, 3)):  # parts of a common passage, around the length
            size = draw.choice((length - 1, length, length + 1, 2 * length, 3 * length))
            a, at = draw.randrange(3 * length - size + 1), draw.randint(0, len(words))
            words[at:at] = passage[a : a + size]
        rows.append((i, words))
    few = [word() for _ in range(4)]
    rows += [(100 + i, draw.choices(few, k=5 * length)) for i in range(10)]  # hardly any different words
    rows += [(120 + i, rows[3][1] + passage) for i in range(40)]  # exact copies
    rows += [(170, ["x"] * 300), (171, ["y", *["x"] * 40]), (172, ["x", "y"] * 60)]
    gaps = (" ", "\n", "\t", "\v\f ", "\r\n")
    return [(i, draw.choice(gaps).join(w)) for i, w in rows]


SLOTS = "doc_id bigint, text string, n_words string, doc int, f int, places int, c0 int, o0 int"


@pytest.mark.parametrize("length,seed", [(20, 8), (6, 3), (5, 5), (3, 1)])
def test_substring_repeats(spark, length, seed):
    rows = _passages(length, length) + [(180, None), (181, ""), (182, " \n "), (183, "a\x1cb \xa0 c"), (184, "x " * 70_000)]
    docs = spark.createDataFrame([(*r, "n", 1, 2, 3, 4, 5) for r in rows], SLOTS).repartition(4)
    found = substring.remove_repeats(docs, length=length, seed=seed).collect()
    plain = _plain_repeats([(i, WORD.findall(t or "")) for i, t in rows], length)
    own = {i: len(WORD.findall(t or "")) for i, t in rows}
    assert {r.doc_id: r.text for r in found} == {i: None if t is None else " ".join(plain[i]) for i, t in rows}
    assert {r.doc_id: (r.n_words, r.n_removed) for r in found} == {i: (own[i], own[i] - len(plain[i])) for i, _ in rows}
    assert found[0].asDict().keys() == {"doc_id", "text", "doc", "f", "places", "c0", "o0", "n_words", "n_removed"}
    assert found[0].o0 == 5 and found[0].c0 == 4


def test_repeated_and_missing_ids(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(1, f"{a} {b}"), (1, b), (1, b), (2, a), (None, c), (None, f"own {c}"), (3, c), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    hashes = {r.text: r.f for r in docs.select("text", F.xxhash64("text").alias("f")).collect()}
    keys = [((1 << 63) - 1 if i is None else i, hashes[t]) for i, t in rows]
    plain = _plain_repeats([(k, (t or "").split()) for k, (_, t) in dict(zip(keys, rows)).items()], 20)
    found = substring.remove_repeats(docs).collect()
    assert sorted(((r.doc_id, r.text) for r in found), key=str) == sorted(
        ((i, None if t is None else " ".join(plain[k])) for k, (i, t) in zip(keys, rows)), key=str
    )


def test_maximal_passages(spark):
    a = [f"w{k}" for k in range(50)]
    rows = [(1, " ".join(a)), (2, " ".join(["x", *a[:25], "y", *a[20:], "z", *a[:19]]))]
    found = substring.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r["first"], r.n) for r in found) == [(2, 1, 25), (2, 27, 30)]


def test_no_texts(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert substring.kept_digests(none).collect() == []
    empty = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    digest = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert sorted(tuple(r) for r in substring.kept_digests(empty).collect()) == [(1, 0, 0, digest), (2, 0, 0, digest)]


def test_least_of_windows():
    values = np.random.default_rng(2).integers(0, 9, 200)
    for width in (1, 2, 3, 7, 13, 16):
        expected = [s + int(np.argmin(values[s : s + width])) for s in range(200 - width + 1)]
        assert substring._least(values, width).tolist() == expected
