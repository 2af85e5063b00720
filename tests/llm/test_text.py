"""Classifiers by held-out accuracy, line removal and quotations against plain Python, and the pipeline."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarrystone.llm import langid, linededup, packing, quality, quotes
from quarrystone.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _documents(spark):
    return spark.read.parquet(f"{TABLES}/documents.parquet")


def test_languages_of_held_out_documents(spark):
    docs = _documents(spark)
    odd = spark.createDataFrame(
        [(-1, None, "en", "s", 0), (-2, "", "en", "s", 0), (-3, "12 !? \n", "en", "s", 0), (-4, "the of and " * 90_000, None, "s", 0),
         (-5, "the thing", "en", "s", 0), (-5, "the thing", "en", "s", 0)], DOCS)
    rows = langid.identify(docs.union(odd)).collect()
    langs = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in rows if r.held_out and r.doc_id >= 0]
    assert len(held) > 200
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.99
    assert np.mean([r.rejected for r in held]) < 0.01
    assert all(0 <= r.score <= 1 for r in rows)
    own = {r.doc_id: r for r in rows if r.doc_id < 0}
    assert {own[i].lang_pred for i in (-1, -2, -3)} == {"und"} and own[-1].rejected
    assert own[-4].lang_pred == "en"
    assert len(rows) == docs.count() + 6


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], DOCS)
    assert langid.identify(none).collect() == []
    assert langid.recognised(none).collect() == []
    unlabelled = spark.createDataFrame([(1, "a text", None, "s", 1), (2, "12", None, "s", 1)], DOCS)
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}
    assert [r.doc_id for r in langid.recognised(unlabelled).collect()] == [1]
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality.fit(none, labels) is None
    assert {r.score for r in quality.score(unlabelled, quality.fit(unlabelled, labels)).collect()} == {0.5}
    assert quality.kept(unlabelled, None).count() == 2


def test_windows_do_not_reach_over_texts_or_chunks(monkeypatch):
    import pyarrow as pa

    texts = pa.array(["the cat", "sat", "", None, "ünder the Mat", "a"])
    rows = np.random.default_rng(0).normal(size=(langid.BUCKETS + 1, 3)).astype(np.float32)
    rows[-1] = 0
    alone = [langid.score_sums(texts.slice(i, 1), rows)[0] for i in range(len(texts))]
    assert np.allclose(langid.score_sums(texts, rows), alone, atol=1e-4)
    counted = [(rows[b] * c[:, None]).sum(0) for b, c in langid.bucket_counts(texts)]
    assert np.allclose(counted, alone, atol=1e-4)
    monkeypatch.setattr(langid, "CHUNK", 3)
    assert np.allclose(langid.score_sums(texts, rows), alone, atol=1e-4)


def test_quality_of_held_out_documents(spark):
    docs, labels = _documents(spark), spark.read.parquet(f"{TABLES}/labels.parquet")
    odd = spark.createDataFrame([(-1, None, "en", "s", 0), (-2, "", "en", "s", 0), (-3, "word " * 90_000, "en", "s", 0)], DOCS)
    more = spark.createDataFrame([(0, None, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.fit(docs, labels.union(more))
    rows = {r.doc_id: r for r in quality.score(docs.union(odd), model).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [i for i in truth if rows[i].held_out]
    good, bad = ([rows[i].score for i in held if truth[i] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.98
    assert np.mean([rows[i].predicted == truth[i] for i in held]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    assert rows[-1].score == rows[-2].score
    kept = {r.doc_id for r in quality.kept(docs, model).collect()}
    assert kept == {i for i, r in rows.items() if i >= 0 and r.predicted == 1}


def test_prior_is_recovered():
    rng = np.random.default_rng(0)
    positive = rng.normal(3, 1, 3000)
    unlabelled = np.concatenate([rng.normal(3, 1, 2100), rng.normal(-3, 1, 900)])
    assert quality.estimate_prior(positive, unlabelled) == pytest.approx(0.7, abs=0.05)


def _plain_lines(rows, min_sites):
    sites, homes = {}, {}
    for i, text, site in rows:
        for line in (text or "").split("\n") if text is not None else []:
            norm = line.strip(" ").lower()
            if norm.strip("\t\n\v\f\r "):
                sites.setdefault(norm, set()).add(site or "")
                homes[norm] = min(homes.get(norm, i), i)
    out = []
    for i, text, _ in rows:
        lines = [] if text is None else text.split("\n")
        gone = lambda x: len(sites.get(x, ())) >= min_sites and homes[x] != i
        kept = [x for x in lines if not gone(x.strip(" ").lower())]
        out.append((i, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_boilerplate_lines(spark):
    wide, edge, under = "all rights reserved by us", "The edge of ten sites here", "only nine sites have this one"
    rows = [(i, f"own text of document {i}\n{wide}\nok\nok", f"s{i % 40}") for i in range(200)]
    rows += [(300 + i, f" {edge.upper()} \n", f"s{i}") for i in range(10)]
    rows += [(400 + i, f"{under}\n\n{under}", f"s{i % 9}") for i in range(60)]
    rows += [(500, None, "s1"), (501, "", None), (502, wide, None), (503, edge, "s0"), (503, edge, "s0")]
    rows += [(504, "long line " * 20_000 + "\n" + wide, "s3")]
    found = linededup.remove_boilerplate(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in found.collect()), key=str)
    assert got == _plain_lines(rows, linededup.MIN_SITES)
    none = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert linededup.remove_boilerplate(none).collect() == []
    clash = spark.createDataFrame(rows[:220], "doc_id bigint, text string, source string")
    for name in ("n_lines", "n_removed", "doc", "gone", "hash", "c0", "__doc", "__drop"):
        clash = clash.withColumn(name, F.lit("x"))
    again = sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in linededup.remove_boilerplate(clash).collect()), key=str)
    assert again == _plain_lines(rows[:220], linededup.MIN_SITES)


def test_spread_alone_decides(spark):
    lines = ["All rights reserved.", "home\tabout\tcontact", "版权所有不得转载", "-", "\t "]
    rows = [(i, "\n".join([f"text {i}", *lines]), f"s{i}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.doc_id: (r.text, r.n_removed) for r in linededup.remove_boilerplate(docs).collect()}
    assert got[0] == (rows[0][1], 0)
    assert all(got[i] == (f"text {i}\n\t ", 4) for i in range(1, 20))


def test_pipeline_lines_go_by_spread_alone(spark):
    short, unspaced, tabbed = "All rights reserved.", "版权所有不得转载", "home\tabout\tcontact"
    wide = [short, unspaced, tabbed, "ok"]
    rows = [(i, "\n".join([f"own {i}", "", *wide, "\t", "near"]), "en", f"s{i % 10}", 1) for i in range(30)]
    rows += [(100 + i, "Nine sites\nnear", "en", f"s{i % 9}", 1) for i in range(30)]
    rows += [(200, None, "en", "s1", 1), (201, f" {short.upper()} ", "en", None, 1)]
    found = {r.doc_id: r.text for r in corpus_pipeline.line_stage(spark, spark.createDataFrame(rows, DOCS), TABLES).collect()}
    assert found[0] == rows[0][1]
    assert all(found[i] == f"own {i}\n\n\t" for i in range(1, 30))
    assert all(found[i] == "Nine sites" for i in range(100, 130))
    assert found[200] is None and found[201] == ""


MESSAGES = "conv_id bigint, turn bigint, role string, text string, depth string"


def test_quotations(spark):
    first, second = "What is the plan?\nTell me  soon.", "We go\nat dawn.\n\nBring rope."
    rows = [
        (1, 0, "user", first, ""),
        (1, 1, "assistant", second, ""),
        (1, 2, "user", "> What is the plan?\n> Tell me soon.\nA late answer.", ""),
        (1, 3, "user", "Ann wrote:\n> we go at DAWN.\n>> Tell me soon.\nWhy?", ""),
        (1, 4, "user", "> > We go\n> > at dawn.\n> Why?\nBecause.", ""),
        (1, 5, "user", "> nobody said this\nhm", ""),
        (2, 0, "user", "> Bring rope.\nAnother conversation.", ""),
        (2, 1, "user", None, ""), (2, 1, "user", "", ""), (2, 2, "user", "> 5 > 4\nx", ""),
        (None, 1, "user", "> a", ""), (3, None, "user", "a", ""),
    ]
    found = quotes.link_quotations(spark.createDataFrame(rows, MESSAGES).repartition(3)).collect()
    by = {(r.conv_id, r.turn): r for r in found if r.conv_id == 1}
    assert {k[1]: (r.parent_turn, r.thread_turn, r.depth) for k, r in by.items()} == {
        0: (None, 0, 0), 1: (None, 1, 0), 2: (0, 0, 1), 3: (1, 1, 1), 4: (3, 1, 2), 5: (None, 5, 0)
    }
    assert [r.turn for r in found if r.conv_id == 1] == [0, 2, 1, 3, 4, 5]
    assert by[1, 3].text == "Why?" and by[1, 2].text == "A late answer."
    rest = [(r.conv_id, r.turn, r.parent_turn, r.text) for r in found if r.conv_id != 1]
    assert sorted(rest, key=str) == sorted(
        [(2, 0, None, "Another conversation."), (2, 1, None, None), (2, 1, None, ""), (2, 2, None, "x"), (None, 1, None, ""),
         (3, None, None, "a")], key=str)
    assert quotes.link_quotations(spark.createDataFrame([], MESSAGES)).collect() == []


def test_long_reply_chain(spark):
    rows = [(9, 0, "user", "start 0", "")] + [(9, i, "user", f"> start {i - 1}\nstart {i}", "") for i in range(1, 30)]
    found = quotes.link_quotations(spark.createDataFrame(rows, MESSAGES)).collect()
    assert [(r.turn, r.parent_turn, r.thread_turn, r.depth) for r in found][1:] == [(i, i - 1, 0, i) for i in range(1, 30)]


def test_pipeline_stages(spark):
    docs = _documents(spark)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, TABLES).persist()
        assert after.columns == columns, name
        before = docs.count()
        assert 0.8 * before <= after.count() <= before, name
        if name != "lines":
            assert after.exceptAll(docs).count() == 0, name
        else:
            assert after.count() == before
        docs = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, TABLES)
    assert pieces.select("doc_id").distinct().count() == docs.count()
    assert pieces.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= packing.CAPACITY


def test_pipeline_judges_rows_that_repeat_an_id(spark):
    words = [f"word{k}" for k in range(120)]
    base, near, other = " ".join(words), " ".join([*words[:119], "end"]), " ".join(reversed(words))
    rows = [(1, base, "en", "s1", 1), (2, near, "en", "s2", 1), (2, other, "en", "s2", 1)]
    rows += [(3, "alone " * 9, "en", "s3", 1)] * 2 + [(4, base, "en", "s4", 1), (5, None, "en", "s5", 1), (6, "", "en", "s6", 1)]
    rows += [(7, "twice " * 9, "en", "s8", 1), (7, "twice " * 9, "en", "s7", 1), (None, near, "en", "s9", 1)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    found = corpus_pipeline.near_duplicate_stage(spark, docs, TABLES).collect()
    assert sorted(tuple(r) for r in found) == [rows[0], rows[2], rows[3], rows[6], rows[7], rows[9]]


def test_pipeline_of_an_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, TABLES).collect() == []


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
