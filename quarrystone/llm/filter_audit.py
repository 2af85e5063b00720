"""Audit of interacting filters by truth-table survival words.

A document that fails some of at most five filters survives exactly those subsets of the filters that hold none of
the ones it fails.  The 32 answers are one 32-bit word: bit S is set when the document passes every filter of subset S.
How many documents survive each subset is then a positional popcount of the words, taken per part and label by carry-save
adders: three words become a word of sums and a word of carries that weighs twice as much, until two words are
left at every weight.  Each task sends 32 counts for each part and label it meets, so a part with a third of all rows
is no hot key, and every question about every order of the filters is a difference of two of the summed counts.

The table-wide filter (a text that a smaller id has too) takes the least id of each text from a partial aggregation
over 256-bit hashes; only texts with several ids are joined back, so unique texts and hot ones cost one row each.

Defined results: a null text is an empty text; a null part is the empty string; an id that is null is smaller than none and
fails no comparison of ids; rows that repeat an id are a document each, and copies of one another only where another
row has the same text under a smaller id; of several label rows for an id any with the mark counts; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.scratch import written
from .common import dealt_join, ref, require, slices

MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 100, 80, 10
MOST_FILTERS = 5
REPEATED = "E"
LABELS = ("all", "good", "toxic")
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOLS = b"#$%&*|"


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the filters ask of each text."""
    for batch in batches:
        for some in slices(batch, 2):
            found: list[list] = [[], [], [], [], [], []]
            for text in some.column(2).to_pylist():
                data = (text or "").encode()
                words = data.split()  # at blanks and the control characters from tab to carriage return
                found[0].append(len(words))
                found[1].append(len(set(words)))
                found[2].append(len(data) - len(data.translate(None, _CAPITALS)))
                found[3].append(len(text or ""))
                found[4].append(len(data) - len(data.translate(None, _SYMBOLS)))
                found[5].append(hashlib.sha256(data).digest())
            counts = [pa.array(f, pa.int64()) for f in found[:5]]
            yield pa.RecordBatch.from_arrays(
                [some.column(0), some.column(1), *counts, pa.array(found[5], pa.binary())],
                ["doc", "part", "words", "distinct", "capitals", "points", "symbols", "hash"],
            )


def text_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """doc, part, and of each whole text: words, distinct words, capitals A-Z, code points, symbols and a 256-bit hash."""
    require(docs, id_col, text_col, part_col)
    part = F.coalesce(ref(part_col).cast("string"), F.lit(""))
    rows = docs.select(ref(id_col).alias("doc"), part.alias("part"), ref(text_col).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    counts = ", ".join(f"{c} bigint" for c in ("words", "distinct", "capitals", "points", "symbols"))
    return rows.mapInArrow(_measured, f"doc {kind}, part string, {counts}, hash binary")


def text_filters() -> dict[str, Column]:
    """The conditions on the measures under which the text alone fails, by letter."""
    return {
        "A": F.col("words") < MIN_WORDS,
        "B": 100 * F.col("distinct") < DISTINCT_PERCENT * F.col("words"),
        "C": 100 * F.col("capitals") > CAPITAL_PERCENT * F.col("points"),
        "D": F.col("symbols") > 0,
    }


def failures(measures: DataFrame, filters: Mapping[str, Column] | None = None) -> DataFrame:
    """doc, part and mask: bit k is set when the document fails the k-th filter; the last filter is the repeated text."""
    filters = text_filters() if filters is None else filters
    if not 1 <= len(filters) < MOST_FILTERS:
        raise ValueError(f"Between one and {MOST_FILTERS - 1} filters besides the repeated text")
    mask = F.lit(0)
    for k, fails in enumerate(filters.values()):
        mask = mask.bitwiseOR(F.when(fails, 1 << k).otherwise(0))
    rows = measures.select("doc", "part", mask.alias("mask"), "hash")
    ids = rows.groupBy("hash").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    shared = ids.where("least < most").select("hash", "least")
    again = F.when(F.col("doc") > F.col("least"), 1 << len(filters)).otherwise(0)
    return dealt_join(rows, shared, ["hash"], "left").select("doc", "part", F.col("mask").bitwiseOR(again).alias("mask"))


def survival_words(filters: int) -> np.ndarray:
    """For each set of failed filters the word of the subsets that a document with it survives."""
    sets = np.arange(1 << filters, dtype=np.uint32)
    passes = (sets[:, None] & sets) == 0
    return (passes.astype(np.uint64) << sets.astype(np.uint64)).sum(1).astype(np.uint32)


def positional_popcounts(words: np.ndarray) -> np.ndarray:
    """How many of the words have each of the 32 bits set, by carry-save adders."""
    counts, weight, bits = np.zeros(32, np.int64), 1, np.arange(32, dtype=np.uint32)
    while len(words):
        carries = [np.zeros(0, np.uint32)]
        while len(words) > 2:
            third = len(words) // 3
            a, b, c, rest = words[:third], words[third : 2 * third], words[2 * third : 3 * third], words[3 * third :]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate([half ^ c, rest])
        counts += weight * ((words[:, None] >> bits) & np.uint32(1)).sum(0, dtype=np.int64)
        words, weight = np.concatenate(carries), 2 * weight
    return counts


def _tally(filters: int):
    """Counts by part, label and subset of the rows (part, good, toxic, mask) of a task."""
    word_of = survival_words(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            parts = batch.column(0).dictionary_encode()
            code = parts.indices.to_numpy()
            good, toxic = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            words = word_of[batch.column(3).to_numpy()]
            for k, part in enumerate(parts.dictionary.to_pylist()):
                own = code == k
                counts = [positional_popcounts(words[some]) for some in (own, own & good, own & toxic)]
                totals[part] = totals.get(part, 0) + np.stack(counts)
                if len(totals) >= 4096:  # any number of parts in bounded memory
                    yield _rows(totals)
                    totals = {}
        if totals:
            yield _rows(totals)

    return run


def _rows(totals: dict[str, np.ndarray]) -> pa.RecordBatch:
    flat = np.stack(list(totals.values())).reshape(-1)
    lists = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, 32, dtype=np.int32), pa.array(flat))
    names = [part for part in totals for _ in LABELS]
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array(list(LABELS) * len(totals)), lists], ["part", "label", "survivors"]
    )


def subset_survivors(failed: DataFrame, labels: DataFrame | None, filters: int = MOST_FILTERS) -> DataFrame:
    """part, label (all, good, toxic), subset (bits of its filters) and survivors: the documents that pass the subset.

    ``failed`` has doc, part and mask; ``labels`` has doc, good and toxic.
    """
    none = F.lit(False)
    if labels is None:
        marked = failed.select("part", none.alias("good"), none.alias("toxic"), "mask")
    else:
        marks = labels.groupBy("doc").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
        some = marks.where("doc is not null and (good or toxic)")
        marked = failed.join(some, "doc", "left").select(
            "part", F.coalesce("good", none).alias("good"), F.coalesce("toxic", none).alias("toxic"), "mask"
        )
    counted = marked.mapInArrow(_tally(filters), "part string, label string, survivors array<bigint>")
    each = counted.select("part", "label", F.posexplode("survivors").alias("subset", "n")).where(
        F.col("subset") < (1 << filters)
    )
    return each.groupBy("part", "label", "subset").agg(F.sum("n").alias("survivors"))


def _plan(names: str) -> list[tuple]:
    """Every step of every order: the subsets before and after it, its filter alone, and all but it."""
    every, steps = (1 << len(names)) - 1, []
    for order in itertools.permutations(names):
        before = 0
        for step, letter in enumerate(order, 1):
            own = 1 << names.index(letter)
            steps.append(("".join(order), step, own, before, before | own, every & ~own))
            before |= own
    return steps


def audit(survivors: DataFrame, names: str = "ABCDE") -> DataFrame:
    """One row per part, order of the filters and step, from the counts of ``subset_survivors``."""
    fields = ("filter_order", "step", "own", "before", "after", "others")
    kinds = "array<struct<filter_order string, step int, own int, before int, after int, others int>>"
    steps = F.from_json(F.lit(json.dumps([dict(zip(fields, s)) for s in _plan(names)])), kinds)
    pick = lambda label: F.sum(F.when(F.col("label") == label, F.col("survivors")))
    by_subset = survivors.groupBy("part", "subset").agg(*[pick(label).alias(label) for label in LABELS])
    # 32 entries for each part, in the order of the subsets
    tables = by_subset.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("subset", *LABELS))).alias("t"))
    at = lambda subset, label: F.element_at("t", subset + 1)[label]
    lost = lambda label: at(F.col("before"), label) - at(F.col("after"), label)
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    rows = tables.select("part", "t", F.inline(steps)).select(
        "part", "filter_order", "step", letter.alias("letter"),
        at(F.col("after"), "all").alias("kept"),
        lost("all").alias("removed"),
        (at(F.lit(0), "all") - at(F.col("own"), "all") - lost("all")).alias("redundant"),
        (at(F.col("others"), "all") - at(F.lit((1 << len(names)) - 1), "all")).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
    )
    share = F.sum("removed").over(Window.partitionBy("part", "letter"))  # one row an order
    return rows.withColumn("shapley", share).drop("letter")


def filter_audit(
    docs: DataFrame,
    labels: DataFrame | None,
    filters: Mapping[str, Column] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """All orders of the given filters (by letter) and of the repeated text; see the module's text.

    ``filters`` are conditions on the columns of ``text_measures``; ``labels`` has the id, quality (1: good) and toxic (1).
    """
    failed = failures(written(text_measures(docs, id_col, text_col, part_col)), filters)
    names = "".join("ABCD" if filters is None else filters) + REPEATED
    if len(set(names)) < len(names) or len(names) > MOST_FILTERS:
        raise ValueError(f"Filters need one letter each, other than {REPEATED}")
    marks = None
    if labels is not None:
        require(labels, id_col, "quality", "toxic")
        marks = labels.select(
            ref(id_col).alias("doc"),
            F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"),
            F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"),
        )
    return audit(subset_survivors(failed, marks, len(names)), names)


SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), l AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
           max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), f AS (
    SELECT doc_id, part, [
        len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
        100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
        regexp_matches(text, '[#$%&*|]'),
        coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails FROM d
), docs AS (
    SELECT part, fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM f LEFT JOIN l USING (doc_id)
), masks AS (
    SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM docs GROUP BY ALL
), orders(o) AS (
    SELECT '' UNION ALL SELECT o || c FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c) WHERE NOT contains(o, c)
), steps AS (
    SELECT o AS filter_order, s AS step, ascii(o[s]) - 64 AS own, o[:s - 1] AS before FROM orders, range(1, 6) AS r(s)
    WHERE length(o) = 5
), each AS (
    SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS fail,
           len([x FOR x IN [1, 2, 3, 4, 5] IF fails[x] AND contains(before, chr(64 + x))]) > 0 AS gone,
           len([x FOR x IN fails IF x]) AS failed FROM masks, steps
), report AS (
    SELECT part, filter_order, step, own,
           coalesce(sum(n) FILTER (NOT fail AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (fail AND NOT gone), 0) AS removed,
           coalesce(sum(n) FILTER (fail AND gone), 0) AS redundant, coalesce(sum(n) FILTER (fail AND failed = 1), 0) AS unique_fails,
           coalesce(sum(good) FILTER (fail AND NOT gone), 0) AS good_lost,
           coalesce(sum(toxic) FILTER (fail AND NOT gone), 0) AS toxic_lost
    FROM each GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM report
"""
