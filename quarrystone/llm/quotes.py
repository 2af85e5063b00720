"""Quotation linking: which message a message replies to, by the passages it quotes.

A line's quote level is the number of ``>`` marks it starts with.  Lines of one level in a row, cut at blank lines, are
a passage; a passage and each of its lines are normalised (white space squeezed, lower case) and hashed.
What a message writes itself (level 0) is original text; the earliest message of a conversation that holds a
hash is its origin.  A quoted hash links to its origin if that is an earlier turn.  The parent of a message
is the latest origin among its links of the lowest quote level that has any.

Conversations come back in reply order: by the turn that began the thread, then by turn, so that a reply
follows what it replies to.  Quoted lines, and a line that only introduces a quotation ("... wrote:"), are gone from
the text.

Defined results: a null text stays null and links with nothing; a message without a link begins a thread of its own; rows
with a null conversation or turn come back unlinked, first; messages that repeat a turn are one for linking (the
latest of their parents) and come back each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import written
from .common import ref, require

_MARKS = re.compile(r"[ \t]*(?:>[ \t]?)+")
_INTRODUCES = re.compile(r"\S.*\bwrote:\s*$")


def parse(text: str) -> tuple[str, list[tuple[int, str]]]:
    """The text without quotations, and (level, normalised passage or line) of all of it."""
    passages: list[tuple[int, list[str]]] = []
    own: list[str] = []
    lines = text.split("\n")
    levels, bodies = [], []
    for line in lines:
        marks = _MARKS.match(line)
        levels.append(marks.group().count(">") if marks else 0)
        bodies.append(line[marks.end() :] if marks else line)
    level_before = None
    for k, (level, body) in enumerate(zip(levels, bodies)):
        introduces = level == 0 and k + 1 < len(lines) and levels[k + 1] > 0 and _INTRODUCES.match(body)
        if level == 0 and not introduces:
            own.append(body)
        if introduces or not body.strip():
            level_before = None
            continue
        if level != level_before:
            passages.append((level, []))
        passages[-1][1].append(body)
        level_before = level
    found = []
    for level, part in passages:
        found += [(level, " ".join(p.split()).lower()) for p in ["\n".join(part), *(part if len(part) > 1 else [])]]
    return "\n".join(own).strip("\n") if any(levels) else text, found


def _hash(passage: str) -> int:
    return xxhash.xxh64_intdigest(passage) - (1 << 63)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, levels, hashes = [], [], []
        for text in batch.column(3).to_pylist():
            clean, found = (None, []) if text is None else parse(text)
            texts.append(clean)
            levels.append([level for level, _ in found])
            hashes.append([_hash(p) for _, p in found])
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:3], pa.array(texts, pa.string()), pa.array(levels, pa.list_(pa.int32())),
                pa.array(hashes, pa.list_(pa.int64())),
            ],
            ["conv_id", "turn", "role", "text", "levels", "hashes"],
        )


def _roots(parents: DataFrame) -> DataFrame:
    """conv_id, turn, parent, thread, depth of linked messages: every round doubles how far a row sees up."""
    seen = written(parents.withColumn("thread", F.col("parent")).withColumn("depth", F.lit(1).cast("bigint")))
    while True:
        up = seen.select(
            "conv_id", F.col("turn").alias("thread"), F.col("thread").alias("higher"), F.col("depth").alias("more")
        )
        joined = seen.join(up, ["conv_id", "thread"], "left")
        seen = written(
            joined.select(
                "conv_id", "turn", "parent", F.coalesce("higher", "thread").alias("thread"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("higher").isNotNull().alias("moved"),
            )
        )
        if seen.where("moved").isEmpty():
            return seen.drop("moved")
        seen = seen.drop("moved")


def link_quotations(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv_id, turn, role, text, n_quoted, n_linked, parent_turn, thread_turn, depth in reply order."""
    require(messages, conv_col, turn_col, role_col, text_col)
    own = messages.select(
        ref(conv_col).cast("bigint").alias("conv_id"), ref(turn_col).cast("bigint").alias("turn"),
        ref(role_col).cast("string").alias("role"), ref(text_col).alias("text"),
    )
    parsed = written(
        own.mapInArrow(
            _parsed, "conv_id bigint, turn bigint, role string, text string, levels array<int>, hashes array<bigint>"
        )
    )
    pairs = parsed.where("conv_id is not null and turn is not null").select(
        "conv_id", "turn", F.explode(F.arrays_zip("levels", "hashes")).alias("p")
    )
    passages = pairs.select("conv_id", "turn", F.col("p.levels").alias("level"), F.col("p.hashes").alias("hash"))
    quoted = passages.where("level > 0").groupBy("conv_id", "turn", "hash").agg(F.min("level").alias("level"))
    wanted = quoted.select("conv_id", "hash").distinct()
    # Only what is quoted somewhere in its conversation is looked up.
    origins = (
        passages.where("level = 0").join(wanted, ["conv_id", "hash"], "left_semi")
        .groupBy("conv_id", "hash").agg(F.min("turn").alias("origin"))
    )
    links = quoted.join(origins, ["conv_id", "hash"]).where("origin < turn")
    # The least level first, then the latest origin.
    best = links.groupBy("conv_id", "turn").agg(
        F.max(F.struct((-F.col("level")).alias("l"), "origin")).alias("b"), F.count("*").alias("n_linked")
    )
    parents = written(best.select("conv_id", "turn", F.col("b.origin").alias("parent"), "n_linked"))
    threads = _roots(parents.drop("n_linked")).join(parents.drop("parent"), ["conv_id", "turn"])
    full = parsed.join(threads, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "text",
        F.size(F.filter("levels", lambda level: level > 0)).cast("bigint").alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"), F.col("parent").alias("parent_turn"),
        F.coalesce("thread", "turn").alias("thread_turn"), F.coalesce("depth", F.lit(0)).alias("depth"),
    )
    order = ["conv_id", "thread_turn", "turn"]
    return full.repartitionByRange(*order).sortWithinPartitions(*order)
