"""Removal of boilerplate lines: those that stand on many sites.

How many sites a line is on is a HyperLogLog sketch per line hash, merged by aggregation, so a line
that a third of all documents hold leaves each task as one row.  Lines whose estimate lies near the
threshold get an exact distinct count; clear cases do not.  A boilerplate line goes from every
document but its home, the document with the smallest id that holds it, so that no passage is lost
altogether.

Lines are compared trimmed of blanks and in lower case.  Spread alone decides: every line counts that is not
white space only, however short and in any script.  A line repeated inside documents of a few sites only is no
boilerplate.

Defined results: a null text comes back null with 0 lines, an empty text has one empty line; a null site
is one site of its own; rows that repeat a document id are cleaned each, by the same lines; a document
whose lines all go has an empty text; an empty table gives no rows; other columns are kept by
``remove_boilerplate`` and ignored by the query, and those named n_lines or n_removed are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import written
from .common import ref, require

MIN_SITES = 10
# A character that is not a blank or a control character from tab to carriage return.
_VISIBLE = r"[^\x09-\x0D\x20]"
# 2**LG_K buckets a sketch: a standard error of 3.3 %, so the band below is over ten of them wide.
LG_K = 10
NEAR = (0.6, 1.4)

SQL = f"""
WITH lines AS (
    SELECT doc_id, source, line, pos, lower(trim(line, ' ')) AS norm
    FROM (SELECT doc_id, coalesce(source, '') AS source, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)
), boilerplate AS (
    SELECT norm, min(doc_id) AS home FROM lines
    WHERE regexp_matches(norm, '{_VISIBLE}')
    GROUP BY norm HAVING count(DISTINCT source) >= {MIN_SITES}
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE home IS NULL OR home = doc_id), '') AS text,
       CAST(count(*) AS INTEGER) AS n_lines,
       CAST(count(*) FILTER (WHERE home IS NOT NULL AND home <> doc_id) AS INTEGER) AS n_removed
FROM lines LEFT JOIN boilerplate USING (norm) GROUP BY doc_id
"""


def _norm(line: Column) -> Column:
    return F.lower(F.trim(line))


def _lines(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """doc, site and hash of each line with something in it."""
    parts = docs.select(
        ref(id_col).alias("doc"),
        F.coalesce(ref(site_col).cast("string"), F.lit("")).alias("site"),
        F.explode(F.split(ref(text_col), "\n")).alias("line"),
    )
    norm = parts.select("doc", "site", _norm(F.col("line")).alias("norm")).where(F.col("norm").rlike(_VISIBLE))
    return norm.select("doc", "site", F.xxhash64("norm").alias("hash"))


def boilerplate(
    docs: DataFrame, id_col: str, text_col: str, site_col: str, min_sites: int = MIN_SITES
) -> DataFrame:
    """hash and home of the lines on at least ``min_sites`` sites; written, so it is worked out once."""
    lines = _lines(docs, id_col, text_col, site_col)
    spread = lines.groupBy("hash").agg(F.hll_sketch_agg("site", LG_K).alias("sketch"), F.min("doc").alias("home"))
    wide = written(
        spread.select("hash", "home", F.hll_sketch_estimate("sketch").alias("sites")).where(
            F.col("sites") >= NEAR[0] * min_sites
        )
    )
    near = wide.where(F.col("sites") <= NEAR[1] * min_sites)
    pairs = lines.select("hash", "site").join(near.select("hash"), "hash", "left_semi").distinct()
    exact = pairs.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") >= min_sites)
    sure = wide.where(F.col("sites") > NEAR[1] * min_sites)
    return written(
        sure.select("hash", "home").unionByName(near.join(exact, "hash", "left_semi").select("hash", "home"))
    )


def remove_boilerplate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
) -> DataFrame:
    """The documents with cleaned text, and n_lines and n_removed beside it."""
    require(docs, id_col, text_col, site_col)
    found = boilerplate(docs, id_col, text_col, site_col, min_sites)
    hits = _lines(docs, id_col, text_col, site_col).select("doc", "hash").join(found, "hash")
    gone = hits.where(F.col("doc") != F.col("home")).groupBy("doc").agg(F.collect_set("hash").alias("gone"))
    # The table's own columns travel under numbers, so that no name of theirs can clash.
    rest = [c for c in docs.columns if c not in (text_col, "n_lines", "n_removed")]
    slots = {c: f"c{k}" for k, c in enumerate(rest)}
    own = docs.select(ref(text_col).alias("text"), *[ref(c).alias(slots[c]) for c in rest])
    joined = own.join(gone, F.col(slots[id_col]) == F.col("doc"), "left")
    parts = F.split("text", "\n")
    goes = lambda line: _norm(line).rlike(_VISIBLE) & F.array_contains("gone", F.xxhash64(_norm(line)))
    kept = F.when(F.col("gone").isNull(), parts).otherwise(F.filter(parts, lambda line: ~goes(line)))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(parts))
    n_kept = F.when(F.col("text").isNull(), 0).otherwise(F.size(kept))
    cleaned = joined.select(
        F.array_join(kept, "\n").alias("text"),
        n_lines.alias("n_lines"),
        (n_lines - n_kept).alias("n_removed"),
        *slots.values(),
    )
    columns = {text_col: F.col("text"), **{c: F.col(slots[c]) for c in rest}}
    own_columns = [columns[c].alias(c) for c in docs.columns if c in columns]
    return cleaned.select(*own_columns, F.col("n_lines").alias("n_lines"), F.col("n_removed").alias("n_removed"))
