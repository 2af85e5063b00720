"""The training-data pipeline: documents in, packed sequences out.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next stage's documents.  All but the last return the columns they were given.  A stage decides on every document
that its predecessor kept, learns from those documents alone, and handles empty tables as its operator says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.functions.columns import unused_name
from quarrystone.llm import langid, linededup, ngram_join, packing, quality
from quarrystone.llm.common import table
from quarrystone.plans.scratch import written

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.kept(docs, model)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier does not recognise go."""
    return langid.recognised(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go from all documents but their home."""
    held = {c: unused_name(docs, f"held_{c}") for c in ("n_lines", "n_removed") if c in docs.columns}
    plain = linededup.remove_boilerplate(docs.withColumnsRenamed(held)).drop("n_lines", "n_removed")
    return plain.withColumnsRenamed({v: k for k, v in held.items()}).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar ones stays, the one with the smallest id.

    Rows that repeat an id, or have none, are judged each by its own text; of rows with the same id and text one stays.
    """
    repeated = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    if repeated.isEmpty():
        groups = ngram_join.similar_documents(docs)
        return docs.join(written(groups.where("not kept").select("doc_id")), "doc_id", "left_anti").select(*docs.columns)
    # A number of its own for each id and text; written, so that it stays the same.
    key, id_, hash_ = (unused_name(docs, n) for n in ("row_key", "row_id", "row_hash"))
    same = docs.select(F.col("doc_id").alias(id_), F.sha2("text", 256).alias(hash_)).distinct()
    numbers = written(same.withColumn(key, F.monotonically_increasing_id()))
    own = F.col("doc_id").eqNullSafe(F.col(id_)) & F.sha2("text", 256).eqNullSafe(F.col(hash_))
    keyed = docs.join(numbers, own).select(*docs.columns, key)
    groups = ngram_join.similar_documents(keyed, id_col=key).select(F.col("doc_id").alias(key), "class_id")
    least = F.min(F.struct(F.col(id_).isNull(), id_, key)).alias("least")
    first = written(groups.join(numbers, key).groupBy("class_id").agg(least).select(f"least.{key}"))
    one = F.min(F.struct(*docs.columns)).alias("one")
    return keyed.join(first, key, "left_semi").groupBy(key).agg(one).select("one.*").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

# Classifiers and hashes cannot be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; between them the table is written and read back."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
