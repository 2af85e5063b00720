"""Every operator of this subpackage over its whole table, under the names opN_<name>."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    filter_audit,
    langid,
    linededup,
    ngram_join,
    packing,
    pieces,
    quality,
    quotes,
    substring,
    token_files,
    topk,
    vector_join,
    whitening,
)
from .common import table
from .registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES"]

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


@query("op3_token_files")
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), BYTE_BPE)


@query("op10_pattern_packing")
def op10_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE)


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op6_quality_pu")
def op6_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query("op9_line_spread", linededup.SQL)
def op9_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return linededup.remove_boilerplate(docs).drop("source")


@query("op1_ngram_join")
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


@query("op2_vector_join")
def op2_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.similar_vectors(table(spark, sf_dir, "embeddings"))


@query("op7_exact_top_k")
def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), evaluated=True)


@query("op8_unigram_pieces")
def op8_unigram_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digests(table(spark, sf_dir, "documents"), PIECE_BPE)


@query("op4_quotation_links")
def op4_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotations(table(spark, sf_dir, "conversations"))


@query("op11_filter_audit", filter_audit.SQL)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"))


@query("op13_substring_repeats")
def op13_substring_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.kept_digests(table(spark, sf_dir, "documents"))
