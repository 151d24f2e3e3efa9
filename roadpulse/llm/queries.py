"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, embedding_dedup, language_id, license_scan, line_dedup, mixture_packing, packing, pii, quality,
               simhash, spelling, substring_dedup, token_alignment)
from ._util import table


def op1_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(table(spark, sf_dir, "embeddings"), cosine=0.93)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"), min_words=50)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_50k.json"),
                                  public_tokenizers.PATTERN, capacity=2048)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(table(spark, sf_dir, "documents"),
                                public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                public_tokenizers.PATTERN)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", "text")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return spelling.variants(spelling.vocabulary(docs, min_length=7, min_count=2), dominance=10)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_documents(table(spark, sf_dir, "documents"),
                                           public_tokenizers.path("byte_bpe_50k.json"),
                                           public_tokenizers.path("piece_bpe_32k.model"))


def op13_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture_packing.pack_mixture(table(spark, sf_dir, "documents"),
                                        public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


QUERIES = {f.__name__: f for f in (
    op1_rp_forest, op2_license_scan, op3_simhash, op4_substring, op5_packing, op6_pii, op7_bpe, op8_line_dedup, op9_quality, op10_language,
    op11_spelling_variants, op12_token_alignment, op13_mixture_packing)}
#: DuckDB SQL of the queries that SQL can express
ORACLE_SQL = {"op1_rp_forest": embedding_dedup.oracle_sql(), "op8_line_dedup": line_dedup.oracle_sql(),
              "op9_quality": quality.oracle_sql()}
