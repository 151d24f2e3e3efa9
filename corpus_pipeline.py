"""The corpus pipeline: quality rules, line and document deduplication, personal data, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage
before it kept. All but the last return the columns of ``documents``; ``n_chars``
follows the text where a stage changes it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import line_dedup, packing, pii, quality, simhash
from roadpulse.llm._util import known_to_workers
from roadpulse.session import release, scratch_path

SHINGLE, MAX_BITS = 4, 4
CAPACITY = 2048


def _recount(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null and empty texts go. Null ids, null languages, repeated rows and further columns
    pass; rows of equal text and language are judged alike.
    """
    return quality.keep_good(docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without recurring lines; of texts that consist of the same ones one keeps them.

    Null texts stay null. Rows that repeat id and text are cut alike; other columns pass.
    """
    return _recount(line_dedup.without_boilerplate(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    A row without an id stays only where its group has no id at all; of rows that
    repeat one id or have none, each group keeps one.
    """
    known_to_workers(spark)
    return simhash.one_per_component(docs, SHINGLE, MAX_BITS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind; null texts stay null."""
    known_to_workers(spark)
    return _recount(pii.redact(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' pieces in sequences of ``CAPACITY`` tokens.

    Null and empty texts are a separator; null and repeated ids keep their rows.
    """
    known_to_workers(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"),
                                  public_tokenizers.PATTERN, CAPACITY)


STAGES = [("quality", quality_rules), ("lines", drop_lines), ("copies", drop_copies),
          ("personal_data", redact_personal_data), ("packing", pack_sequences)]

#: SQL expresses neither the trained tagger nor the tokenizer; the tests hold run() against its stages, one by
#: one, and these against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each written to the shared folder and read again.

    A stage's table is deleted once the next one is written; the last one stays.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline", name)
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            release(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
