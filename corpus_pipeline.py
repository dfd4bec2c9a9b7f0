"""The corpus pipeline: documents to packed training sequences, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; its result is
written as Parquet and read again. All but the last return the columns of ``documents``. Rows with nulls
pass through: a null id is never a copy of another document, a null text is no language and is
rejected by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontaminate, language, ngram_join, packing, secrets
from tidemark.llm.common import stored, table
from tidemark.llm.queries import prepare

# SQL cannot express the stages; tests/llm/test_pipeline.py holds them against brute force.
ORACLE_SQL = None

# A text costs more bits a byte than this only if none of the learned languages explains it. Measured on sf0.01: documents
# cost 1.4 to 3.0; other languages from 8 up, hexadecimal 10, random letters 17, program text 20.
MAX_BITS = 6.0


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents in no language: without a letter, or unlike all learned languages. A missing
    ``lang`` is filled in."""
    prepare(spark)
    found = language.with_language(docs, language.train(docs))
    known = (F.col("_language.lang") != language.UNKNOWN) & (F.col("_language.bits") <= MAX_BITS)
    return found.filter(known).withColumn("lang", F.coalesce("lang", "_language.lang")).select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, stays of each group of near-duplicates."""
    prepare(spark)
    return ngram_join.keep_first(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    prepare(spark)
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; no document goes."""
    prepare(spark)
    return secrets.redact(docs, secrets.train(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    prepare(spark)
    return packing.pieces_of(spark, docs)


STAGES = [
    ("language", by_language),
    ("ngram_join", without_copies),
    ("decontaminate", without_benchmarks),
    ("secrets", without_secrets),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
