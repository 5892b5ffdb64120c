"""Corpus pipeline over the documents table; each stage applies one operator of ``gaugework.llm``.

Language identification drops documents whose language can't be told, exact and near copies are dropped
next, secrets are masked in the texts, and the last stage packs what is left into sequences. Every stage
but the last returns the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugework.llm import bag_minhash, content_sort, language, packing, secret_forest
from gaugework.llm.common import stored, table


def _lean(spark: SparkSession) -> SparkSession:
    """Whole texts go to the Python workers in smaller batches; JVM and workers hold several of them at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose language stays unclear, go; a missing lang is filled in."""
    _lean(spark)
    return language.keep(docs, language.learn(language.learnt_from(docs)))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal normalised texts stays."""
    return content_sort.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near copies stays."""
    _lean(spark)
    return bag_minhash.drop_near_copies(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets that the forest keeps are masked; documents stay."""
    _lean(spark)
    return secret_forest.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 1024 tokens."""
    _lean(spark)
    return packing.production_pack(docs.select("doc_id", "text"))


STAGES = [
    ("identify_language", identify_language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mask_secrets", mask_secrets),
    ("pack_sequences", pack_sequences),
]

#: SQL can express neither the language model nor the forest; the test compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each stage's result written and read again."""
    docs = table(_lean(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
