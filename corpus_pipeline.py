"""Corpus pipeline: language, near duplicates, secrets, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written and read again as the next stage's docs.  All but the last return the
columns of documents; the last adds n_tokens, ids_sha256 and decoded_sha256.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollwise.llm import bpe, language_id, minhash_dedup, mixing, secrets
from rollwise.llm.common import saved, table
from rollwise.llm.queries import vocabulary_path


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language_id.keep_identified(docs)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8)."""
    return minhash_dedup.without_duplicates(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    return secrets.masked(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample by the raked weights of source, language and topic."""
    return mixing.sampled(docs)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encoded(docs, vocabulary_path(), *docs.columns)


STAGES = [("language_id", identified), ("minhash_dedup", deduplicated), ("secrets", without_secrets),
          ("mixing", mixed), ("bpe", tokenised)]
#: Trained models and hashed samples are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
