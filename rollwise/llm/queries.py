"""Queries opN_<name> over the whole tables, and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollwise.llm import (bpe, fingerprints, language_id, main_text, manifest, minhash_dedup, mixing, quality, secrets,
                          statements, toxicity, url_filter, vector_codes, warc)
from rollwise.llm.common import table


def vocabulary_path() -> str:
    """The byte-level vocabulary of the installed collection."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"), vocabulary_path(), "doc_id")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages"))).drop("payload")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).drop("key", "token")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode(table(spark, sf_dir, "embeddings")).drop("label")


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verify(table(spark, sf_dir, "documents")).drop("source")


#: The rules of the URL query.
URL_RULES = ["allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/"]


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_filter.parsed(URL_RULES), url_filter.SCHEMA)
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


QUERIES = {f.__name__: f for f in (op1_minhash_dedup, op2_main_text, op3_bpe, op4_fingerprints, op5_quality, op6_mixing,
                                   op7_toxicity, op8_warc, op9_secrets, op10_language_id, op11_vector_codes, op12_manifest, op13_url_filter)}
SQL: dict[str, str] = {"op11_vector_codes": statements.vector_code_sql(), "op12_manifest": statements.manifest_sql(),
                       "op13_url_filter": statements.url_filter_sql(url_filter.parsed(URL_RULES))}
