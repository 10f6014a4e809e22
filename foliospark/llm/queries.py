"""The registered queries opN_<name> over the whole tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, fingerprints, html_text, jaccard_join, mixing, quality, secrets, sharding, sql, substring_dedup

TOKENIZER = "byte_bpe_50k.json"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(_docs(spark, sf_dir)).drop("spans")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_counts(_docs(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_docs(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = fingerprints.edited_fingerprints(_docs(spark, sf_dir))
    text = fingerprints.as_text
    return got.select("doc_id", "n_chars", "edited_sha256", text(F.col("sketch")).alias("fingerprint"), text(F.col("edited_sketch")).alias("edited_fingerprint"), "near_edited", "near_next")


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = secrets.scan(_docs(spark, sf_dir))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return got.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(secrets.as_text(F.col("base")), 256).alias("base_sha256"), secrets.as_text(F.col("spans")).alias("spans"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(_docs(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(_docs(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes_of(_docs(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.balance(_docs(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_token_counts, op3_bpe_round_trip, op4_html_extraction, op5_document_fingerprints,
        op6_secret_scans, op7_sharding, op8_quality_rules, op9_jaccard_join, op10_source_mixing,
    )
}
#: Tokenizers, page markup, Spark's own hashes and Newton steps are beyond SQL: tests hold op2 to op5 and op10 against plain versions.
SQL = {
    "op1_substring_dedup": sql.DEDUP, "op6_secret_scans": sql.SECRETS, "op7_sharding": sql.SHARDS,
    "op8_quality_rules": sql.QUALITY, "op9_jaccard_join": sql.JACCARD,
}
