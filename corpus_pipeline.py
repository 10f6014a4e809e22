"""The corpus pipeline: quality rules, near duplicates, secrets, source mixing and BPE encoding, in this order."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from foliospark.llm import bpe, jaccard_join, mixing, quality, secrets
from foliospark.llm.common import stored

TOKENIZER = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and their language's and source's fences let pass.

    Null and empty texts fail the base rule; null languages and sources are groups; repeated rows are judged each; an
    empty table gives none; all columns stay.
    """
    return quality.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a Jaccard similarity of 0.8 or more: the smallest doc_id, null last.

    Null and blank texts are linked with nothing and stay; repeated rows are copies; an empty table gives none; all columns stay.
    """
    return jaccard_join.representatives(docs, "0.8", 5)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets and linked parts masked, n_chars to match.

    Null texts stay null; repeated rows are masked each; an empty table gives none; all columns stay.
    """
    return secrets.redacted(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated (0 to 3 times) so that sources come near their target weights.

    Null texts and texts without words have no size and no copies; a null source is a source; repeated rows share
    their copies; an empty table gives none; all columns stay.
    """
    return mixing.mixed(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (comma-joined) and hashes of the ids and of the decoded text, a row for each row.

    Null text counts as empty; a null doc_id stays; an empty table gives none; other columns are not read.
    """
    return bpe.round_trip(docs, public_tokenizers.path(TOKENIZER), with_ids=True)


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("secret scan", secret_scan), ("source mixing", source_mixing), ("BPE encoding", bpe_encoding)]

#: SQL can't express the near-duplicate, mixing and BPE stages; tests/llm/test_pipeline.py holds them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
