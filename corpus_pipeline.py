"""A corpus from documents to token ids: five stages, each written and read again."""

from __future__ import annotations

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, jaccard, pii, quality, tokens
from tidemark.llm.base import drop, stage, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.kept_only(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with the benchmark."""
    return decontaminate.clean_only(docs, table(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    done = pii.redacted(docs)
    if "n_chars" not in docs.columns:
        return done
    return done.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the ids and the decoded text of each document, with digests."""
    return bpe.encoded(docs, path(tokens.TOKENIZER))


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", personal_data_stage),
    ("bpe", encoding_stage),
]

# the score of the first stage is a sum over hashes that DuckDB does not have
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, work in STAGES:
        docs, at = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            drop(spark, before)
        before = at
    return docs
