"""The operators as queries over whole tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pathlib import Path

import corpus_pipeline
from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import alignment, bpe, decontaminate, jaccard, paragraphs, periodic, permutations
from tidemark.llm import pii, quality, substrings, tokens, toxicity, warc
from tidemark.llm.base import table
from tidemark.llm.oracles import ORACLES  # noqa: F401

QUERIES = {}



def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if spark.sparkContext.master.startswith("local["):
            # workers of a local session may start in another folder than the repository
            spark.sparkContext.environment["PYTHONPATH"] = str(Path(__file__).resolve().parents[2])
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), path(tokens.TOKENIZER))


@query
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"), path(tokens.TOKENIZER), texts=False)


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.write_archive(table(spark, sf_dir, "pages")).read_all()


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.drop("items", "spans", "text_hash")


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.fitted(docs, table(spark, sf_dir, "labels")))


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents")).drop("text_hash", "found")


@query
def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents")).drop("text_hash")


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicated(table(spark, sf_dir, "documents"))


@query
def op5_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.deduplicated(table(spark, sf_dir, "documents")).drop("removed")


@query
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"), *map(path, alignment.TOKENIZERS))


@query
def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutations.search(table(spark, sf_dir, "embeddings"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.periodic_runs(table(spark, sf_dir, "documents"), planted=True))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
