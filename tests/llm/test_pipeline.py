"""The pipeline against its operators, and the registration."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

import __spark_entry__
from tidemark.llm.base import stage

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    names = list(__spark_entry__.queries())
    for n in range(1, 11):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and corpus_pipeline.ORACLE_SQL is None


def test_stages_keep_the_columns_and_run_is_their_chain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    counts = []
    for name, work in corpus_pipeline.STAGES:
        docs, _ = stage(work(spark, docs, SF), name)
        counts.append(docs.count())
        if name != "bpe":
            assert docs.columns == columns
    assert before > counts[0] > counts[1] >= counts[2] == counts[3] == counts[4]
    mine = docs.select("doc_id", "ids_sha256").exceptAll(
        corpus_pipeline.run(spark, SF).select("doc_id", "ids_sha256")
    )
    assert mine.isEmpty()
    assert docs.where(F.col("n_tokens") * 4 != F.octet_length("ids")).isEmpty()
