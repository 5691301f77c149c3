"""Ranking of a day into documents, their categories and the enriched table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.prompts import extract_repo_section
from tidemark.functions.scalars import utc_now
from tidemark.operators.classify import (
    Classifier,
    apply_categories,
    classify_repos,
    unclassified_rows,
)
from tidemark.operators.documents import (
    documents_from_ranking,
    fill_missing_categories,
    index_daily,
    merge_categories,
    replace_documents,
    upsert_docs,
)
from tidemark.operators.serving import rank_top, top_rows
from tidemark.schemas import GOLD
from tidemark.session import configure, new_stage_path
from tidemark.sources.paths import delete_path
from tidemark.sources.tables import overwrite_day, read_documents, read_gold, with_date_parts


def _staged(spark: SparkSession, rows: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Rows written to the shared folder and read back, and where they are."""
    path = new_stage_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path), path


def daily_insights(
    spark: SparkSession,
    root: str,
    date: str | None,
    insight_markdown: str | None = None,
    classifier: Classifier | None = None,
    n: int = 10,
    min_events: int = 50,
    min_previous: int = 10,
) -> DataFrame:
    """Rank a day, add known categories, classify the rest, index the rows.

    Without a date all days of the marts are done at once (backfill). Returns
    the ranked rows with their categories; an empty ranking changes nothing. The text is made by the caller's generator, see prompts.
    """
    configure(spark)
    ranked = rank_top(
        read_gold(spark, root, "repo_daily", date),
        read_gold(spark, root, "repo_acceleration", date),
        read_gold(spark, root, "repo_anomaly", date),
        date,
        n,
        min_events,
        min_previous,
    )
    # n rows from here on: the marts are joined once
    known, known_at = _staged(spark, merge_categories(ranked, read_documents(spark, root, date)), "ranked")
    if known.isEmpty():
        return known
    missing = known.where(F.col("category").isNull()).select(
        F.date_format("event_date", "yyyy-MM-dd").alias("date"),
        "repo_name",
        "dominant_event_type",
        "event_count",
        # a row is judged by its own section, not by its neighbours'
        extract_repo_section(F.lit(insight_markdown).cast("string"), F.col("repo_name")).alias("excerpt"),
    )
    # a classifier may be costly and its answers may vary: run it once
    answers, answers_at = _staged(spark, classify_repos(missing, classifier), "answers")
    rows = fill_missing_categories(
        known,
        answers.where(~F.col("failed")).select(
            F.col("date").cast("date").alias("event_date"),
            "repo_name",
            "category",
            "confidence",
            "reasoning",
            F.lit(0).alias("position"),
        ),
    )
    updates = documents_from_ranking(rows, F.lit(insight_markdown).cast("string"), utc_now())
    # n rows a day; the parts they were made of are not needed any more
    rows = spark.createDataFrame(rows.collect(), rows.schema) if date else _staged(spark, rows, "insights")[0]
    if date is None:
        replace_documents(spark, root, upsert_docs(read_documents(spark, root), updates))
    else:
        index_daily(spark, root, updates, date)
    for path in (known_at, answers_at):
        delete_path(spark, path)
    return rows


def categorize_daily(
    spark: SparkSession,
    root: str,
    date: str | None,
    classifier: Classifier | None = None,
    force: bool = False,
    size: int | None = None,
) -> dict[str, int | str | None]:
    """Classify the documents of a date (of all dates without one) that have no category yet.

    All of them by default; ``size`` keeps to the best ranked ones. The
    classifier runs once, into a staged table both the upsert and the
    counters read.
    """
    configure(spark)
    docs = read_documents(spark, root, date)
    chosen = docs
    if size is not None:
        order = [F.desc_nulls_last("rank_score"), F.asc("repo_name")]
        chosen = top_rows(docs, order, size).drop("rank")
    total = chosen.count()
    if total == 0:
        return {"date": date, "total": 0, "classified": 0, "skipped": 0, "errors": 0}

    answers, answers_at = _staged(
        spark, classify_repos(unclassified_rows(chosen, force), classifier), "classified"
    )
    counted = answers.agg(
        F.count_if(~F.col("failed")).alias("classified"), F.count_if(F.col("failed")).alias("errors")
    ).first()
    named = chosen.where(F.coalesce(F.col("repo_name") != "", F.lit(False))).count()
    if counted["classified"]:
        replace_documents(spark, root, apply_categories(docs, answers, utc_now()))
    delete_path(spark, answers_at)
    return {
        "date": date,
        "total": total,
        "classified": counted["classified"],
        "skipped": named - counted["classified"] - counted["errors"],
        "errors": counted["errors"],
    }


def repo_enriched(docs: DataFrame, model_id: str | None = None) -> DataFrame:
    """Documents in the columns of the enriched gold table."""
    return docs.select(
        F.col("date").cast("date").alias("event_date"),
        F.col("repo_id").try_cast("bigint").alias("repo_id"),
        "repo_name",
        "category",
        "category_confidence",
        "category_reasoning",
        F.coalesce("repo_insight_markdown", "insight_markdown").alias("insight_markdown"),
        F.lit(model_id).cast("string").alias("model_id"),
        F.coalesce("repo_insight_generated_at", "categorized_at", "indexed_at").alias("generated_at"),
    ).select(*GOLD["repo_enriched"].fieldNames())


def write_repo_enriched(
    spark: SparkSession, root: str, date: str, model_id: str | None = None
) -> None:
    """Fill the enriched table's day from the document table."""
    rows = repo_enriched(read_documents(spark, root, date), model_id)
    overwrite_day(with_date_parts(rows), f"{root}/gold/repo_enriched", date)
