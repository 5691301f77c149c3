"""Queries over tables that jobs keep: updated, streamed, compacted or bucketed ones."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import feed, registry, staged
from checks.registry import QUERIES, SEARCH_QUERY, query
from tidemark.functions.scalars import date_from_parts
from tidemark.operators import documents, events, pulse, sketches, token_store
from tidemark.plans import insights
from tidemark.schemas import DAY_PARTS, HOUR_PARTS
from tidemark.session import new_stage_path
from tidemark.sources import bronze, catalog, document_buckets, ledger, tables
from tidemark.streaming import compaction, dedup, health, sinks, source

__all__ = ["QUERIES"]


# --- documents and search -------------------------------------------------


def _rounds(docs):
    """The documents as three rounds of updates: some stale, half of them right, all right."""
    number = F.col("repo_id").cast("bigint")
    stale = F.concat("insight_markdown", F.lit(" words of an earlier version"))
    yield docs.where(number % 3 != 0).withColumn("insight_markdown", stale)
    yield docs.where(number % 2 == 0)
    yield docs


def _token_store(spark, sf_dir):
    root = staged.root_of(spark, sf_dir)

    def build() -> None:
        for docs in _rounds(feed.documents(spark, sf_dir)):
            token_store.update_token_index(docs, f"{root}/token_store")

    staged.once(root, "token_store", build)
    return f"{root}/token_store"


@query
def update_token_index(spark, sf_dir):
    """The stored index after two rounds of updates, summed up like a full build."""
    postings = token_store.read_table(spark, _token_store(spark, sf_dir), "postings")
    return postings.groupBy("field", "token").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("tf").alias("tf"), F.max("dl").alias("max_dl")
    )


@query
def token_bounds(spark, sf_dir):
    """The stored bounds after the updates, per field and token."""
    bounds = token_store.read_table(spark, _token_store(spark, sf_dir), "bounds")
    return bounds.groupBy("field", "token").agg(
        F.sum("docs").alias("docs"), F.max("max_tf").alias("max_tf"), F.min("min_dl").alias("min_dl")
    )


@query
def best_documents(spark, sf_dir):
    """The best 20 hits, read from the slices that can hold them."""
    return token_store.best_documents(spark, _token_store(spark, sf_dir), SEARCH_QUERY, 20)


@query
def upsert_docs_buckets(spark, sf_dir):
    """The updates of ``upsert_docs`` merged into a table in buckets of its key."""
    table = f"documents_{uuid.uuid4().hex}"
    base = registry.renamed_documents(spark, sf_dir)
    document_buckets.create_document_buckets(base, table, 8)
    document_buckets.merge_document_buckets(spark, table, registry.updates(spark, sf_dir), 8, F.col("seq"))
    merged = document_buckets.read_document_buckets(spark, table)
    return registry.merged_columns(merged)


# --- streams --------------------------------------------------------------


@query
def stream_dedup(spark, sf_dir):
    """All deliveries through the stateful dedup, archive files before live ones."""
    out = new_stage_path(spark, "dedup")
    flat = events.union_sources(feed.bronze_archive(spark, sf_dir), feed.bronze_live(spark, sf_dir))
    for name in ("archive", "live"):  # the second run finds the state of the first
        flat.where(F.col("source") == name).write.mode("append").parquet(f"{out}/topic")
        stream = spark.readStream.schema(flat.schema).parquet(f"{out}/topic")
        dedup.dedup_sink(
            stream, f"{out}/judged", f"{out}/checkpoint", {"availableNow": True}, delay="40 days"
        ).awaitTermination()
    kept = dedup.read_deduplicated(spark, f"{out}/judged")
    return kept.select("id", "source", "ingested_at", *HOUR_PARTS)


@query
def folded_pulse(spark, sf_dir):
    """The pulse table with all periods folded, a batch replayed and a late one added in between."""
    path = f"{new_stage_path(spark, 'pulse')}/grain"
    arrived = feed.nested_deliveries(spark, sf_dir)
    part = F.pmod(F.xxhash64("id", "_ingested_at"), F.lit(3))

    def write(batch_id: int) -> None:
        sinks.write_grain_batch(arrived.where(part == batch_id), batch_id, path, "day")

    for batch_id in (0, 1):
        write(batch_id)
    periods = compaction.stored_periods(spark, path)
    for period in periods[: len(periods) // 2]:
        compaction.fold_period(spark, path, period)
    write(1)  # a replay
    write(2)  # came after the fold
    for period in periods[: len(periods) // 4]:
        compaction.fold_period(spark, path, period, clean=True)
    return pulse.minute_activity(compaction.read_folded_grain(spark, path))


@query
def pulse_totals_sketched(spark, sf_dir):
    """Sketched distincts of every hour and every day beside the exact ones."""
    grain = sinks.read_grain(spark, registry.grain_path(spark, sf_dir))
    stored = new_stage_path(spark, "sketches")
    sketches.pulse_sketches(grain).write.parquet(stored)
    minutes = spark.read.parquet(stored)
    both = None
    for span in ("hour", "day"):
        window = [F.lit(span).alias("span"), F.date_trunc(span, "minute").cast("timestamp_ntz").alias("start")]
        exact = grain.groupBy(*window).agg(
            F.countDistinct("repo_name").alias("repos"), F.countDistinct("actor_id").alias("actors")
        )
        rows = sketches.united(minutes, *window).join(exact, ["span", "start"])
        both = rows if both is None else both.unionByName(rows)
    return both.select(
        "span",
        "start",
        "events",
        sketches.within_bound(F.col("unique_repos"), F.col("repos")).alias("repos_within"),
        sketches.within_bound(F.col("unique_actors"), F.col("actors")).alias("actors_within"),
    )


def _bare(live):
    """Live deliveries of which some have no type and others no repository."""
    number = F.col("id").cast("bigint")
    return live.withColumns(
        {
            "type": F.when(number % 20 != 0, F.col("type")),
            "repo": F.when(number % 30 != 0, F.col("repo")),
        }
    )


@query
def stream_defaults(spark, sf_dir):
    """A stream of events without type or without repository, counted per type."""
    out = new_stage_path(spark, "pulse")
    live = feed.bronze_live(spark, sf_dir).withColumnRenamed("ingested_at", "_ingested_at")
    bronze.write_jsonl_gz(_bare(live).drop(*HOUR_PARTS), f"{out}/topic", partitioned=False)
    sinks.pulse_sink(
        source.file_source(spark, f"{out}/topic"), f"{out}/grain", f"{out}/checkpoint", {"availableNow": True}, "day"
    ).awaitTermination()
    return sinks.read_grain(spark, f"{out}/grain").groupBy("type").agg(
        F.sum("n").alias("events"),
        F.sum(F.when(F.col("repo_name").isNull(), F.col("n")).otherwise(0)).alias("without_repo"),
        F.countDistinct("repo_name").alias("repos"),
    )


@query
def stream_health(spark, sf_dir):
    """Messages of a stream that was stopped and started again, from its stored progress."""
    out = new_stage_path(spark, "health")
    live = feed.bronze_live(spark, sf_dir).withColumnRenamed("ingested_at", "_ingested_at").drop(*HOUR_PARTS)
    for half in (0, 1):
        part = live.where(F.pmod(F.xxhash64("id", "_ingested_at"), F.lit(2)) == half)
        bronze.write_jsonl_gz(part, f"{out}/topic", partitioned=False)
        sinks.pulse_sink(
            source.file_source(spark, f"{out}/topic"),
            f"{out}/grain",
            f"{out}/checkpoint",
            {"availableNow": True},
            "day",
            f"{out}/progress",
        ).awaitTermination()
    stored = health.stored_health(spark, f"{out}/progress")
    return stored.select(
        "messages", (F.col("batches") > 1).alias("restarted"), (F.col("lag_seconds") < 3600).alias("fresh")
    )


# --- tables and jobs ------------------------------------------------------


@query
def silver_ledger(spark, sf_dir):
    """Counts of every silver day, taken while the table was written."""
    root = new_stage_path(spark, "lake")
    silver = staged.silver(spark, sf_dir)
    days = [r.d for r in silver.select(F.date_format(date_from_parts(), "yyyy-MM-dd").alias("d")).distinct().collect()]
    ledger.write_counted(
        silver,
        lambda rows: tables.write_silver(rows, root, parts=DAY_PARTS),
        f"{root}/silver/events",
        days,
        F.concat_ws("-", *DAY_PARTS),
        {"live": F.col("source") == "live", "archive": F.col("source") == "archive"},
    )
    return ledger.ledger_report(spark, f"{root}/silver/events")


MARTS = ("repo_daily", "actor_daily", "repo_hourly", "language_activity")


@query
def create_tables(spark, sf_dir):
    """Stored marts counted through the catalog."""
    root, database = new_stage_path(spark, "lake"), f"lake_{uuid.uuid4().hex}"
    for name in MARTS:
        tables.write_gold(staged.gold(spark, sf_dir, name), root, name)
    for _ in (0, 1):  # the second time nothing is missing
        catalog.create_tables(spark, root, database)
    counts = [
        spark.table(f"{database}.gold_{name}").groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("name", F.lit(name))
        for name in MARTS
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def expire_bronze(spark, sf_dir):
    """Archive days left after those older than 14 days were deleted."""
    path = f"{new_stage_path(spark, 'bronze')}/archive"
    archive = feed.bronze_archive(spark, sf_dir)
    archive.hint("rebalance", *DAY_PARTS).write.option("compression", "gzip").partitionBy(*DAY_PARTS).json(path)
    tables.expire_bronze(spark, path, "2024-01-25")
    left = spark.read.schema("id string, year string, month string, day string").json(path)
    return left.groupBy(*DAY_PARTS).agg(F.count(F.lit(1)).alias("n"))


def _insight_root(spark, sf_dir):
    root = new_stage_path(spark, "lake")
    for name in ("repo_daily", "repo_acceleration", "repo_anomaly"):
        tables.write_gold(staged.gold(spark, sf_dir, name), root, name)
    return root


@query
def daily_insights(spark, sf_dir):
    """Every day ranked, classified and indexed; the documents as they are stored."""
    root = _insight_root(spark, sf_dir)
    text = "### report\n\n#### 1. org/repo-1\nA Kafka cluster\n#### 2. org/repo-2-v2\na game"
    insights.daily_insights(
        spark, root, None, text, min_events=registry.MIN_EVENTS, min_previous=registry.MIN_PREVIOUS
    )
    stored = tables.read_documents(spark, root)
    return stored.select("date", "repo_name", "repo_id", "event_count", "rank_score", "category", "category_reasoning")


@query
def categorize_daily(spark, sf_dir):
    """Counters of the classification of all documents, and of a second run that finds none."""
    root = new_stage_path(spark, "lake")
    documents.replace_documents(spark, root, feed.documents(spark, sf_dir))
    runs = [(n, *_counters(insights.categorize_daily(spark, root, None))) for n in (1, 2)]
    return spark.createDataFrame(runs, "run int, total bigint, classified bigint, skipped bigint, errors bigint")


def _counters(found):
    return [found[name] for name in ("total", "classified", "skipped", "errors")]
