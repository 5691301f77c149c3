"""Deliveries of a raw activity table as bronze events.

The ``events`` table (event_id, ts, user_id, event_type, props) has no
repositories or payloads, so they are derived from its counter ``k``; every
event is delivered at least once, by the archive, live, or both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import hour_parts

# Activity kind -> event type.
EVENT_TYPES = {
    "click": "PushEvent",
    "view": "WatchEvent",
    "purchase": "PullRequestEvent",
    "signup": "ForkEvent",
    "error": "IssuesEvent",
}

# Payload text by k % 8.
PAYLOADS = [
    '{"action":"started","forkee":{"language":"js"}}',
    '{"action":"opened","pull_request":{"head":{"repo":{"language":"Python"}},'
    '"base":{"repo":{"language":"Go"}}}}',
    '{"action":"closed","pull_request":{"head":{"repo":null},"base":{"repo":{"language":"golang"}}}}',
    '{"repository":{"language":"c++"}}',
    '{"repository":{"language":""}}',
    '{"action":null}',
    '{"action":"created","forkee":{"language":"Haskell"}}',
    '{"release":{"author":{"repo":{"language":"TS"}}}}',
]

REPOSITORIES = 50


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _iso(ts: Column) -> Column:
    return F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def _plus_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts)


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per delivery: nested bronze columns, source and arrival time."""
    raw = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    kinds = [F.lit(part) for pair in EVENT_TYPES.items() for part in pair]
    payloads = F.array(*[F.lit(text) for text in PAYLOADS])
    # live delay in seconds; NULL marks the archive delivery
    archive = F.lit(None).cast("int")
    sends = (
        F.when(F.col("event_id") % 30 == 0, F.array(F.lit(30), F.lit(90)))
        .when(F.col("event_id") % 10 == 0, F.array(F.lit(30)))
        .when(F.col("event_id") % 3 == 0, F.array(archive, F.lit(30)))
        .otherwise(F.array(archive))
    )
    sent = raw.withColumns({"k": k, "delay": F.explode(sends)})
    repo_name = F.concat(
        F.lit("org/repo-"),
        (F.col("k") % REPOSITORIES).cast("string"),
        F.when(F.col("k") >= REPOSITORIES, "-v2").otherwise(""),
    )
    return sent.select(
        F.col("event_id").cast("string").alias("id"),
        F.try_element_at(F.create_map(*kinds), F.col("event_type")).alias("type"),
        F.struct(
            F.col("user_id").alias("id"),
            F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("login"),
        ).alias("actor"),
        F.struct(
            (F.col("k") % REPOSITORIES).cast("bigint").alias("id"), repo_name.alias("name")
        ).alias("repo"),
        F.get(payloads, F.col("k") % len(PAYLOADS)).alias("payload"),
        F.lit(True).alias("public"),
        _iso(F.col("ts")).alias("created_at"),
        F.struct(F.lit("org").alias("login")).alias("org"),
        F.when(F.col("delay").isNull(), "archive").otherwise("live").alias("source"),
        _iso(_plus_seconds(F.col("ts"), F.col("delay"))).alias("ingested_at"),
        *[column.alias(name) for name, column in hour_parts(F.col("ts")).items()],
    )


def bronze_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deliveries(spark, sf_dir).where(F.col("source") == "archive").drop("source", "ingested_at")


def bronze_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deliveries(spark, sf_dir).where(F.col("source") == "live").drop("source")


def nested_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries as a topic carries them: arrival time in ``_ingested_at``.

    Archive deliveries arrive the moment they happen.
    """
    return (
        deliveries(spark, sf_dir)
        .withColumn("_ingested_at", F.coalesce("ingested_at", "created_at"))
        .drop("ingested_at")
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table as keyed documents with ranking-like numbers.

    The text becomes the day's insight, below a heading that names the
    document; every fifth source is already categorised.
    """
    raw = read_table(spark, sf_dir, "documents")
    number = F.col("doc_id")
    name = F.concat("source", F.lit("/doc-"), number.cast("string"))
    done = F.col("source").isin("src0", "src5", "src10", "src15")
    return raw.select(
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (number % 30).cast("int")), "yyyy-MM-dd").alias("date"),
        name.alias("repo_name"),
        number.cast("string").alias("repo_id"),
        F.col("n_chars").cast("int").alias("event_count"),
        F.lit(None).cast("double").alias("acceleration_ratio"),
        (F.col("n_chars") / 100).alias("anomaly_score"),
        ((number % 7) / 2).alias("watch_zscore"),
        F.lit(0.5).alias("watch_ratio"),
        ((F.col("n_chars") % 1000) / 10).alias("rank_score"),
        F.lit("PushEvent").alias("dominant_event_type"),
        F.concat(
            F.lit("### report\n\n#### 1. "), name, F.lit("\n"), "text", F.lit("\n#### 2. other/one\nmore")
        ).alias("insight_markdown"),
        F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("indexed_at"),
        F.when(done, "Infra").alias("category"),
        F.when(done, 0.75).alias("category_confidence"),
        F.when(done, "seen before").alias("category_reasoning"),
        F.when(done, F.lit("2024-02-02 00:00:00").cast("timestamp_ntz")).alias("categorized_at"),
        F.lit(None).cast("string").alias("repo_insight_markdown"),
        F.lit(None).cast("timestamp_ntz").alias("repo_insight_generated_at"),
    )
