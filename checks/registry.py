"""Every operator as a query over the given tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as dt
import tempfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import feed, staged
from tidemark.functions import prompts, responses, scalars
from tidemark.operators import (
    classify,
    documents,
    events,
    heatmap,
    marts,
    profile,
    progress,
    pulse,
    quality,
    search,
    serving,
    velocity,
)
from tidemark.plans import daily, insights
from tidemark.schemas import DAY_PARTS, HOUR_PARTS
from tidemark.session import configure, new_stage_path
from tidemark.sources import bronze, paths, tables
from tidemark.streaming import compaction, sinks, source

QUERIES = {}

# thresholds that leave several repositories per day in the small tables
MIN_EVENTS = 5
MIN_PREVIOUS = 3
SEARCH_QUERY = "and the of"


def staging(spark: SparkSession) -> None:
    """The checks' own staging folder where a local session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not named and spark.sparkContext.master.startswith("local["):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-checks-"))


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        staging(spark)
        return rounded(fn(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return fn


def rounded(rows: DataFrame) -> DataFrame:
    """Doubles to 6 decimals (and -0.0 to 0.0), as the check SQL does."""
    return rows.select(
        *[
            (F.round(name, 6) + F.lit(0.0)).alias(name) if kind == "double" else F.col(name)
            for name, kind in rows.dtypes
        ]
    )


def _bronze(spark, sf_dir):
    return feed.bronze_archive(spark, sf_dir), feed.bronze_live(spark, sf_dir)


def _gold(spark, sf_dir, *names):
    return [staged.gold(spark, sf_dir, name) for name in names]


def _ranking(spark, sf_dir):
    daily, acceleration, anomaly = _gold(
        spark, sf_dir, "repo_daily", "repo_acceleration", "repo_anomaly"
    )
    return serving.rank_top(
        daily, acceleration, anomaly, min_events=MIN_EVENTS, min_previous=MIN_PREVIOUS
    )


# --- bronze and silver --------------------------------------------------


@query
def union_sources(spark, sf_dir):
    """Deliveries of both sources, flattened, per source and type."""
    flat = events.union_sources(*_bronze(spark, sf_dir))
    return flat.groupBy("source", "type").agg(
        F.count(F.lit(1)).alias("deliveries"),
        F.countDistinct("id").alias("ids"),
        F.min("created_at").alias("first_created"),
        F.max("ingested_at").alias("last_ingested"),
    )


@query
def flatten_event(spark, sf_dir):
    archive, live = _bronze(spark, sf_dir)
    return events.flatten_event(archive, "archive").unionByName(
        events.flatten_event(live, "live"), allowMissingColumns=True
    )


@query
def dedup_live_first(spark, sf_dir):
    kept = events.dedup_live_first(events.union_sources(*_bronze(spark, sf_dir)))
    return kept.select("id", "source", "ingested_at", *HOUR_PARTS)


@query
def dedup_archive_first(spark, sf_dir):
    kept = events.dedup_archive_first(events.union_sources(*_bronze(spark, sf_dir)))
    return kept.select("id", "source", "ingested_at", *HOUR_PARTS)


@query
def silver_events(spark, sf_dir):
    return events.silver_events(*_bronze(spark, sf_dir))


@query
def read_silver(spark, sf_dir):
    """The stored silver table, counted per partition."""
    return (
        staged.silver(spark, sf_dir)
        .groupBy(*HOUR_PARTS)
        .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("ids"))
    )


@query
def normalize_language(spark, sf_dir):
    return (
        staged.silver(spark, sf_dir)
        .groupBy("repo_language", "payload_action")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def partition_by_created_at(spark, sf_dir):
    sent = feed.nested_deliveries(spark, sf_dir).drop(*HOUR_PARTS)
    return bronze.partition_by_created_at(sent).select("id", "source", "created_at", *HOUR_PARTS)


@query
def bronze_files(spark, sf_dir):
    """Both bronze tables written as gzip JSON lines, read back, made silver."""
    root = new_stage_path(spark, "bronze")
    archive, live = _bronze(spark, sf_dir)
    bronze.write_jsonl_gz(archive, f"{root}/archive")
    bronze.write_jsonl_gz(live.withColumnRenamed("ingested_at", "_ingested_at"), f"{root}/live")
    good_archive, _ = bronze.quarantine_malformed(bronze.read_bronze_archive(spark, f"{root}/archive"))
    good_live, _ = bronze.quarantine_malformed(bronze.read_bronze_live(spark, f"{root}/live"))
    return events.silver_events(good_archive, good_live)


@query
def quarantine_malformed(spark, sf_dir):
    """Lines of which some were cut off, split into good rows and bad lines."""
    sent = feed.nested_deliveries(spark, sf_dir).drop("source")
    line = F.to_json(F.struct(*[c for c in sent.columns if c not in HOUR_PARTS]))
    cut = F.col("payload") == F.lit('{"action":null}')
    path = new_stage_path(spark, "lines")
    (
        sent.select(F.when(cut, F.left(line, F.lit(40))).otherwise(line).alias("value"), *DAY_PARTS)
        .withColumn("hour", F.lit("00"))
        .write.partitionBy(*HOUR_PARTS)
        .option("compression", "gzip")
        .text(path)
    )
    good, bad = bronze.quarantine_malformed(bronze.read_bronze_live(spark, path))
    both = good.select(F.lit("good").alias("kind"), *DAY_PARTS).unionByName(
        bad.select(F.lit("bad").alias("kind"), *DAY_PARTS)
    )
    return both.groupBy("kind", *DAY_PARTS).agg(F.count(F.lit(1)).alias("n"))


@query
def append_archive_hour(spark, sf_dir):
    """All archive deliveries as one publisher file, landed once and once again."""
    base = new_stage_path(spark, "publisher")
    archive = feed.bronze_archive(spark, sf_dir).drop(*HOUR_PARTS)
    archive.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{base}/file")
    first = bronze.append_archive_hour(spark, f"{base}/file", f"{base}/archive", "2024-01-15", 3)
    again = bronze.append_archive_hour(spark, f"{base}/file", f"{base}/archive", "2024-01-15", 3)
    landed = bronze.read_bronze_archive(spark, f"{base}/archive", "2024-01-15", 3)
    return landed.groupBy("type", "day", "hour").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("repo.id").alias("repos"),
        F.lit(first).alias("landed_first"),
        F.lit(again).alias("landed_again"),
    )


# --- marts --------------------------------------------------------------


@query
def repo_daily(spark, sf_dir):
    return marts.repo_daily(staged.silver(spark, sf_dir))


@query
def actor_daily(spark, sf_dir):
    return marts.actor_daily(staged.silver(spark, sf_dir))


@query
def repo_acceleration(spark, sf_dir):
    return marts.repo_acceleration(*_gold(spark, sf_dir, "repo_daily"))


@query
def join_prev_day(spark, sf_dir):
    """Every day joined with the mart's day before it."""
    (daily,) = _gold(spark, sf_dir, "repo_daily")
    return marts.join_prev_day(daily, daily).select(
        "event_date", "repo_id", "event_count", "prev_event_count"
    )


@query
def repo_anomaly(spark, sf_dir):
    return marts.repo_anomaly(*_gold(spark, sf_dir, "repo_daily"))


@query
def repo_hourly(spark, sf_dir):
    return marts.repo_hourly(staged.silver(spark, sf_dir))


@query
def language_activity(spark, sf_dir):
    return marts.language_activity(staged.silver(spark, sf_dir))


@query
def hourly_recent(spark, sf_dir):
    return marts.hourly_recent(*_bronze(spark, sf_dir))


@query
def read_gold(spark, sf_dir):
    (daily,) = _gold(spark, sf_dir, "repo_daily")
    return daily.groupBy(*DAY_PARTS).agg(
        F.count(F.lit(1)).alias("repos"), F.sum("event_count").alias("events")
    )


@query
def overwrite_day(spark, sf_dir):
    """A stored mart with doubled counts, of which one day is replaced twice."""
    (daily,) = _gold(spark, sf_dir, "repo_daily")
    path = new_stage_path(spark, "overwritten")
    doubled = daily.withColumn("event_count", F.col("event_count") * 2)
    doubled.hint("rebalance", *DAY_PARTS).write.partitionBy(*DAY_PARTS).parquet(path)
    for _ in range(2):
        tables.overwrite_day(daily, path, "2024-01-15")
    stored = spark.read.parquet(path)
    return stored.select("event_date", "repo_id", "event_count", *DAY_PARTS)


@query
def overwrite_hour(spark, sf_dir):
    """Hours of a day replaced one at a time beside days that stay."""
    (recent,) = _gold(spark, sf_dir, "hourly_recent")
    path = new_stage_path(spark, "overwritten")
    parts = [*DAY_PARTS, "hour_p"]
    doubled = recent.withColumn("event_count", F.col("event_count") * 2).withColumn(
        "hour_p", F.when(F.col("hour") < 12, "00").otherwise("12")
    )
    doubled.hint("rebalance", *parts).write.partitionBy(*parts).parquet(path)
    halves = recent.withColumn("hour_p", F.when(F.col("hour") < 12, "00").otherwise("12"))
    tables.overwrite_hour(halves, path, "2024-01-15", 12, "hour_p")
    stored = spark.read.parquet(path)
    return stored.select("event_date", "hour", "repo_id", "event_count", "hour_p")


# --- serving ------------------------------------------------------------


@query
def join_daily_marts(spark, sf_dir):
    daily, acceleration, anomaly = _gold(
        spark, sf_dir, "repo_daily", "repo_acceleration", "repo_anomaly"
    )
    return serving.join_daily_marts(
        daily, acceleration, anomaly, ["anomaly_score", "watch_zscore"]
    ).select(
        "event_date",
        "repo_id",
        "event_count",
        "acceleration_ratio",
        "prev_event_count",
        "anomaly_score",
        "watch_zscore",
    )


@query
def rank_top(spark, sf_dir):
    return _ranking(spark, sf_dir)


@query
def top_acceleration(spark, sf_dir):
    return serving.top_acceleration(*_gold(spark, sf_dir, "repo_acceleration"))


@query
def top_anomaly(spark, sf_dir):
    return serving.top_anomaly(*_gold(spark, sf_dir, "repo_anomaly"))


@query
def repo_hour_series(spark, sf_dir):
    return serving.repo_hour_series(*_gold(spark, sf_dir, "repo_hourly"))


@query
def hour_distribution(spark, sf_dir):
    return serving.hour_distribution(*_gold(spark, sf_dir, "repo_hourly"))


@query
def available_dates(spark, sf_dir):
    return serving.available_dates(*_gold(spark, sf_dir, "repo_daily"))


@query
def topn_summary(spark, sf_dir):
    return serving.topn_summary(_ranking(spark, sf_dir))


@query
def type_share(spark, sf_dir):
    return serving.type_share(*_gold(spark, sf_dir, "repo_daily"))


@query
def export_csv(spark, sf_dir):
    """The ranking written as CSV and read back."""
    path = new_stage_path(spark, "csv")
    tables.export_csv(rounded(_ranking(spark, sf_dir)), path)
    return (
        spark.read.option("header", True)
        .csv(path)
        .select(
            F.col("event_date").cast("date").alias("event_date"),
            F.col("rank").cast("int").alias("rank"),
            F.col("repo_name"),
            F.col("event_count").cast("bigint").alias("event_count"),
            F.col("rank_score").cast("double").alias("rank_score"),
        )
    )


@query
def activity_heatmap_long(spark, sf_dir):
    return heatmap.activity_heatmap_long(staged.silver(spark, sf_dir))


@query
def activity_heatmap_matrix(spark, sf_dir):
    return heatmap.activity_heatmap_matrix(
        heatmap.activity_heatmap_long(staged.silver(spark, sf_dir))
    )


@query
def activity_heatmap_cells(spark, sf_dir):
    return heatmap.activity_heatmap_cells(
        heatmap.activity_heatmap_long(staged.silver(spark, sf_dir))
    )


@query
def heatmap_coverage(spark, sf_dir):
    return heatmap.heatmap_coverage(heatmap.activity_heatmap_long(staged.silver(spark, sf_dir)))


@query
def hourly_today_hours(spark, sf_dir):
    return progress.hourly_today_hours(*_gold(spark, sf_dir, "hourly_recent"))


@query
def hourly_today_totals(spark, sf_dir):
    return progress.hourly_today_totals(*_gold(spark, sf_dir, "hourly_recent"))


@query
def hourly_today_top(spark, sf_dir):
    return progress.hourly_today_top(*_gold(spark, sf_dir, "hourly_recent"))


@query
def repo_profile_metrics(spark, sf_dir):
    return profile.repo_profile_metrics(
        *_gold(spark, sf_dir, "repo_daily", "repo_acceleration", "repo_anomaly")
    )


@query
def repo_profile_timeline(spark, sf_dir):
    return profile.repo_profile_timeline(*_gold(spark, sf_dir, "repo_hourly"))


@query
def profile_7d(spark, sf_dir):
    return profile.profile_7d(*_gold(spark, sf_dir, "repo_daily"))


# --- quality ------------------------------------------------------------


@query
def silver_ready(spark, sf_dir):
    return quality.silver_ready(staged.silver(spark, sf_dir))


@query
def sources_ready(spark, sf_dir):
    return quality.sources_ready(*_bronze(spark, sf_dir))


@query
def verify_silver(spark, sf_dir):
    return quality.verify_silver(staged.silver(spark, sf_dir))


@query
def verify_gold(spark, sf_dir):
    names = list(quality.MART_COLUMNS)
    return quality.verify_gold(dict(zip(names, _gold(spark, sf_dir, *names))))


@query
def verify_hourly(spark, sf_dir):
    return quality.verify_hourly(*_gold(spark, sf_dir, "hourly_recent"))


# --- five-minute metrics ------------------------------------------------


@query
def repo_metrics_5min(spark, sf_dir):
    return velocity.repo_metrics_5min(staged.silver(spark, sf_dir), approximate=False)


@query
def repo_metrics_5min_sketch(spark, sf_dir):
    """With sketched distinct actors: how far they are off, as a bound."""
    silver = staged.silver(spark, sf_dir)
    keys = ["repo_id", "ts_5min"]
    exact = velocity.repo_metrics_5min(silver, approximate=False).select(
        *keys, F.col("unique_actors").alias("exact")
    )
    sketched = velocity.repo_metrics_5min(silver).join(exact, keys)
    near = F.abs(F.col("unique_actors") - F.col("exact")) <= F.greatest(F.lit(1), F.col("exact") * 0.2)
    return sketched.select(*keys, "commit_count", near.alias("within_bound"))


@query
def repo_velocity(spark, sf_dir):
    metrics = velocity.repo_metrics_5min(staged.silver(spark, sf_dir), approximate=False)
    return velocity.repo_velocity(metrics)


@query
def anomaly_kind(spark, sf_dir):
    return velocity.anomaly_kind(*_gold(spark, sf_dir, "repo_daily"), bot_below=0.95)


# --- documents and search -----------------------------------------------


def updates(spark, sf_dir):
    """Two updates per key; half of the keys hit a stored document."""
    docs = feed.documents(spark, sf_dir)
    number = F.col("repo_id").cast("bigint")
    key = F.floor(number / 2) * 3
    name = F.concat(F.lit("src"), (key % 20).cast("string"), F.lit("/doc-"), key.cast("string"))
    odd = number % 2 == 1
    return docs.withColumns(
        {
            "seq": number,
            "repo_name": name,
            "date": F.date_format(
                F.date_add(F.lit("2024-01-01").cast("date"), (key % 30).cast("int")), "yyyy-MM-dd"
            ),
            "anomaly_score": F.when(odd, F.col("anomaly_score")),
            "category": F.when(~odd, "Web"),
            "category_confidence": F.when(~odd, 0.5),
            "category_reasoning": F.when(number % 4 == 0, "renewed").otherwise(""),
            "categorized_at": F.lit("2024-03-01 00:00:00").cast("timestamp_ntz"),
        }
    )


def renamed_documents(spark, sf_dir):
    """The documents under the names that ``updates`` uses."""
    number = F.col("repo_id").cast("bigint")
    name = F.concat(F.lit("src"), (number % 20).cast("string"), F.lit("/doc-"), F.col("repo_id"))
    return feed.documents(spark, sf_dir).withColumn("repo_name", name)


def merged_columns(merged):
    return merged.select(
        "date",
        "repo_name",
        "repo_id",
        "event_count",
        "anomaly_score",
        "rank_score",
        F.md5("insight_markdown").alias("insight_md5"),
        "category",
        "category_confidence",
        "category_reasoning",
        "categorized_at",
    )


@query
def upsert_docs(spark, sf_dir):
    base = renamed_documents(spark, sf_dir)
    return merged_columns(documents.upsert_docs(base, updates(spark, sf_dir), F.col("seq")))


@query
def cache_repo_insight(spark, sf_dir):
    """One generated text per document, from the document's own section."""
    docs = feed.documents(spark, sf_dir)
    texts = docs.select(
        "date",
        "repo_name",
        F.concat(F.lit("cached: "), "insight_markdown").alias("repo_insight_markdown"),
    )
    made = F.lit("2024-02-03 00:00:00").cast("timestamp_ntz")
    return documents.cache_repo_insight(docs, texts, made).select(
        "date",
        "repo_name",
        "category",
        F.md5("repo_insight_markdown").alias("cached_md5"),
        "repo_insight_generated_at",
    )


@query
def docs_by_date(spark, sf_dir):
    return documents.docs_by_date(feed.documents(spark, sf_dir), size=5).select(
        "date", "rank", "total", "repo_name", "rank_score"
    )


@query
def indexed_dates(spark, sf_dir):
    return documents.indexed_dates(feed.documents(spark, sf_dir))


def _document_root(spark, sf_dir):
    root = staged.root_of(spark, sf_dir)
    staged.once(
        root, "documents", lambda: documents.replace_documents(spark, root, feed.documents(spark, sf_dir))
    )
    return root


@query
def index_stats(spark, sf_dir):
    """Stored documents, and whether they take up bytes."""
    stats = documents.index_stats(spark, _document_root(spark, sf_dir))
    return stats.select("doc_count", (F.col("size_bytes") > 0).alias("has_bytes"))


@query
def get_repo_insight(spark, sf_dir):
    """Point lookups of the texts cached on one day's documents."""
    docs = feed.documents(spark, sf_dir)
    texts = docs.select("date", "repo_name", F.col("insight_markdown").alias("repo_insight_markdown"))
    made = F.lit("2024-02-03 00:00:00").cast("timestamp_ntz")
    stored = documents.cache_repo_insight(docs, texts, made)
    first = docs.agg(F.min(F.struct(F.col("repo_id").cast("bigint"), "date", "repo_name")).alias("k")).first().k
    found = documents.get_repo_insight(stored, first.date, first.repo_name)
    return found.select("date", "repo_name", F.md5("repo_insight_markdown").alias("insight_md5"))


@query
def upsert_docs_twice(spark, sf_dir):
    """Unordered updates, several to a key, folded and applied twice over."""
    base = feed.documents(spark, sf_dir)
    new = base.withColumn("repo_name", F.concat(F.lit("many/"), (F.col("event_count") % 50).cast("string")))
    once = documents.upsert_docs(base, new)
    return (
        documents.upsert_docs(once, new)
        .groupBy("date", "repo_name")
        .agg(F.count(F.lit(1)).alias("rows"), F.max("rank_score").alias("rank_score"))
    )


def _token_index(spark, sf_dir):
    root = staged.root_of(spark, sf_dir)
    staged.once(
        root, "tokens", lambda: search.write_token_index(feed.documents(spark, sf_dir), f"{root}/tokens")
    )
    return spark.read.parquet(f"{root}/tokens/postings"), spark.read.parquet(f"{root}/tokens/fields")


@query
def build_token_index(spark, sf_dir):
    """All postings, summed up per field and token."""
    index = search.build_token_index(feed.documents(spark, sf_dir))
    return index.groupBy("field", "token").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("tf").alias("tf"), F.max("dl").alias("max_dl")
    )


@query
def search_documents(spark, sf_dir):
    found = search.search_documents(
        *_token_index(spark, sf_dir), feed.documents(spark, sf_dir), SEARCH_QUERY, 20
    )
    return found.select(
        "date",
        "repo_name",
        "score",
        "rank",
        "total",
        "event_count",
        "rank_score",
        F.md5("insight_markdown").alias("insight_md5"),
    )


@query
def search_total(spark, sf_dir):
    return search.search_total(*_token_index(spark, sf_dir), SEARCH_QUERY)


def _categories(spark, sf_dir):
    """A category per repository name and day, as stored documents."""
    (daily,) = _gold(spark, sf_dir, "repo_daily")
    known = F.col("repo_id") % 3 != 0
    return daily.select(
        F.date_format("event_date", "yyyy-MM-dd").alias("date"),
        "repo_name",
        F.when(known, F.when(F.col("repo_id") % 2 == 0, "Web").otherwise("Game")).alias("category"),
        F.when(known, 0.8).alias("category_confidence"),
    )


@query
def merge_categories(spark, sf_dir):
    merged = documents.merge_categories(_ranking(spark, sf_dir), _categories(spark, sf_dir))
    return merged.select("event_date", "repo_id", "repo_name", "category", "category_confidence")


@query
def fill_missing_categories(spark, sf_dir):
    merged = documents.merge_categories(_ranking(spark, sf_dir), _categories(spark, sf_dir))
    (daily,) = _gold(spark, sf_dir, "repo_daily")
    answers = daily.select(
        "event_date",
        "repo_name",
        F.lit("DevTools").alias("category"),
        F.lit(0.4).alias("confidence"),
        F.lit("batch").alias("reasoning"),
        F.lit(0).alias("position"),
    )
    return documents.fill_missing_categories(merged, answers).select(
        "event_date", "repo_id", "category", "category_confidence", "category_reasoning"
    )


@query
def category_trending(spark, sf_dir):
    merged = documents.merge_categories(_ranking(spark, sf_dir), _categories(spark, sf_dir))
    return documents.category_trending(merged)


@query
def only_unclassified(spark, sf_dir):
    return documents.only_unclassified(feed.documents(spark, sf_dir)).select("date", "repo_name")


@query
def repo_enriched(spark, sf_dir):
    rows = insights.repo_enriched(feed.documents(spark, sf_dir), "local-rules")
    return rows.withColumn("insight_markdown", F.md5("insight_markdown"))


# --- text ---------------------------------------------------------------


def quoted(text):
    """A whole text as the inside of a JSON string: quotes, newlines, every letter."""
    json = F.to_json(F.struct(text.alias("t")))
    return F.substr(json, F.lit(7), F.length(json) - 8)


def _answers(spark, sf_dir):
    """A classifier-like answer around each whole text, in six shapes."""
    docs = feed.read_table(spark, sf_dir, "documents")

    def opening(category: str, confidence: str) -> str:
        return f'{{"category":"{category}","confidence":{confidence},"reasoning":"'

    fence = "```"
    shapes = [
        (f"Sure:\n{fence}json\n" + opening("AI/ML", "0.9"), f'"}}\n{fence}\ndone'),
        (f"{fence}\n" + opening("Infra", '"0.25"'), f'"}}\n{fence}'),
        ("I think " + opening("Game", "0.5"), '"} fits.'),
        (opening("Web", "1.7"), '"}'),
        (opening("Cooking", "-3"), '"}'),
        ('{"category": "Web", "reasoning": ', ""),
    ]
    shape = (F.col("doc_id") % len(shapes)).cast("int")
    before, after = (F.get(F.array(*[F.lit(pair[i]) for pair in shapes]), shape) for i in (0, 1))
    return docs.select("doc_id", F.concat(before, quoted(F.col("text")), after).alias("answer"))


@query
def parse_category_response(spark, sf_dir):
    return _answers(spark, sf_dir).select(
        "doc_id", responses.parse_category_response(F.col("answer")).alias("a")
    ).select("doc_id", "a.*")


@query
def parse_batch_response(spark, sf_dir):
    """Three objects and a stray number around each whole text."""
    docs = feed.read_table(spark, sf_dir, "documents")
    body = F.concat(
        F.lit('[{"repo_name":" '),
        F.col("source"),
        F.lit('/a ","category":"Web","confidence":0.78,"reasoning":"'),
        quoted(F.col("text")),
        F.lit('"},{"repo_name":"'),
        F.col("source"),
        F.lit('/b","category":"Nope","confidence":"high"},42,{"category":"Game","confidence":2}]'),
    )
    fenced = F.concat(F.lit("```json\n"), body, F.lit("\n```"))
    text = F.when(F.col("doc_id") % 2 == 0, fenced).otherwise(
        F.concat(F.lit("Result: "), body, F.lit(" ok"))
    )
    items = docs.select("doc_id", F.posexplode(responses.parse_batch_response(text)))
    return items.select("doc_id", F.col("pos").alias("position"), "col.*")


@query
def extract_repo_section(spark, sf_dir):
    docs = feed.documents(spark, sf_dir)
    section = prompts.extract_repo_section(F.col("insight_markdown"), F.col("repo_name"))
    return docs.select("date", "repo_name", section.alias("section"))


@query
def rank_table_markdown(spark, sf_dir):
    return prompts.rank_table_markdown(_ranking(spark, sf_dir))


@query
def repo_lines(spark, sf_dir):
    return prompts.repo_lines(_ranking(spark, sf_dir))


INSIGHT_TEMPLATE = """# single repository

## system
You explain activity.

## user_template
{{date}}: `{{repo_name}}` had {{event_count}} events, mostly {{dominant_event_type}}.
x{{acceleration_ratio}}, anomaly {{anomaly_score}}, watch {{watch_zscore}}.
Stars {{watch_count}}, forks {{fork_count}}, PRs {{pr_count}}, pushes {{push_count}}; again {{repo_name}}.
"""


@query
def render_prompt(spark, sf_dir):
    metrics = profile.repo_profile_metrics(
        *_gold(spark, sf_dir, "repo_daily", "repo_acceleration", "repo_anomaly")
    )
    system, user = prompts.render_prompt(INSIGHT_TEMPLATE, prompts.repo_insight_values())
    return metrics.select(
        "event_date", "repo_id", system.alias("system_text"), user.alias("user_text")
    )


def _names(spark, sf_dir):
    """Repository-like names, one per distinct counter value of the events."""
    raw = feed.read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    stems = [
        "trading-bot",
        "Casino",
        "sandbox",
        "webapp",
        "copy_bot",
        "bad name",
        "robotics",
        "playground",
    ]
    stem = F.get(F.array(*[F.lit(s) for s in stems]), k % len(stems))
    tail = F.when(k % 5 == 0, k.cast("string")).otherwise(F.concat(stem, F.lit("-"), k.cast("string")))
    return raw.select(F.concat(F.lit("acme/"), tail).alias("name"))


@query
def flag_bot_names(spark, sf_dir):
    names = _names(spark, sf_dir)
    return names.groupBy("name").agg(F.count(F.lit(1)).alias("n")).withColumns(
        {"is_bot": scalars.is_bot_name(F.col("name")), "is_valid": scalars.is_repo_name(F.col("name"))}
    )


@query
def validate_date(spark, sf_dir):
    raw = feed.read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    text = F.concat(
        F.lit("2024-"), F.format_string("%02d", k % 15), F.lit("-"), F.format_string("%02d", k % 34)
    )
    return (
        raw.select(text.alias("text"))
        .groupBy("text")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("is_date", scalars.is_date_text(F.col("text")))
    )


@query
def type_display_names(spark, sf_dir):
    return (
        staged.silver(spark, sf_dir)
        .groupBy("type")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("label", scalars.type_label(F.col("type")))
    )


@query
def safe_numbers(spark, sf_dir):
    """Numbers read from text that is sometimes none."""
    raw = feed.read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    text = (
        F.when(k % 4 == 0, F.concat(k.cast("string"), F.lit(".0")))
        .when(k % 4 == 1, "")
        .when(k % 4 == 2, "n/a")
        .otherwise(F.col("value").cast("decimal(12,2)").cast("string"))
    )
    return raw.select("event_id", text.alias("text")).withColumns(
        {
            "as_int": scalars.safe_int(F.col("text")),
            "as_double": scalars.safe_double(F.col("text")),
        }
    )


@query
def classify_by_rules(spark, sf_dir):
    rows = classify.unclassified_rows(feed.documents(spark, sf_dir), force=True)
    return classify.classify_repos(rows)


@query
def classify_repos(spark, sf_dir):
    """A user function over every document that has no category yet.

    It answers by name and in another order, leaves names that end in 7 out,
    and gives unknown categories and confidences out of range.
    """

    def by_length(batch: pd.DataFrame) -> pd.DataFrame:
        size = batch["excerpt"].str.len()
        answer = pd.DataFrame(
            {
                "date": batch["date"],
                "repo_name": batch["repo_name"],
                "category": (size % 3).map({0: "Infra", 1: "Web", 2: "Cooking"}),
                "confidence": (size % 5) - 1.5,
                "reasoning": size.astype(str) + " characters",
            }
        )
        return answer[~batch["repo_name"].str.endswith("7")].iloc[::-1]

    rows = classify.unclassified_rows(feed.documents(spark, sf_dir))
    return classify.classify_repos(rows, by_length)


@query
def apply_categories(spark, sf_dir):
    """Rule categories written onto every document that had none."""
    docs = feed.documents(spark, sf_dir)
    answers = classify.classify_repos(classify.unclassified_rows(docs))
    at = F.lit("2024-02-04 00:00:00").cast("timestamp_ntz")
    return classify.apply_categories(docs, answers, at).select(
        "date", "repo_name", "event_count", "category", "category_confidence", "categorized_at"
    )


# --- pulse --------------------------------------------------------------


@query
def stamp_and_key(spark, sf_dir):
    """Keyed topic records of all deliveries, counted per key."""
    records = source.stamp_and_key(feed.nested_deliveries(spark, sf_dir).drop("_ingested_at"))
    event = source.decode(records.withColumn("value", F.col("value").cast("binary")))
    keyed = records.groupBy("key").agg(F.count(F.lit(1)).alias("records"))
    decoded = event.groupBy(F.col("repo.id").cast("string").alias("key")).agg(
        F.countDistinct("id").alias("ids"), F.count("_ingested_at").alias("stamped")
    )
    return keyed.join(decoded, "key")


def grain_path(spark, sf_dir):
    """The pulse table as three batches of a stream leave it, one of them written twice."""
    root = staged.root_of(spark, sf_dir)

    def build() -> None:
        arrived = feed.nested_deliveries(spark, sf_dir)
        part = F.pmod(F.xxhash64("id", "_ingested_at"), F.lit(3))
        for batch_id in (0, 1, 1, 2):
            sinks.write_grain_batch(arrived.where(part == batch_id), batch_id, f"{root}/grain", "day")

    staged.once(root, "grain", build)
    return f"{root}/grain"


def _grain(spark, sf_dir):
    return sinks.read_grain(spark, grain_path(spark, sf_dir))


def _recent(spark, sf_dir, minutes):
    """Grain of the folders that can hold the last minutes, and the newest minute."""
    return compaction.recent_grain(spark, grain_path(spark, sf_dir), minutes, folder="day")


@query
def pulse_grain(spark, sf_dir):
    return pulse.pulse_grain(pulse.pulse_events(feed.nested_deliveries(spark, sf_dir)))


@query
def minute_activity(spark, sf_dir):
    return pulse.minute_activity(_grain(spark, sf_dir))


@query
def minute_types(spark, sf_dir):
    return pulse.minute_types(_grain(spark, sf_dir))


@query
def pulse_minutes(spark, sf_dir):
    grain, now = _recent(spark, sf_dir, pulse.WINDOW_MINUTES)
    return pulse.pulse_minutes(grain, now)


@query
def pulse_totals(spark, sf_dir):
    grain, now = _recent(spark, sf_dir, 24 * 60)
    return pulse.pulse_totals(grain, now, minutes=24 * 60)


@query
def pulse_types(spark, sf_dir):
    grain, now = _recent(spark, sf_dir, 24 * 60)
    return pulse.pulse_types(grain, now, minutes=24 * 60)


@query
def pulse_top(spark, sf_dir):
    grain, now = _recent(spark, sf_dir, 24 * 60)
    return pulse.pulse_top(grain, now, minutes=24 * 60)


@query
def current_minute(spark, sf_dir):
    grain, now = _recent(spark, sf_dir, 1)
    return pulse.current_minute(grain, now)


@query
def freshness(spark, sf_dir):
    now = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
    return pulse.freshness(feed.nested_deliveries(spark, sf_dir), now)


def _live_files(spark, sf_dir):
    """Live deliveries as JSON lines, the input of the streaming queries."""
    root = staged.root_of(spark, sf_dir)

    def build() -> None:
        live = feed.bronze_live(spark, sf_dir).withColumnRenamed("ingested_at", "_ingested_at")
        bronze.write_jsonl_gz(live.drop(*HOUR_PARTS), f"{root}/topic", partitioned=False)

    staged.once(root, "topic", build)
    return f"{root}/topic"


@query
def stream_pulse(spark, sf_dir):
    """The pulse grain kept by a stream, rolled up per minute."""
    out = new_stage_path(spark, "pulse")
    stream = source.file_source(spark, _live_files(spark, sf_dir))
    sinks.pulse_sink(
        stream, f"{out}/grain", f"{out}/checkpoint", {"availableNow": True}, folder="day"
    ).awaitTermination()
    return pulse.minute_activity(sinks.read_grain(spark, f"{out}/grain"))


@query
def stream_pulse_restart(spark, sf_dir):
    """Two streams with a checkpoint each over two halves of the topic, one table."""
    out = new_stage_path(spark, "pulse")
    live = feed.bronze_live(spark, sf_dir).withColumnRenamed("ingested_at", "_ingested_at")
    for half in (0, 1):
        part = live.where(F.pmod(F.xxhash64("id", "_ingested_at"), F.lit(2)) == half)
        bronze.write_jsonl_gz(part.drop(*HOUR_PARTS), f"{out}/topic-{half}", partitioned=False)
        stream = source.file_source(spark, f"{out}/topic-{half}")
        sinks.pulse_sink(
            stream, f"{out}/grain", f"{out}/checkpoint-{half}", {"availableNow": True}, folder="day"
        ).awaitTermination()
    return pulse.minute_activity(sinks.read_grain(spark, f"{out}/grain"))


@query
def backfill_keeps_days(spark, sf_dir):
    """All marts built, then rebuilt from the first half of the month: the rest stays."""
    root = new_stage_path(spark, "lake")
    silver = staged.silver(spark, sf_dir)
    for part in (silver, silver.where("day <= '15'")):
        if part is not silver:
            paths.delete_path(spark, f"{root}/silver/events")
        tables.write_silver(part, root, parts=DAY_PARTS)
        daily.backfill_gold(spark, root)
    return tables.read_gold(spark, root, "repo_daily").select("event_date", "repo_id", "event_count")


@query
def stream_bronze_sink(spark, sf_dir):
    """Live events landed by a stream, counted per hour folder."""
    out = new_stage_path(spark, "landed")
    stream = source.file_source(spark, _live_files(spark, sf_dir))
    sinks.bronze_sink(
        stream, f"{out}/live", f"{out}/checkpoint", {"availableNow": True}, files_per_hour=2
    ).awaitTermination()
    landed = bronze.read_bronze_live(spark, f"{out}/live")
    return landed.groupBy(*HOUR_PARTS).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids")
    )
