"""Rankings and reports over the gold marts.

Every ranking works on one day (``day=``) or, without a day, on each day of
the marts; both keep only n rows per task before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.scalars import COUNTED_TYPES
from tidemark.sources.paths import part_condition

# distributed float sums differ in their last digits from run to run; scores
# that agree to this many decimals are ties, and ties go by id
SCORE_DECIMALS = 9

RANK_COLUMNS = [
    "event_date",
    "repo_id",
    "repo_name",
    "event_count",
    "dominant_event_type",
    "acceleration_ratio",
    "prev_event_count",
    "anomaly_score",
    "watch_ratio",
    "watch_zscore",
    "rank_score",
]


def on_day(mart: DataFrame, day: str | None) -> DataFrame:
    if day is None:
        return mart
    if "year" in mart.columns:
        return mart.where(part_condition(day))
    return mart.where(F.col("event_date") == F.lit(day).cast("date"))


def top_rows(rows: DataFrame, order: list[Column], n: int, per: str | None = None) -> DataFrame:
    """The first n rows in ``order``, overall or per value of ``per``.

    Adds the 1-based ``rank``. Per-group ranks are limited inside each task
    before the shuffle (WindowGroupLimit); the overall form runs as a top-k
    and ranks only its n survivors.
    """
    if per is None:
        rows = rows.orderBy(*order).limit(n)
        return rows.withColumn("rank", F.row_number().over(W.partitionBy(F.lit(1)).orderBy(*order)))
    ranked = rows.withColumn("rank", F.row_number().over(W.partitionBy(per).orderBy(*order)))
    return ranked.where(F.col("rank") <= n)


def by_score(name: str) -> list[Column]:
    """Highest score first, missing ones last, ties by repository id."""
    return [F.round(name, SCORE_DECIMALS).desc_nulls_last(), F.asc("repo_id")]


def join_daily_marts(
    daily: DataFrame, acceleration: DataFrame, anomaly: DataFrame, anomaly_columns: list[str]
) -> DataFrame:
    """Daily mart with its acceleration and anomaly columns (LEFT JOINs)."""
    keys = ["event_date", "repo_id"]
    return daily.join(
        acceleration.select(*keys, "acceleration_ratio", "prev_event_count"), keys, "left"
    ).join(anomaly.select(*keys, *anomaly_columns), keys, "left")


def rank_top(
    daily: DataFrame,
    acceleration: DataFrame,
    anomaly: DataFrame,
    day: str | None = None,
    n: int = 10,
    min_events: int = 50,
    min_previous: int = 10,
) -> DataFrame:
    """Trending repositories: acceleration, anomaly and size in one score.

    The filters on the joined columns refuse NULLs, so Catalyst turns both
    left joins into inner ones.
    """
    joined = join_daily_marts(
        on_day(daily, day),
        on_day(acceleration, day),
        on_day(anomaly, day),
        ["anomaly_score", "watch_ratio", "watch_zscore"],
    )
    score = (
        0.4 * F.least(F.coalesce("acceleration_ratio", F.lit(0.0)), F.lit(10.0))
        + 0.4 * F.coalesce("anomaly_score", F.lit(0.0))
        + 0.2 * F.ln(F.col("event_count") + 1)
    )
    kept = joined.where(
        (F.col("event_count") >= min_events)
        & (F.coalesce("prev_event_count", F.lit(0)) >= min_previous)
        & (F.coalesce("watch_zscore", F.lit(-999.0)) > 0)
    ).withColumn("rank_score", score)
    return top_rows(
        kept.select(*RANK_COLUMNS), by_score("rank_score"), n, None if day else "event_date"
    )


def top_acceleration(
    acceleration: DataFrame, day: str | None = None, n: int = 10, min_previous: int = 5
) -> DataFrame:
    """Fastest growing repositories above a noise floor."""
    rows = on_day(acceleration, day).where(F.col("prev_event_count") >= min_previous)
    return top_rows(rows, by_score("acceleration_ratio"), n, None if day else "event_date").select(
        "event_date",
        "rank",
        "repo_id",
        "repo_name",
        "event_count",
        "prev_event_count",
        "acceleration_ratio",
        "dominant_event_type",
    )


def top_anomaly(anomaly: DataFrame, day: str | None = None, n: int = 10) -> DataFrame:
    """Repositories farthest from the rest of their day."""
    return top_rows(on_day(anomaly, day), by_score("anomaly_score"), n, None if day else "event_date").select(
        "event_date",
        "rank",
        "repo_id",
        "repo_name",
        "event_count",
        "watch_ratio",
        "watch_zscore",
        "activity_zscore",
        "anomaly_score",
    )


def repo_hour_series(
    hourly: DataFrame, repo_name: str | None = None, day: str | None = None
) -> DataFrame:
    """Hours of one repository (or of all), in order."""
    rows = on_day(hourly, day)
    if repo_name is not None:
        rows = rows.where(F.col("repo_name") == F.lit(repo_name))
    return rows.select(
        "event_date", "repo_id", "repo_name", "hour", "event_count", "dominant_event_type"
    ).orderBy("event_date", "repo_name", "hour", "repo_id")


def hour_distribution(hourly: DataFrame, day: str | None = None) -> DataFrame:
    """Events and active repositories of every hour."""
    return (
        on_day(hourly, day)
        .groupBy("event_date", "hour")
        .agg(
            F.sum("event_count").alias("total_events"),
            F.countDistinct("repo_id").alias("active_repos"),
        )
        .orderBy("event_date", "hour")
    )


def available_dates(daily: DataFrame, limit: int = 30) -> DataFrame:
    """Latest days present in a mart, as text; reads partition values only."""
    text = F.concat_ws("-", "year", "month", "day")
    return daily.select(text.alias("date_str")).distinct().orderBy(F.desc("date_str")).limit(limit)


def topn_summary(ranked: DataFrame) -> DataFrame:
    """Size, events, mean score and highest watch z-score of each ranking."""
    return ranked.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("repos"),
        F.sum("event_count").alias("total_events"),
        F.avg("rank_score").alias("avg_rank_score"),
        F.max("watch_zscore").alias("max_watch_zscore"),
    )


def type_share(daily: DataFrame) -> DataFrame:
    """Share of the five counted types in a repository's day, in percent."""
    long = daily.unpivot(
        ["event_date", "repo_id", "repo_name", "event_count"],
        list(COUNTED_TYPES),
        "count_column",
        "type_count",
    )
    total = F.when(F.col("event_count") == 0, 1).otherwise(F.coalesce("event_count", F.lit(1)))
    count = F.coalesce("type_count", F.lit(0))
    share = F.round(count / total * 100, 1)
    return long.select(
        "event_date", "repo_id", "repo_name", "count_column", "type_count", share.alias("share_pct")
    )
