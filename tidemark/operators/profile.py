"""Repository profile: metrics, hourly timeline and weekly trend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.serving import join_daily_marts, on_day

METRIC_COLUMNS = [
    "event_date",
    "repo_id",
    "repo_name",
    "event_count",
    "unique_actors",
    "dominant_event_type",
    "push_count",
    "pr_count",
    "issue_count",
    "watch_count",
    "fork_count",
    "first_event_at",
    "last_event_at",
    "acceleration_ratio",
    "prev_event_count",
    "anomaly_score",
    "watch_ratio",
    "watch_zscore",
]


def _named(rows: DataFrame, repo_name: str | None) -> DataFrame:
    return rows if repo_name is None else rows.where(F.col("repo_name") == F.lit(repo_name))


def repo_profile_metrics(
    daily: DataFrame,
    acceleration: DataFrame,
    anomaly: DataFrame,
    repo_name: str | None = None,
    day: str | None = None,
) -> DataFrame:
    """Metrics of one repository and day, or of all of them.

    The name filter reaches the daily scan before the joins.
    """
    return join_daily_marts(
        _named(on_day(daily, day), repo_name),
        on_day(acceleration, day),
        on_day(anomaly, day),
        ["anomaly_score", "watch_ratio", "watch_zscore"],
    ).select(*METRIC_COLUMNS)


def zero_fill_hours(rows: DataFrame, keys: list[str]) -> DataFrame:
    """All 24 hours of every key; hours without a row count 0."""
    spine = rows.select(*keys).distinct().withColumn(
        "hour", F.explode(F.sequence(F.lit(0), F.lit(23)))
    )
    return spine.join(rows, [*keys, "hour"], "left").withColumn(
        "event_count", F.coalesce("event_count", F.lit(0))
    )


def repo_profile_timeline(
    hourly: DataFrame, repo_name: str | None = None, day: str | None = None
) -> DataFrame:
    """24 hours per repository name and day, gaps filled with 0.

    A name carried by two ids in one hour is summed; its type is the one of
    the busier id. Events without a name belong to no profile.
    """
    keys = ["event_date", "repo_name"]
    per_hour = (
        _named(on_day(hourly, day), repo_name)
        .where(F.col("repo_name").isNotNull())
        .groupBy(*keys, "hour")
        .agg(
            F.sum("event_count").alias("event_count"),
            F.max_by("dominant_event_type", F.struct("event_count", "dominant_event_type")).alias(
                "dominant_event_type"
            ),
        )
    )
    return zero_fill_hours(per_hour, keys)


def profile_7d(daily: DataFrame, days: int = 7) -> DataFrame:
    """Trailing-week events of each repository and day.

    One row per repository and day goes in, so each window is short.
    """
    day_number = F.datediff("event_date", F.lit("1970-01-01").cast("date"))
    window = W.partitionBy("repo_id").orderBy("day_number").rangeBetween(1 - days, 0)
    return (
        daily.where(F.col("repo_id").isNotNull())
        .withColumn("day_number", day_number)
        .select(
            "event_date",
            "repo_id",
            "repo_name",
            "event_count",
            F.sum("event_count").over(window).alias("events_7d"),
            F.count("event_count").over(window).alias("active_days_7d"),
            F.max("event_count").over(window).alias("peak_7d"),
        )
    )
