"""Progress of a day hour by hour, from the hourly_recent mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import COUNTED_TYPES, korea_hour
from tidemark.operators.serving import on_day, top_rows


def hourly_today_hours(recent: DataFrame, day: str | None = None) -> DataFrame:
    """Totals per hour.

    unique_actors adds up per-repository distincts, so an actor busy in two
    repositories counts twice; that is how this report is defined.
    """
    return (
        on_day(recent, day)
        .groupBy("event_date", "hour")
        .agg(
            F.sum("event_count").alias("events"),
            F.countDistinct("repo_id").alias("unique_repos"),
            F.sum("unique_actors").alias("unique_actors"),
            *[F.sum(name).alias(name) for name in COUNTED_TYPES],
        )
        .withColumn("hour_kst", korea_hour(F.col("hour")))
        .orderBy("event_date", "hour")
    )


def hourly_today_totals(recent: DataFrame, day: str | None = None) -> DataFrame:
    """Totals of the day so far."""
    return (
        on_day(recent, day)
        .groupBy("event_date")
        .agg(F.sum("event_count").alias("events"), F.sum("unique_actors").alias("unique_actors"))
    )


def hourly_today_top(recent: DataFrame, day: str | None = None, n: int = 10) -> DataFrame:
    """Busiest repository names of the day so far.

    The primary type is the dominant type of the busiest single hour; a tie
    goes to the larger type name.
    """
    busiest = F.max_by(
        "dominant_event_type", F.struct("event_count", "dominant_event_type")
    )
    per_name = (
        on_day(recent, day)
        .groupBy("event_date", "repo_name")
        .agg(
            F.sum("event_count").alias("events"),
            F.coalesce(busiest, F.lit("Unknown")).alias("primary_type"),
        )
    )
    order = [F.desc("events"), F.asc("repo_name")]
    return top_rows(per_name, order, n, None if day else "event_date")
