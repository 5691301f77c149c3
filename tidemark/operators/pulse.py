"""The minute pulse: counts of the last hour and the busiest repositories.

The stream stores one row per (minute, type, repository, actor) with its
count. Everything shown is rolled up from that grain, so distincts over any
window are exact and no list of names is ever held in one place.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import minute_of, utc_timestamp

WINDOW_MINUTES = 60
TOP_WINDOW_MINUTES = 5
TOP_N = 10

GRAIN = ["minute", "type", "repo_name", "actor_id"]


def pulse_events(bronze: DataFrame, arrived_at: str = "_ingested_at") -> DataFrame:
    """Arrival minute, type, repository and actor of each delivered event.

    A missing type is Unknown; an event without a repository still counts as
    an event, only not as a repository. An unreadable arrival gives way to the
    event's own time, so that a replayed batch finds the same minute; without
    either the minute is that of 1970, which no window shows but totals do.
    """
    times = [utc_timestamp(F.col(arrived_at))]
    if "created_at" in bronze.columns:
        times.append(utc_timestamp(F.col("created_at")))
    never = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return bronze.select(
        minute_of(F.coalesce(*times, never)).alias("minute"),
        F.coalesce(F.nullif("type", F.lit("")), F.lit("Unknown")).alias("type"),
        F.nullif(F.col("repo.name"), F.lit("")).alias("repo_name"),
        F.col("actor.id").alias("actor_id"),
    )


def pulse_grain(events: DataFrame) -> DataFrame:
    return events.groupBy(*GRAIN).agg(F.count(F.lit(1)).alias("n"))


def minute_activity(grain: DataFrame) -> DataFrame:
    """Events, distinct repositories and actors of every minute with data."""
    pieces = grain.groupingSets(
        [["minute", "repo_name"], ["minute", "actor_id"]], "minute", "repo_name", "actor_id"
    ).agg(F.sum("n").alias("n"), F.grouping("repo_name").alias("not_repo"))
    by_repo = F.col("not_repo") == 0
    return pieces.groupBy("minute").agg(
        F.sum(F.when(by_repo, F.col("n"))).alias("events"),
        F.count(F.when(by_repo, F.col("repo_name"))).alias("unique_repos"),
        F.count(F.when(~by_repo, F.col("actor_id"))).alias("unique_actors"),
    )


def minute_types(grain: DataFrame) -> DataFrame:
    """Events of every minute by type."""
    return grain.groupBy("minute", "type").agg(F.sum("n").alias("events"))


def last_minute(grain: DataFrame, now: dt.datetime | None) -> dt.datetime | None:
    """The running minute: of ``now``, else of the newest row (one value)."""
    if now is None:
        return grain.agg(F.max("minute")).first()[0]
    return now.replace(second=0, microsecond=0, tzinfo=None)


def minute_spine(grain: DataFrame, now: dt.datetime | None, minutes: int) -> DataFrame:
    """The last ``minutes`` minutes up to ``now``, else up to the newest row."""
    last = last_minute(grain, now)
    back = grain.sparkSession.range(0 if last is None else minutes).select(F.col("id").cast("int").alias("back"))
    at = F.lit(None if last is None else last.isoformat()).cast("timestamp_ntz")
    return back.select(F.timestamp_add("MINUTE", -F.col("back"), at).alias("minute"))


def in_window(grain: DataFrame, now: dt.datetime | None, minutes: int) -> DataFrame:
    """Grain rows of the window, by literal bounds that reach the scan."""
    last = last_minute(grain, now)
    if last is None:
        return grain.where(F.lit(False))
    bounds = [(last - dt.timedelta(minutes=n)).isoformat() for n in (minutes - 1, 0)]
    low, high = (F.lit(b).cast("timestamp_ntz") for b in bounds)
    return grain.where((F.col("minute") >= low) & (F.col("minute") <= high))


def pulse_minutes(
    grain: DataFrame, now: dt.datetime | None = None, minutes: int = WINDOW_MINUTES
) -> DataFrame:
    """One row per minute of the window, oldest first, 0 where nothing came."""
    counted = minute_activity(in_window(grain, now, minutes)).select("minute", "events", "unique_repos")
    return (
        minute_spine(grain, now, minutes)
        .join(counted, "minute", "left")
        .fillna(0, ["events", "unique_repos"])
        .orderBy("minute")
    )


def pulse_totals(
    grain: DataFrame, now: dt.datetime | None = None, minutes: int = WINDOW_MINUTES
) -> DataFrame:
    """Events and exact distinct repositories and actors of the window."""
    return in_window(grain, now, minutes).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("events"),
        F.countDistinct("repo_name").alias("unique_repos"),
        F.countDistinct("actor_id").alias("unique_actors"),
    )


def pulse_types(
    grain: DataFrame, now: dt.datetime | None = None, minutes: int = WINDOW_MINUTES
) -> DataFrame:
    """Events of the window by type."""
    return in_window(grain, now, minutes).groupBy("type").agg(F.sum("n").alias("events"))


def pulse_top(
    grain: DataFrame,
    now: dt.datetime | None = None,
    n: int = TOP_N,
    minutes: int = TOP_WINDOW_MINUTES,
) -> DataFrame:
    """Busiest repositories of the window and their most frequent type."""
    by_type = (
        in_window(grain, now, minutes)
        .where(F.col("repo_name").isNotNull())
        .groupBy("repo_name", "type")
        .agg(F.sum("n").alias("n"))
    )
    return (
        by_type.groupBy("repo_name")
        .agg(
            F.sum("n").alias("events"),
            F.max(F.struct("n", "type")).getField("type").alias("primary_type"),
        )
        .orderBy(F.desc("events"), F.asc("repo_name"))
        .limit(n)
    )


def current_minute(grain: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    """Counts of the running minute, 0 when nothing has come yet."""
    return pulse_minutes(grain, now, 1)


def freshness(events: DataFrame, now: dt.datetime | None = None, arrived_at: str = "_ingested_at") -> DataFrame:
    """Delivered messages, newest arrival and its lag behind ``now``."""
    clock = F.current_timestamp() if now is None else F.lit(now.isoformat())
    newest = F.max(utc_timestamp(F.col(arrived_at)))
    return events.agg(
        F.count(F.lit(1)).alias("messages"), newest.alias("last_event_at")
    ).withColumn(
        "lag_seconds",
        (
            F.unix_micros(clock.cast("timestamp")) - F.unix_micros(F.col("last_event_at").cast("timestamp"))
        )
        / 1_000_000,
    )
