"""Row-count checks of the layers, as reports and as gates that raise."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.languages import UNKNOWN
from tidemark.operators.marts import dated
from tidemark.schemas import HOUR_PARTS

# Report column of each daily mart.
MART_COLUMNS = {
    "repo_daily": "repos",
    "actor_daily": "actors",
    "repo_acceleration": "accel",
    "repo_anomaly": "anomaly",
    "repo_hourly": "hourly",
    "language_activity": "lang",
}


class EmptyLayerError(RuntimeError):
    """A layer that should hold rows for a day or hour holds none."""


def silver_ready(silver: DataFrame) -> DataFrame:
    """Silver rows per day."""
    return dated(silver).groupBy("event_date").agg(F.count(F.lit(1)).alias("cnt"))


def require_silver(silver_day: DataFrame, day: str) -> None:
    """Raise unless the silver day holds a row (stops at the first one)."""
    if silver_day.isEmpty():
        raise EmptyLayerError(f"silver has no rows for {day}")


def sources_ready(archive: DataFrame, live: DataFrame) -> DataFrame:
    """Delivered rows per hour and bronze table, from one aggregation."""
    tagged = live.select(*HOUR_PARTS, F.lit("live").alias("src")).unionByName(
        archive.select(*HOUR_PARTS, F.lit("archive").alias("src"))
    )
    return tagged.groupBy(*HOUR_PARTS).agg(
        F.count_if(F.col("src") == "live").alias("live_cnt"),
        F.count_if(F.col("src") == "archive").alias("archive_cnt"),
    )


def require_sources(archive_hour: DataFrame, live_hour: DataFrame, label: str) -> None:
    """Raise when the hour is empty, or only the archive is still missing."""
    if not archive_hour.isEmpty():
        return
    if live_hour.isEmpty():
        raise EmptyLayerError(f"both sources are empty for {label}")
    raise EmptyLayerError(f"archive has not arrived for {label}")


def verify_silver(silver: DataFrame) -> DataFrame:
    """Rows, hours, sources and known languages of each silver day."""
    return (
        dated(silver)
        .groupBy("event_date")
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            F.countDistinct("hour").alias("hrs"),
            F.count_if(F.col("source") == "live").alias("live_rows"),
            F.count_if(F.col("source") == "archive").alias("archive_rows"),
            F.count_if(F.col("repo_language") != UNKNOWN).alias("lang_known"),
        )
    )


def verify_gold(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of all six daily marts per day, side by side."""
    counts = None
    for name in MART_COLUMNS:
        part = (
            marts[name]
            .groupBy("event_date")
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("mart", F.lit(name))
        )
        counts = part if counts is None else counts.unionByName(part)
    return counts.groupBy("event_date").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("mart") == name, F.col("n"))), F.lit(0)).alias(column)
            for name, column in MART_COLUMNS.items()
        ]
    )


def require_gold(report: DataFrame, day: str) -> dict[str, int]:
    """Counts of the day; raises when any mart is empty."""
    row = report.where(F.col("event_date") == F.lit(day).cast("date")).first()
    counts = {c: (row[c] if row else 0) for c in MART_COLUMNS.values()}
    if min(counts.values()) == 0:
        raise EmptyLayerError(f"gold is incomplete for {day}: {counts}")
    return counts


def verify_hourly(recent: DataFrame) -> DataFrame:
    """Repositories of each hour of the hourly mart."""
    return recent.groupBy("event_date", "hour").agg(F.count(F.lit(1)).alias("repos"))


def require_hourly(recent_hour: DataFrame, label: str) -> int:
    repos = recent_hour.count()
    if repos == 0:
        raise EmptyLayerError(f"hourly mart is empty for {label}")
    return repos
