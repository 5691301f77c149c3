"""Hour x event type activity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.scalars import type_label
from tidemark.operators.marts import dated

HOURS = range(24)


def activity_heatmap_long(silver: DataFrame) -> DataFrame:
    """Events and distinct repositories per day, hour and event type."""
    return (
        dated(silver)
        .groupBy("event_date", "hour", F.col("type").alias("type_raw"))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.countDistinct("repo_id").alias("unique_repos"),
        )
    )


def _named(long: DataFrame) -> DataFrame:
    # '' and NULL both show as Unknown
    name = F.coalesce(F.nullif("type_raw", F.lit("")), F.lit("Unknown"))
    return long.select("event_date", "hour", name.alias("type"), "event_count")


def heatmap_types(long: DataFrame) -> DataFrame:
    """Types of each day, busiest first, with their totals and labels."""
    totals = _named(long).groupBy("event_date", "type").agg(F.sum("event_count").alias("total"))
    order = W.partitionBy("event_date").orderBy(F.desc("total"), F.asc("type"))
    return totals.withColumns(
        {"label": type_label(F.col("type")), "type_order": F.row_number().over(order)}
    )


def activity_heatmap_matrix(long: DataFrame) -> DataFrame:
    """One row per day and type, columns h00..h23, zeros where nothing ran.

    An hour outside 0-23 counts in the total but in no cell.
    """
    named = _named(long)
    cells = [
        F.coalesce(F.sum(F.when(F.col("hour") == hour, F.col("event_count"))), F.lit(0)).alias(
            f"h{hour:02d}"
        )
        for hour in HOURS
    ]
    matrix = named.groupBy("event_date", "type").agg(F.sum("event_count").alias("total"), *cells)
    order = W.partitionBy("event_date").orderBy(F.desc("total"), F.asc("type"))
    return matrix.withColumns(
        {"label": type_label(F.col("type")), "type_order": F.row_number().over(order)}
    )


def activity_heatmap_cells(long: DataFrame) -> DataFrame:
    """The matrix as rows: every (hour, type) of a day, zero-filled.

    The 24 hours are exploded from each type row, so no cross join is made.
    """
    spine = heatmap_types(long).withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    counted = (
        _named(long).groupBy("event_date", "type", "hour").agg(F.sum("event_count").alias("event_count"))
    )
    return (
        spine.join(counted, ["event_date", "type", "hour"], "left")
        .withColumn("event_count", F.coalesce("event_count", F.lit(0)))
        .select("event_date", "hour", "type_order", "type", "label", "total", "event_count")
    )


def heatmap_coverage(long: DataFrame) -> DataFrame:
    """Events with a known dimension; every event has a type, so all of them."""
    return (
        long.groupBy("event_date")
        .agg(F.sum("event_count").alias("total_events"))
        .withColumns({"known_events": F.col("total_events"), "known_pct": F.lit(100.0)})
    )
