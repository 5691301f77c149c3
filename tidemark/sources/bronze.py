"""Bronze layer: gzip JSON lines below year=/month=/day=/hour=."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import hour_parts, utc_now, utc_timestamp
from tidemark.schemas import BRONZE_EVENT, CORRUPT, HOUR_PARTS, LIVE_EVENT
from tidemark.sources.paths import day_folder, hour_path, part_condition, path_has_data


def _read_lines(spark: SparkSession, root: str, schema: T.StructType, day, hour) -> DataFrame:
    parts = [T.StructField(name, T.StringType()) for name in HOUR_PARTS]
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType()), *parts])
    folder = day_folder(spark, root, day)
    if folder is None:
        return spark.createDataFrame([], full)
    lines = (
        spark.read.schema(full)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("basePath", root)
        .json(folder)
    )
    return lines if day is None else lines.where(part_condition(day, hour))


def read_bronze_archive(
    spark: SparkSession, root: str, day: str | None = None, hour: int | None = None
) -> DataFrame:
    """Archive events; a malformed line is an all-NULL row with its text kept.

    Gzip files are read by one task each; the first shuffle (the id dedup)
    spreads the rows, so no extra repartition is made here.
    """
    return _read_lines(spark, root, BRONZE_EVENT, day, hour)


def read_bronze_live(
    spark: SparkSession, root: str, day: str | None = None, hour: int | None = None
) -> DataFrame:
    """Live events, with the arrival time as ``ingested_at``."""
    return _read_lines(spark, root, LIVE_EVENT, day, hour).withColumnRenamed(
        "_ingested_at", "ingested_at"
    )


def quarantine_malformed(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad lines): unreadable lines and rows without an id."""
    is_bad = F.col(CORRUPT).isNotNull() | F.col("id").isNull()
    good = lines.where(~is_bad).drop(CORRUPT)
    bad = lines.where(is_bad).select(CORRUPT, "type", "created_at", *HOUR_PARTS)
    return good, bad


def partition_time(created_at: Column, arrived_at: Column | None = None) -> Column:
    """When an event counts: its own time, else its arrival, else now."""
    fallback = [] if arrived_at is None else [utc_timestamp(arrived_at)]
    return F.coalesce(utc_timestamp(created_at), *fallback, utc_now())


def partition_by_created_at(events: DataFrame, arrived_at: str | None = "_ingested_at") -> DataFrame:
    """Add year/month/day/hour of the event's own (UTC) time."""
    arrival = F.col(arrived_at) if arrived_at else None
    placed = events.withColumn("_at", partition_time(F.col("created_at"), arrival))
    return placed.withColumns(hour_parts(F.col("_at"))).drop("_at")


def write_jsonl_gz(events: DataFrame, path: str, partitioned: bool = True, mode: str = "append") -> None:
    """One JSON object per line, gzip; partition columns go into the path.

    Rebalancing by hour lets AQE cut a heavy hour into several files and
    merge light ones.
    """
    if partitioned:
        events = events.hint("rebalance", *HOUR_PARTS)
    writer = events.write.mode(mode).option("compression", "gzip")
    if partitioned:
        writer = writer.partitionBy(*HOUR_PARTS)
    writer.json(path)


def append_archive_hour(spark: SparkSession, src: str, root: str, day: str, hour: int) -> bool:
    """Land one publisher file as an archive hour, once.

    Returns False and changes nothing when the hour already holds data.
    The lines are copied as text, so malformed ones reach bronze unchanged.
    """
    target = hour_path(root, day, hour)
    if path_has_data(spark, target):
        return False
    lines = spark.read.text(src)
    if lines.isEmpty():
        raise RuntimeError(f"empty archive file {src}")
    # overwrite only clears what a failed earlier attempt left: empty files
    lines.write.mode("overwrite").option("compression", "gzip").text(target)
    return True
