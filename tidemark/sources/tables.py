"""Silver, gold and document tables: Parquet (Snappy) in partition folders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import date_parts
from tidemark.schemas import DAY_PARTS, DOCUMENT, GOLD, GOLD_PARTS, HOUR_PARTS, SILVER
from tidemark.sources.paths import (
    child_names,
    day_folder,
    day_path,
    delete_path,
    hour_path,
    part_condition,
    path_exists,
)


def _read(
    spark: SparkSession, path: str, schema: T.StructType, parts: list[str], day: str | None
) -> DataFrame:
    full = T.StructType([*schema.fields, *[T.StructField(p, T.StringType()) for p in parts]])
    folder = day_folder(spark, path, day)
    if folder is None:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(folder)


def read_silver(
    spark: SparkSession, root: str, day: str | None = None, hour: int | None = None
) -> DataFrame:
    events = _read(spark, f"{root}/silver/events", SILVER, HOUR_PARTS, day)
    return events if day is None else events.where(part_condition(day, hour))


def read_gold(spark: SparkSession, root: str, name: str, day: str | None = None) -> DataFrame:
    mart = _read(spark, f"{root}/gold/{name}", GOLD[name], GOLD_PARTS[name], day)
    return mart if day is None else mart.where(part_condition(day))


def with_date_parts(mart: DataFrame, date_column: str = "event_date") -> DataFrame:
    """Add the year/month/day partition strings of a mart's date."""
    return mart.withColumns(date_parts(F.col(date_column)))


def write_silver(
    events: DataFrame, root: str, mode: str = "overwrite", parts: list[str] = HOUR_PARTS
) -> None:
    """The days of ``events`` at once (backfill), other days stay; folders are rebalanced by size.

    With day folders only (``parts``) the hour stays a column of the files,
    which readers do not notice; that suits feeds with tiny hours.
    """
    (
        events.hint("rebalance", *parts)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(f"{root}/silver/events")
    )


def write_gold(
    mart: DataFrame, root: str, name: str, mode: str = "overwrite", parts: list[str] | None = None
) -> None:
    """The days of ``mart`` at once (backfill); other days stay."""
    parts = parts or GOLD_PARTS[name]
    ordered = mart.select(*GOLD[name].fieldNames(), *GOLD_PARTS[name])
    (
        ordered.hint("rebalance", *parts)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(f"{root}/gold/{name}")
    )


def overwrite_day(rows: DataFrame, table_path: str, day: str, sub_parts: list[str] | None = None) -> None:
    """Replace one whole day of a table, hours that no longer occur included.

    The write goes into the day's own folder, so no other day is listed or
    touched and hours left by an earlier run of the day disappear.
    """
    sub_parts = sub_parts or []
    body = rows.where(part_condition(day)).drop(*DAY_PARTS)
    if sub_parts:
        body = body.hint("rebalance", *sub_parts)
    writer = body.write.mode("overwrite")
    if sub_parts:
        writer = writer.partitionBy(*sub_parts)
    writer.parquet(day_path(table_path, day))


def overwrite_hour(
    rows: DataFrame, table_path: str, day: str, hour: int, hour_column: str = "hour"
) -> None:
    """Replace one hour of a table."""
    body = rows.where(part_condition(day, hour, hour_column)).drop(*DAY_PARTS, hour_column)
    body.write.mode("overwrite").parquet(hour_path(table_path, day, hour, hour_column))


def read_documents(spark: SparkSession, root: str, date: str | None = None) -> DataFrame:
    path = f"{root}/documents"
    folder = path if date is None else f"{path}/date={date}"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], DOCUMENT)
    fields = [f for f in DOCUMENT.fields if f.name != "date"]
    schema = T.StructType([*fields, T.StructField("date", T.StringType())])
    stored = spark.read.schema(schema).option("basePath", path).parquet(folder)
    return stored.select(*DOCUMENT.fieldNames())


def export_csv(rows: DataFrame, path: str) -> None:
    """Result download: CSV with a header line."""
    rows.write.mode("overwrite").option("header", True).csv(path)


def expired_days(spark: SparkSession, root: str, today: str, days: int = 14) -> list[str]:
    """Days of a bronze table older than ``days`` before ``today``."""
    limit = dt.date.fromisoformat(today) - dt.timedelta(days=days)
    found = []
    for year in child_names(spark, root):
        for month in child_names(spark, f"{root}/{year}"):
            for day in child_names(spark, f"{root}/{year}/{month}"):
                values = [name.partition("=")[2] for name in (year, month, day)]
                if all(value.isdigit() for value in values):
                    date = dt.date(*map(int, values))
                    if date < limit:
                        found.append(date.isoformat())
    return found


def expire_bronze(spark: SparkSession, root: str, today: str, days: int = 14) -> list[str]:
    """Delete bronze days older than ``days``; runs only when called."""
    expired = expired_days(spark, root, today, days)
    for day in expired:
        delete_path(spark, day_path(root, day))
    return expired
