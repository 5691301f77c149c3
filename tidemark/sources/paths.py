"""Partition paths, pruning filters and file-system checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def parts_of(day: str) -> dict[str, str]:
    """{'year': '2024', 'month': '01', 'day': '15'} of a YYYY-MM-DD day."""
    date = dt.date.fromisoformat(day)
    return {"year": f"{date.year:04d}", "month": f"{date.month:02d}", "day": f"{date.day:02d}"}


def previous_day(day: str) -> str:
    return (dt.date.fromisoformat(day) - dt.timedelta(days=1)).isoformat()


def day_path(root: str, day: str) -> str:
    return "/".join([root, *[f"{k}={v}" for k, v in parts_of(day).items()]])


def hour_path(root: str, day: str, hour: int, column: str = "hour") -> str:
    return f"{day_path(root, day)}/{column}={hour:02d}"


def part_condition(day: str, hour: int | None = None, hour_column: str = "hour") -> Column:
    """Literal equality on the partition columns, so Spark prunes paths."""
    wanted = parts_of(day)
    if hour is not None:
        wanted[hour_column] = f"{hour:02d}"
    condition = F.lit(True)
    for name, value in wanted.items():
        condition = condition & (F.col(name) == value)
    return condition


def day_folder(spark: SparkSession, root: str, day: str | None) -> str | None:
    """What to read for a day: its own folder, so no other day is listed.

    None when there is nothing. A folder written by a streaming file sink is
    read from its root, because only its log tells which files count.
    """
    if day is None or path_exists(spark, f"{root}/_spark_metadata"):
        return root if path_exists(spark, root) else None
    folder = day_path(root, day)
    return folder if path_exists(spark, folder) else None


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path`` (a listing of partition folders)."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def path_has_data(spark: SparkSession, path: str) -> bool:
    """A finished write (it left its marker) with at least one non-empty data file."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return False
    files = {status.getPath().getName(): status.getLen() for status in fs.listStatus(hadoop_path)}
    return "_SUCCESS" in files and any(
        size > 0 and not name.startswith(("_", ".")) for name, size in files.items()
    )


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.delete(hadoop_path, True)
