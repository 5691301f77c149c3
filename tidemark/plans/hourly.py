"""Hourly build: both bronze tables straight to the hourly mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.marts import hourly_recent
from tidemark.session import configure, path_bytes, size_shuffles
from tidemark.sources.bronze import quarantine_malformed, read_bronze_archive, read_bronze_live
from tidemark.sources.paths import delete_path, hour_path, part_condition
from tidemark.sources.tables import overwrite_hour, read_gold, with_date_parts

HOURS_BACK = 2
# gzip JSON grows to several times its size once parsed into rows
GZIP_GROWTH = 8


def target_hour(now: dt.datetime, hours_back: int = HOURS_BACK) -> tuple[str, int]:
    """(day, hour) a run at ``now`` builds: late enough for the archive."""
    if now.tzinfo is not None:
        now = now.astimezone(dt.timezone.utc)
    then = now - dt.timedelta(hours=hours_back)
    return then.date().isoformat(), then.hour


def build_hour(spark: SparkSession, root: str, day: str, hour: int) -> int:
    """Rebuild one hour; raises, changing nothing, until the archive is there."""
    configure(spark)
    size = sum(path_bytes(spark, hour_path(f"{root}/bronze/{s}", day, hour)) for s in ("archive", "live"))
    size_shuffles(spark, size * GZIP_GROWTH)
    archive, bad_archive = quarantine_malformed(
        read_bronze_archive(spark, f"{root}/bronze/archive", day, hour)
    )
    live, bad_live = quarantine_malformed(read_bronze_live(spark, f"{root}/bronze/live", day, hour))
    label = f"{day} hour {hour:02d}"
    quality.require_sources(archive, live, label)

    mart = with_date_parts(hourly_recent(archive, live)).withColumn(
        "hour_p", F.format_string("%02d", "hour")
    )
    overwrite_hour(mart, f"{root}/gold/hourly_recent", day, hour, "hour_p")
    # the day's own quarantine is written by the silver build; these are the hour's
    rejected = bad_archive.unionByName(bad_live)
    if rejected.isEmpty():
        delete_path(spark, hour_path(f"{root}/quarantine_hourly", day, hour))
    else:
        overwrite_hour(rejected, f"{root}/quarantine_hourly", day, hour)
    written = read_gold(spark, root, "hourly_recent").where(part_condition(day, hour, "hour_p"))
    return quality.require_hourly(written, label)
