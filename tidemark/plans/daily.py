"""Daily builds: bronze to silver, silver to the six gold marts."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import marts, quality
from tidemark.operators.events import (
    REASON,
    dedup_live_first,
    normalize_events,
    union_sources,
    with_reject_reason,
)
from tidemark.schemas import CORRUPT
from tidemark.session import configure, path_bytes, size_shuffles
from tidemark.sources.bronze import read_bronze_archive, read_bronze_live
from tidemark.sources.paths import day_path, delete_path, previous_day
from tidemark.sources.tables import (
    overwrite_day,
    read_gold,
    read_silver,
    with_date_parts,
    write_gold,
)

# gzip JSON grows to several times its size once parsed into rows
GZIP_GROWTH = 8


def build_silver(spark: SparkSession, root: str, day: str) -> dict[str, int]:
    """Rebuild one silver day; nothing is replaced when bronze is empty.

    Unreadable lines and deliveries that cannot be typed go to quarantine/,
    so no input row disappears without a trace. They are counted while silver
    is written, and bronze is only read again when there are any.
    """
    configure(spark)
    size = sum(path_bytes(spark, day_path(f"{root}/bronze/{s}", day)) for s in ("archive", "live"))
    size_shuffles(spark, size * GZIP_GROWTH)
    archive = with_reject_reason(read_bronze_archive(spark, f"{root}/bronze/archive", day))
    live = with_reject_reason(read_bronze_live(spark, f"{root}/bronze/live", day))
    deliveries = union_sources(archive, live)
    is_good = F.col(REASON).isNull()
    if deliveries.where(is_good).isEmpty():
        raise quality.EmptyLayerError(f"bronze has no rows for {day}")

    watch = Observation("rejected")
    counted = deliveries.observe(watch, F.count_if(~is_good).alias("rejected"))
    good = counted.where(is_good).drop(REASON, CORRUPT)
    silver = normalize_events(dedup_live_first(good))
    overwrite_day(silver, f"{root}/silver/events", day, ["hour"])

    if watch.get["rejected"]:
        overwrite_day(deliveries.where(~is_good), f"{root}/quarantine", day)
    else:
        delete_path(spark, day_path(f"{root}/quarantine", day))

    report = quality.verify_silver(read_silver(spark, root, day)).first()
    if report is None:
        raise quality.EmptyLayerError(f"silver has no rows for {day}")
    return {k: v for k, v in report.asDict().items() if k != "event_date"}


def previous_counts(spark: SparkSession, root: str, day: str) -> DataFrame:
    """Counts of the day before ``day``: from its mart, else from its events."""
    before = previous_day(day)
    mart = read_gold(spark, root, "repo_daily", before)
    if not mart.isEmpty():
        return mart
    return marts.daily_counts(read_silver(spark, root, before))


def build_gold(spark: SparkSession, root: str, day: str) -> dict[str, int]:
    """Rebuild the six daily marts of one day.

    Silver is checked before anything is replaced. The four marts that need
    events are written side by side; acceleration and anomaly then read the
    repo_daily mart, which is far smaller than the events.
    """
    configure(spark)
    size_shuffles(spark, path_bytes(spark, day_path(f"{root}/silver/events", day)))
    silver = read_silver(spark, root, day)
    quality.require_silver(silver, day)

    def write(name: str, mart: DataFrame) -> None:
        overwrite_day(with_date_parts(mart), f"{root}/gold/{name}", day)

    from_events = {
        "repo_daily": marts.repo_daily,
        "actor_daily": marts.actor_daily,
        "repo_hourly": marts.repo_hourly,
        "language_activity": marts.language_activity,
    }
    with ThreadPoolExecutor(len(from_events)) as pool:
        jobs = [pool.submit(write, name, make(silver)) for name, make in from_events.items()]
        for job in jobs:
            job.result()

    today = read_gold(spark, root, "repo_daily", day)
    write("repo_acceleration", marts.repo_acceleration(today, previous_counts(spark, root, day)))
    write("repo_anomaly", marts.repo_anomaly(today))

    written = {name: read_gold(spark, root, name, day) for name in quality.MART_COLUMNS}
    return quality.require_gold(quality.verify_gold(written), day)


def backfill_gold(spark: SparkSession, root: str) -> None:
    """All six marts for every silver day, one job per mart instead of per day.

    Raises, changing nothing, when silver is empty; days that silver does not
    hold keep their marts.
    """
    silver = read_silver(spark, root)
    if silver.isEmpty():
        raise quality.EmptyLayerError("silver has no rows")
    from_events = {
        "repo_daily": marts.repo_daily,
        "actor_daily": marts.actor_daily,
        "repo_hourly": marts.repo_hourly,
        "language_activity": marts.language_activity,
    }
    with ThreadPoolExecutor(len(from_events)) as pool:
        jobs = [
            pool.submit(write_gold, with_date_parts(make(silver)), root, name)
            for name, make in from_events.items()
        ]
        for job in jobs:
            job.result()
    daily = read_gold(spark, root, "repo_daily")
    write_gold(with_date_parts(marts.repo_acceleration(daily)), root, "repo_acceleration")
    write_gold(with_date_parts(marts.repo_anomaly(daily)), root, "repo_anomaly")


def backfill_hourly(archive: DataFrame, live: DataFrame, root: str) -> None:
    """The hourly mart of every bronze hour at once; other hours stay."""
    if archive.isEmpty():
        raise quality.EmptyLayerError("the archive has no rows")
    recent = with_date_parts(marts.hourly_recent(archive, live))
    write_gold(recent.withColumn("hour_p", F.format_string("%02d", "hour")), root, "hourly_recent")
