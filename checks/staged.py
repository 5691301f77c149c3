"""Lake tables of a feed, written once per session to the shared folder.

Serving queries read these tables the way they read a nightly build: column
pruned Parquet, no silver recomputed per query, nothing lost with an
executor. Each table is built the first time something needs it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import feed
from tidemark.operators import marts
from tidemark.operators.events import silver_events
from tidemark.schemas import DAY_PARTS
from tidemark.session import configure, new_stage_path
from tidemark.sources.tables import read_gold, read_silver, with_date_parts, write_gold, write_silver

_roots: dict[tuple[str, str], str] = {}
_built: set[tuple[str, str]] = set()


def root_of(spark: SparkSession, sf_dir: str) -> str:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _roots:
        configure(spark)
        _roots[key] = new_stage_path(spark, "lake")
    return _roots[key]


def once(root: str, table: str, build: Callable[[], None]) -> None:
    if (root, table) not in _built:
        build()
        _built.add((root, table))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = root_of(spark, sf_dir)

    def build() -> None:
        events = silver_events(feed.bronze_archive(spark, sf_dir), feed.bronze_live(spark, sf_dir))
        write_silver(events, root, parts=DAY_PARTS)

    once(root, "silver", build)
    return read_silver(spark, root)


def gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    root = root_of(spark, sf_dir)

    def build() -> None:
        if name == "hourly_recent":
            recent = marts.hourly_recent(
                feed.bronze_archive(spark, sf_dir), feed.bronze_live(spark, sf_dir)
            )
            mart = with_date_parts(recent).withColumn("hour_p", F.format_string("%02d", "hour"))
        elif name in ("repo_acceleration", "repo_anomaly"):
            mart = with_date_parts(getattr(marts, name)(gold(spark, sf_dir, "repo_daily")))
        else:
            mart = with_date_parts(getattr(marts, name)(silver(spark, sf_dir)))
        write_gold(mart, root, name, parts=DAY_PARTS)

    once(root, name, build)
    return read_gold(spark, root, name)
