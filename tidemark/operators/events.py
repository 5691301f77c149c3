"""Bronze rows to clean, deduplicated silver events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.languages import (
    normalize_language,
    parsed_payload,
    raw_language,
    scalar_or_null,
)
from tidemark.functions.scalars import utc_timestamp
from tidemark.schemas import CORRUPT, HOUR_PARTS, SILVER

ARCHIVE, LIVE = "archive", "live"
REASON = "reject_reason"


def has_readable_time(created_at: Column) -> Column:
    """A missing time is allowed; text that is no time is not."""
    return created_at.isNull() | utc_timestamp(created_at).isNotNull()


def with_reject_reason(lines: DataFrame) -> DataFrame:
    """Why a delivery cannot enter silver; NULL when it can."""
    reason = F.when(F.col("id").isNull(), "no id").when(
        ~has_readable_time(F.col("created_at")), "unreadable created_at"
    )
    if CORRUPT in lines.columns:
        reason = F.when(F.col(CORRUPT).isNotNull(), "malformed line").otherwise(reason)
    return lines.withColumn(REASON, reason)


def flatten_event(bronze: DataFrame, source: str) -> DataFrame:
    """Nested bronze event to flat columns, tagged with where it came from.

    The text of a malformed line and the reject reason stay when present.
    """
    arrived = F.col("ingested_at") if "ingested_at" in bronze.columns else F.lit(None).cast("string")
    return bronze.select(
        "id",
        "type",
        F.col("actor.id").alias("actor_id"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"),
        F.col("repo.name").alias("repo_name"),
        "payload",
        "public",
        "created_at",
        F.col("org.login").alias("org_login"),
        F.lit(source).alias("source"),
        arrived.alias("ingested_at"),
        *HOUR_PARTS,
        *[name for name in (CORRUPT, REASON) if name in bronze.columns],
    )


def union_sources(archive: DataFrame, live: DataFrame) -> DataFrame:
    """Every delivery of both bronze tables, flattened (UNION ALL)."""
    return flatten_event(archive, ARCHIVE).unionByName(flatten_event(live, LIVE))


def _first_per_id(deliveries: DataFrame, per: list[str], preferred: str, tie: Column) -> DataFrame:
    # rn = 1 lets Spark keep one row per key in each map task before the
    # shuffle (WindowGroupLimit), so an id with very many copies stays cheap
    order = [
        F.when(F.col("source") == preferred, 0).otherwise(1),
        utc_timestamp(F.col("ingested_at")).asc_nulls_last(),
        tie,
    ]
    # id first: it differs between rows, so the sort settles on its prefix
    window = W.partitionBy("id", *per).orderBy(*order)
    ranked = deliveries.where(F.col("id").isNotNull()).withColumn("_rn", F.row_number().over(window))
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def dedup_live_first(deliveries: DataFrame) -> DataFrame:
    """One delivery per (day, id): live before archive, then first arrival.

    Days are separate on purpose: an id delivered on both sides of midnight
    counts on both days.
    """
    tie = F.xxhash64("created_at", "type", "repo_id", "repo_name", "actor_id", "payload")
    return _first_per_id(deliveries, ["year", "month", "day"], LIVE, tie)


def dedup_archive_first(deliveries: DataFrame) -> DataFrame:
    """One delivery per (hour, id): archive before live, then first arrival."""
    tie = F.xxhash64("type", "repo_id", "repo_name", "actor_id")
    return _first_per_id(deliveries, HOUR_PARTS, ARCHIVE, tie)


def normalize_events(deduped: DataFrame) -> DataFrame:
    """Typed silver columns: timestamp, payload action, canonical language.

    The hour stays the partition hour of the delivery that won.
    """
    parsed = deduped.where(has_readable_time(F.col("created_at"))).withColumn(
        "_payload", parsed_payload(F.col("payload"))
    )
    return parsed.select(
        F.col("id").alias("event_id"),
        "type",
        "actor_login",
        "actor_id",
        "repo_name",
        "repo_id",
        "payload",
        scalar_or_null(F.col("_payload.action")).alias("payload_action"),
        "public",
        utc_timestamp(F.col("created_at")).alias("created_at"),
        "org_login",
        normalize_language(raw_language(F.col("_payload"))).alias("repo_language"),
        "source",
        *HOUR_PARTS,
    ).select(*SILVER.fieldNames(), *HOUR_PARTS)


def silver_events(archive: DataFrame, live: DataFrame) -> DataFrame:
    """Both bronze tables to silver, any number of days at once."""
    return normalize_events(dedup_live_first(union_sources(archive, live)))


def rejected_deliveries(archive: DataFrame, live: DataFrame) -> DataFrame:
    """Deliveries that cannot enter silver, with the reason."""
    both = union_sources(with_reject_reason(archive), with_reject_reason(live))
    return both.where(F.col(REASON).isNotNull())
