"""Five-minute metrics, star velocity and the bot/viral distinction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLOT_MINUTES = 5
SLOTS_PER_HOUR = 60 // SLOT_MINUTES
SLOTS_PER_DAY = 24 * SLOTS_PER_HOUR


def repo_metrics_5min(silver: DataFrame, approximate: bool = True) -> DataFrame:
    """Repository x 5-minute slot; exact or sketched distinct actors.

    Both forms combine map-side. The sketch saves the second shuffle.
    """
    actors = F.approx_count_distinct("actor_id") if approximate else F.countDistinct("actor_id")
    slot = F.window("created_at", f"{SLOT_MINUTES} minutes").getField("start")

    def kind(name: str):
        return F.count_if(F.col("type") == name)

    return (
        silver.where(F.col("created_at").isNotNull())
        .groupBy("repo_id", slot.alias("ts_5min"))
        .agg(
            F.max("repo_name").alias("repo_name"),
            kind("WatchEvent").alias("star_count"),
            kind("ForkEvent").alias("fork_count"),
            kind("PullRequestEvent").alias("pr_count"),
            kind("PushEvent").alias("commit_count"),
            actors.alias("unique_actors"),
            F.max("repo_language").alias("primary_language"),
        )
    )


def repo_velocity(metrics: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Stars of a slot against the 24 hours before it, and against an hour ago.

    A slot without a row is a slot with 0 stars. It adds nothing to the sum
    or the sum of squares, so range frames over the rows that exist give the
    zero-filled mean and population deviation without building empty slots.

    A window group is one day of a repository, with a halo: the rows of the
    day before that have stars, copied. So the history of a busy repository is
    many groups, and a day can be computed from two days of input.
    """
    slot = F.floor(F.unix_micros(F.col("ts_5min").cast("timestamp")) / (SLOT_MINUTES * 60_000_000))
    by_repo = W.partitionBy("repo_id", "day").orderBy("slot")
    day_before = by_repo.rangeBetween(-SLOTS_PER_DAY, -1)
    hour_ago = by_repo.rangeBetween(-SLOTS_PER_HOUR, -SLOTS_PER_HOUR)
    stars = F.col("star_count")

    framed = (
        metrics.select("repo_id", "repo_name", "ts_5min", "star_count", slot.alias("slot"))
        # 1 is the copy for the day after
        .withColumn("halo", F.explode(F.when(stars > 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .withColumn("day", F.floor(F.col("slot") / SLOTS_PER_DAY) + F.col("halo"))
        .withColumns(
            {
                "s1": F.coalesce(F.sum(stars).over(day_before), F.lit(0)),
                "s2": F.coalesce(F.sum(stars * stars).over(day_before), F.lit(0)),
                "star_1h_ago": F.coalesce(F.sum(stars).over(hour_ago), F.lit(0)),
            }
        )
        .where(F.col("halo") == 0)
    )
    n = SLOTS_PER_DAY
    mean = F.col("s1").cast("double") / n
    # n * s2 - s1^2 is a whole number, so no digits cancel
    std = F.sqrt((n * F.col("s2") - F.col("s1") * F.col("s1")).cast("double")) / n
    scored = framed.withColumns({"star_avg_24h": mean, "star_std_24h": std}).withColumn(
        "z_score", (stars - F.col("star_avg_24h")) / F.nullif("star_std_24h", F.lit(0.0))
    )
    return scored.withColumns(
        {
            "anomaly_flag": F.coalesce(F.col("z_score") > threshold, F.lit(False)),
            "delta_stars_per_hour": (stars - F.col("star_1h_ago")) * SLOTS_PER_HOUR,
        }
    ).drop("slot", "halo", "day", "s1", "s2")


def anomaly_kind(daily: DataFrame, bot_below: float = 0.2) -> DataFrame:
    """Few actors behind many events look like a bot, many like a viral run."""
    ratio = F.col("unique_actors").cast("double") / F.nullif(
        F.col("event_count").cast("double"), F.lit(0.0)
    )
    return daily.select("event_date", "repo_id", "repo_name", "event_count", "unique_actors").withColumns(
        {
            "actor_ratio": ratio,
            "anomaly_kind": F.when(ratio < bot_below, "bot").when(ratio >= bot_below, "viral"),
        }
    )
