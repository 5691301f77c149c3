"""Daily and hourly activity marts.

Every mart takes any number of days and carries event_date in its key, so a
nightly one-day build and a full backfill are the same plan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.scalars import COUNTED_TYPES, date_from_parts, guarded_ratio, zscore
from tidemark.operators.events import dedup_archive_first, union_sources
from tidemark.schemas import GOLD


def dated(events: DataFrame) -> DataFrame:
    """Add event_date (and integer hour) from the partition strings."""
    return events.withColumns({"event_date": date_from_parts(), "hour": F.col("hour").cast("int")})


def activity_rollup(
    events: DataFrame,
    keys: list[str],
    label: str | None = None,
    distinct: Mapping[str, str] | None = None,
    times: bool = False,
) -> DataFrame:
    """Per-key counts, exact distincts, dominant type and label in one scan.

    Step 1 counts per (key, type), per (key, label) and per (key, distinct
    value) as grouping sets: primitive hash aggregates, combined map-side and
    shuffled on the whole combination, so the rows of one hot key spread over
    all tasks. Step 2 folds those counts per key.

    The dominant type is the most frequent one; a tie goes to the larger name.
    """
    distinct = dict(distinct or {})
    extras = ["type", *([label] if label else []), *distinct.values()]
    sets = [[*keys, extra] for extra in extras]

    span = []
    if times:
        span = [F.min("created_at").alias("_first"), F.max("created_at").alias("_last")]
    pieces = events.groupingSets(sets, *keys, *extras).agg(
        F.count(F.lit(1)).alias("_n"),
        *span,
        *[F.grouping(extra).alias(f"_not_{extra}") for extra in extras],
    )

    def only(extra: str, value: Column) -> Column:
        return F.when(F.col(f"_not_{extra}") == 0, value)

    n = F.col("_n")
    outputs = [F.sum(only("type", n)).alias("event_count")]
    outputs += [F.count(only(col, F.col(col))).alias(name) for name, col in distinct.items()]
    outputs += [
        F.coalesce(F.sum(only("type", F.when(F.col("type") == kind, n))), F.lit(0)).alias(name)
        for name, kind in COUNTED_TYPES.items()
    ]
    top = F.max(only("type", F.struct(n.alias("n"), F.col("type").alias("type"))))
    outputs.append(top.getField("type").alias("dominant_event_type"))
    if label:
        outputs.append(F.max(only(label, F.col(label))).alias(label))
    if times:
        outputs.append(F.min("_first").alias("first_event_at"))
        outputs.append(F.max("_last").alias("last_event_at"))
    return pieces.groupBy(*keys).agg(*outputs)


def repo_daily(silver: DataFrame) -> DataFrame:
    """Activity per repository and day (a NULL repository is one group)."""
    daily = activity_rollup(
        dated(silver), ["event_date", "repo_id"], "repo_name", {"unique_actors": "actor_id"}, times=True
    )
    return daily.select(*GOLD["repo_daily"].fieldNames())


def actor_daily(silver: DataFrame) -> DataFrame:
    """Activity per actor and day."""
    daily = activity_rollup(
        dated(silver), ["event_date", "actor_id"], "actor_login", {"unique_repos": "repo_id"}
    )
    return daily.select(*GOLD["actor_daily"].fieldNames())


def repo_hourly(silver: DataFrame) -> DataFrame:
    """Activity per repository and hour."""
    hourly = activity_rollup(dated(silver), ["event_date", "hour", "repo_id"], "repo_name")
    return hourly.select(*GOLD["repo_hourly"].fieldNames())


def language_activity(silver: DataFrame) -> DataFrame:
    """Activity per language and hour; Unknown stays a language of its own.

    Both distincts are counted over (hour, language, value) combinations
    first, so the very large Unknown group is never one task.
    """
    events = dated(silver).withColumnRenamed("repo_language", "language")
    keys = ["event_date", "hour", "language"]
    pieces = events.groupingSets(
        [[*keys, "repo_id"], [*keys, "actor_id"]], *keys, "repo_id", "actor_id"
    ).agg(F.count(F.lit(1)).alias("n"), F.grouping("repo_id").alias("not_repo"))
    by_repo = F.col("not_repo") == 0
    return (
        pieces.groupBy(*keys)
        .agg(
            F.sum(F.when(by_repo, F.col("n"))).alias("event_count"),
            F.count(F.when(by_repo, F.col("repo_id"))).alias("unique_repos"),
            F.count(F.when(~by_repo, F.col("actor_id"))).alias("unique_actors"),
        )
        .select(*GOLD["language_activity"].fieldNames())
    )


def hourly_recent(archive: DataFrame, live: DataFrame) -> DataFrame:
    """Repository x hour straight from both bronze tables, archive first.

    Only id, type, actor and repo leave the scan; the payload is not read.
    """
    events = dedup_archive_first(union_sources(archive, live)).where(F.col("repo_id").isNotNull())
    hourly = activity_rollup(
        dated(events), ["event_date", "hour", "repo_id"], "repo_name", {"unique_actors": "actor_id"}
    )
    hour_ts = F.timestamp_add("HOUR", F.col("hour"), F.col("event_date").cast("timestamp_ntz"))
    return hourly.withColumn("hour_ts", hour_ts).select(*GOLD["hourly_recent"].fieldNames())


def join_prev_day(today: DataFrame, previous: DataFrame) -> DataFrame:
    """Counts of the calendar day before, beside each row of ``today``.

    Left join: a repository without a previous day gets NULL, one active only
    on the previous day is dropped, and NULL ids never match.
    """
    shifted = previous.select(
        F.date_add("event_date", 1).alias("event_date"),
        "repo_id",
        F.col("event_count").alias("prev_event_count"),
    )
    return today.join(shifted, ["event_date", "repo_id"], "left")


def with_prev_day(daily: DataFrame) -> DataFrame:
    """``join_prev_day`` of a mart with itself, in one pass over many days.

    A repository has one row per day here, so its window is small however
    busy it is. A gap in the days means there is no previous day.
    """
    window = W.partitionBy("repo_id").orderBy("event_date")
    follows = F.lag("event_date").over(window) == F.date_sub("event_date", 1)
    prev = F.when(follows & F.col("repo_id").isNotNull(), F.lag("event_count").over(window))
    return daily.withColumn("prev_event_count", prev)


def acceleration_columns(with_previous: DataFrame) -> DataFrame:
    prev = F.coalesce("prev_event_count", F.lit(0))
    return with_previous.withColumns(
        {
            "prev_event_count": prev,
            "event_delta": F.col("event_count") - prev,
            "acceleration_ratio": guarded_ratio(F.col("event_count"), F.col("prev_event_count")),
        }
    ).select(*GOLD["repo_acceleration"].fieldNames())


def repo_acceleration(daily: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Day-over-day change, from the repo_daily mart rather than the events.

    With ``previous`` (the mart's day before) the two day folders are joined;
    without it every day of ``daily`` is compared with the one before it.
    """
    both = with_prev_day(daily) if previous is None else join_prev_day(daily, previous)
    return acceleration_columns(both)


def repo_anomaly(daily: DataFrame) -> DataFrame:
    """How far a repository stands from all repositories of its day.

    Population z-scores of activity, watch share and fork share, and their
    Euclidean length. The statistics are one row per calendar date, computed
    with map-side partial aggregates; that table cannot outgrow the calendar,
    which is why it may be broadcast.
    """
    ratios = daily.select(
        "event_date",
        "repo_id",
        "repo_name",
        "event_count",
        "watch_count",
        guarded_ratio(F.col("watch_count"), F.col("event_count")).alias("watch_ratio"),
        guarded_ratio(F.col("fork_count"), F.col("event_count")).alias("fork_ratio"),
    )
    measures = {
        "activity": F.col("event_count").cast("double"),
        "watch": F.col("watch_ratio"),
        "fork": F.col("fork_ratio"),
    }
    stats = ratios.groupBy("event_date").agg(
        *[F.avg(value).alias(f"{name}_mean") for name, value in measures.items()],
        *[F.stddev_pop(value).alias(f"{name}_std") for name, value in measures.items()],
    )
    scored = ratios.join(F.broadcast(stats), "event_date").withColumns(
        {
            f"{name}_zscore": zscore(value, F.col(f"{name}_mean"), F.col(f"{name}_std"))
            for name, value in measures.items()
        }
    )
    length = F.sqrt(sum((F.pow(f"{name}_zscore", F.lit(2.0)) for name in measures), F.lit(0.0)))
    return scored.withColumn("anomaly_score", length).select(*GOLD["repo_anomaly"].fieldNames())


def daily_counts(silver: DataFrame) -> DataFrame:
    """event_count per repository and day only, where no mart exists yet."""
    return dated(silver).groupBy("event_date", "repo_id").agg(F.count(F.lit(1)).alias("event_count"))

