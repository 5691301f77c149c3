"""Small numeric, time and naming expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event types counted in every mart, and the column each feeds.
COUNTED_TYPES = {
    "push_count": "PushEvent",
    "pr_count": "PullRequestEvent",
    "issue_count": "IssuesEvent",
    "watch_count": "WatchEvent",
    "fork_count": "ForkEvent",
}

# Label shown for each event type; other types show as they are.
TYPE_LABELS = {
    "PushEvent": "Push",
    "PullRequestEvent": "PR",
    "PullRequestReviewEvent": "PR 리뷰",
    "PullRequestReviewCommentEvent": "PR 코멘트",
    "IssuesEvent": "Issue",
    "IssueCommentEvent": "Issue 코멘트",
    "WatchEvent": "Star",
    "ForkEvent": "Fork",
    "CreateEvent": "생성",
    "DeleteEvent": "삭제",
    "ReleaseEvent": "Release",
    "PublicEvent": "공개",
    "GollumEvent": "Wiki",
    "MemberEvent": "멤버",
    "CommitCommentEvent": "Commit 코멘트",
}

# Name fragments of bots, casinos and sandboxes.
BOT_NAME_PATTERN = (
    r"(?i)(trading[-_]?bot|copy[-_]?bot|arbitrage|casino|sandbox|playground)"
    r"|/[0-9]+$"
)

REPO_NAME_PATTERN = r"^[A-Za-z0-9._-]+/[A-Za-z0-9._-]+$"
DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def utc_timestamp(text: Column) -> Column:
    """ISO text to a UTC wall clock; offsets are converted, bad text is NULL."""
    return text.try_cast("timestamp").cast("timestamp_ntz")


def utc_now() -> Column:
    return F.current_timestamp().cast("timestamp_ntz")


def padded(number: Column, digits: int) -> Column:
    return F.lpad(number.cast("string"), digits, "0")


def date_parts(ts: Column) -> dict[str, Column]:
    """Zero-padded partition values of a date or timestamp."""
    return {
        "year": padded(F.year(ts), 4),
        "month": padded(F.month(ts), 2),
        "day": padded(F.day(ts), 2),
    }


def hour_parts(ts: Column) -> dict[str, Column]:
    return date_parts(ts) | {"hour": padded(F.hour(ts), 2)}


def date_from_parts() -> Column:
    """event_date of a row from its year/month/day partition strings."""
    return F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))


def minute_of(ts: Column) -> Column:
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def korea_hour(utc_hour: Column) -> Column:
    return F.pmod(utc_hour + 9, F.lit(24))


def safe_double(text: Column) -> Column:
    """Number from text; NULL for empty, unreadable or NaN."""
    number = text.try_cast("double")
    return F.when(~F.isnan(number), number)


def safe_int(text: Column) -> Column:
    """Whole part of a number in text ('50.0' is 50); NULL when unreadable."""
    return safe_double(text).try_cast("int")


def guarded_ratio(top: Column, bottom: Column) -> Column:
    """top / bottom as double, NULL when bottom is 0 or NULL."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def zscore(value: Column, mean: Column, std: Column) -> Column:
    """Population z-score; 0 where the spread is 0 or the value is missing."""
    return F.coalesce((value - mean) / F.nullif(std, F.lit(0.0)), F.lit(0.0))


def type_label(event_type: Column) -> Column:
    pairs = [F.lit(part) for pair in TYPE_LABELS.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), event_type), event_type)


def is_bot_name(name: Column) -> Column:
    return F.coalesce(name.rlike(BOT_NAME_PATTERN), F.lit(False))


def is_repo_name(name: Column) -> Column:
    return F.coalesce(name.rlike(REPO_NAME_PATTERN), F.lit(False))


def is_date_text(text: Column) -> Column:
    """A real calendar day in YYYY-MM-DD form (2026-99-99 is refused)."""
    return F.coalesce(text.rlike(DATE_PATTERN) & F.try_to_date(text, "yyyy-MM-dd").isNotNull(), F.lit(False))
