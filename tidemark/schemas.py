"""Fixed table schemas. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(columns: str, **structs: T.StructType) -> T.StructType:
    """Schema of 'name kind, ...'; usable without a running session."""
    kinds = _KINDS | structs
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in pairs])


_ACTOR = _schema(
    "id bigint, login string, display_login string, gravatar_id string, url string, avatar_url string"
)
_REPO = _schema("id bigint, name string, url string")
_ORG = _schema("id bigint, login string, gravatar_id string, url string, avatar_url string")

DAY_PARTS = ["year", "month", "day"]
HOUR_PARTS = ["year", "month", "day", "hour"]

# text of a line that is no JSON
CORRUPT = "_corrupt_record"

# payload is an object in the file; read into STRING it keeps its JSON text
BRONZE_EVENT = _schema(
    "id string, type string, actor actor, repo repo, payload string, "
    "public boolean, created_at string, org org",
    actor=_ACTOR,
    repo=_REPO,
    org=_ORG,
)
LIVE_EVENT = T.StructType([*BRONZE_EVENT.fields, T.StructField("_ingested_at", T.StringType())])

SILVER = _schema(
    "event_id string, type string, actor_login string, actor_id bigint, repo_name string, "
    "repo_id bigint, payload string, payload_action string, public boolean, "
    "created_at timestamp_ntz, org_login string, repo_language string, source string"
)

_FIVE_COUNTS = (
    "push_count bigint, pr_count bigint, issue_count bigint, watch_count bigint, fork_count bigint"
)

GOLD = {
    "repo_daily": _schema(
        "event_date date, repo_id bigint, repo_name string, event_count bigint, "
        f"unique_actors bigint, dominant_event_type string, {_FIVE_COUNTS}, "
        "first_event_at timestamp_ntz, last_event_at timestamp_ntz"
    ),
    "actor_daily": _schema(
        "event_date date, actor_id bigint, actor_login string, event_count bigint, "
        f"unique_repos bigint, dominant_event_type string, {_FIVE_COUNTS}"
    ),
    "repo_acceleration": _schema(
        "event_date date, repo_id bigint, repo_name string, event_count bigint, "
        "prev_event_count bigint, event_delta bigint, acceleration_ratio double, "
        "dominant_event_type string"
    ),
    "repo_anomaly": _schema(
        "event_date date, repo_id bigint, repo_name string, event_count bigint, "
        "activity_zscore double, watch_count bigint, watch_ratio double, watch_zscore double, "
        "fork_ratio double, fork_zscore double, anomaly_score double"
    ),
    "repo_hourly": _schema(
        "event_date date, hour int, repo_id bigint, repo_name string, event_count bigint, "
        "dominant_event_type string"
    ),
    "language_activity": _schema(
        "event_date date, hour int, language string, event_count bigint, "
        "unique_repos bigint, unique_actors bigint"
    ),
    "hourly_recent": _schema(
        "event_date date, hour int, hour_ts timestamp_ntz, repo_id bigint, repo_name string, "
        f"event_count bigint, unique_actors bigint, {_FIVE_COUNTS}, dominant_event_type string"
    ),
    "repo_enriched": _schema(
        "event_date date, repo_id bigint, repo_name string, category string, "
        "category_confidence double, category_reasoning string, insight_markdown string, "
        "model_id string, generated_at timestamp_ntz"
    ),
}

# hourly_recent stores an `hour` column, so its partition column is hour_p
GOLD_PARTS = {name: DAY_PARTS for name in GOLD} | {"hourly_recent": [*DAY_PARTS, "hour_p"]}

# the document table; (date, repo_name) is its key
DOC_CORE = _schema(
    "repo_id string, event_count int, acceleration_ratio double, "
    "anomaly_score double, watch_zscore double, watch_ratio double, rank_score double, "
    "dominant_event_type string, insight_markdown string, indexed_at timestamp_ntz"
)
DOC_CATEGORY = _schema(
    "category string, category_confidence double, category_reasoning string, "
    "categorized_at timestamp_ntz"
)
DOC_INSIGHT = _schema("repo_insight_markdown string, repo_insight_generated_at timestamp_ntz")
DOCUMENT = T.StructType(
    _schema("date string, repo_name string").fields
    + DOC_CORE.fields
    + DOC_CATEGORY.fields
    + DOC_INSIGHT.fields
)

# what the pulse stores per minute
PULSE_GRAIN = _schema("minute timestamp_ntz, type string, repo_name string, actor_id bigint, n bigint")

# the only payload members any job looks at; parsed once per event
_LANGUAGE = _schema("language string")
_WITH_REPO = _schema("repo language", language=_LANGUAGE)
PAYLOAD = _schema(
    "action string, pull_request pull_request, repository language, forkee language, "
    "release release, head_commit with_repo",
    language=_LANGUAGE,
    with_repo=_WITH_REPO,
    pull_request=_schema("head with_repo, base with_repo", with_repo=_WITH_REPO),
    release=_schema("author with_repo", with_repo=_WITH_REPO),
)
