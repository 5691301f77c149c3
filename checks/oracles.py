"""DuckDB SQL for the registered queries, written independently of them."""

from __future__ import annotations

# --- shared parts, each a chain of common table expressions ---------------

DELIVERIES = """
sent AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         unnest(CASE WHEN event_id % 30 = 0 THEN [30, 90]
                     WHEN event_id % 10 = 0 THEN [30]
                     WHEN event_id % 3 = 0 THEN [NULL, 30]
                     ELSE [NULL] END::INTEGER[]) AS delay
  FROM events
),
deliveries AS (
  SELECT CAST(event_id AS VARCHAR) AS id,
         CASE event_type WHEN 'click' THEN 'PushEvent' WHEN 'view' THEN 'WatchEvent'
              WHEN 'purchase' THEN 'PullRequestEvent' WHEN 'signup' THEN 'ForkEvent'
              WHEN 'error' THEN 'IssuesEvent' END AS type,
         user_id AS actor_id,
         'user-' || user_id AS actor_login,
         CAST(k % 50 AS BIGINT) AS repo_id,
         'org/repo-' || (k % 50) || CASE WHEN k >= 50 THEN '-v2' ELSE '' END AS repo_name,
         k % 8 AS shape,
         CASE k % 8
           WHEN 0 THEN '{"action":"started","forkee":{"language":"js"}}'
           WHEN 1 THEN '{"action":"opened","pull_request":{"head":{"repo":{"language":"Python"}},"base":{"repo":{"language":"Go"}}}}'
           WHEN 2 THEN '{"action":"closed","pull_request":{"head":{"repo":null},"base":{"repo":{"language":"golang"}}}}'
           WHEN 3 THEN '{"repository":{"language":"c++"}}'
           WHEN 4 THEN '{"repository":{"language":""}}'
           WHEN 5 THEN '{"action":null}'
           WHEN 6 THEN '{"action":"created","forkee":{"language":"Haskell"}}'
           ELSE '{"release":{"author":{"repo":{"language":"TS"}}}}' END AS payload,
         true AS public,
         ts AS created_ts,
         replace(CAST(ts AS VARCHAR), ' ', 'T') || 'Z' AS created_at,
         'org' AS org_login,
         CASE WHEN delay IS NULL THEN 'archive' ELSE 'live' END AS source,
         replace(CAST(ts + to_seconds(delay) AS VARCHAR), ' ', 'T') || 'Z' AS ingested_at,
         ts + to_seconds(coalesce(delay, 0)) AS arrived,
         strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
         strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour
  FROM sent
)"""

SILVER = DELIVERIES + """,
live_first AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
        PARTITION BY year, month, day, id
        ORDER BY CASE source WHEN 'live' THEN 0 ELSE 1 END, arrived) AS rn
    FROM deliveries) WHERE rn = 1
),
silver AS (
  SELECT id AS event_id, type, actor_login, actor_id, repo_name, repo_id, payload,
         CASE shape WHEN 0 THEN 'started' WHEN 1 THEN 'opened' WHEN 2 THEN 'closed'
                    WHEN 6 THEN 'created' END AS payload_action,
         public, created_ts AS created_at, org_login,
         CASE shape WHEN 0 THEN 'JavaScript' WHEN 1 THEN 'Python' WHEN 2 THEN 'Go'
                    WHEN 3 THEN 'C++' WHEN 6 THEN 'Haskell' WHEN 7 THEN 'TypeScript'
                    ELSE 'Unknown' END AS repo_language,
         source, year, month, day, hour,
         CAST(created_ts AS DATE) AS event_date, CAST(hour AS INTEGER) AS hour_no
  FROM live_first
)"""

ARCHIVE_FIRST = DELIVERIES + """,
archive_first AS (
  SELECT *, CAST(created_ts AS DATE) AS event_date, CAST(hour AS INTEGER) AS hour_no FROM (
    SELECT *, row_number() OVER (
        PARTITION BY year, month, day, hour, id
        ORDER BY CASE source WHEN 'archive' THEN 0 ELSE 1 END, arrived) AS rn
    FROM deliveries) WHERE rn = 1
)"""


def _counts() -> str:
    kinds = {
        "push_count": "PushEvent",
        "pr_count": "PullRequestEvent",
        "issue_count": "IssuesEvent",
        "watch_count": "WatchEvent",
        "fork_count": "ForkEvent",
    }
    return ", ".join(
        f"CAST(sum(CASE WHEN type = '{kind}' THEN 1 ELSE 0 END) AS BIGINT) AS {name}"
        for name, kind in kinds.items()
    )


def _dominant(source: str, keys: str) -> str:
    """Most frequent type per key, the larger name on a tie."""
    return f"""
  SELECT {keys}, type AS dominant_event_type FROM (
    SELECT {keys}, type, row_number() OVER (PARTITION BY {keys} ORDER BY n DESC, type DESC) AS rn
    FROM (SELECT {keys}, type, count(*) AS n FROM {source} GROUP BY {keys}, type)) WHERE rn = 1"""


REPO_DAILY = SILVER + f""",
repo_dominant AS ({_dominant("silver", "event_date, repo_id")}),
repo_daily AS (
  SELECT s.event_date, s.repo_id, max(repo_name) AS repo_name, count(*) AS event_count,
         count(DISTINCT actor_id) AS unique_actors,
         any_value(d.dominant_event_type) AS dominant_event_type, {_counts()},
         min(created_at) AS first_event_at, max(created_at) AS last_event_at
  FROM silver s JOIN repo_dominant d ON s.event_date = d.event_date AND s.repo_id = d.repo_id
  GROUP BY s.event_date, s.repo_id
)"""

ACTOR_DAILY = SILVER + f""",
actor_dominant AS ({_dominant("silver", "event_date, actor_id")}),
actor_daily AS (
  SELECT s.event_date, s.actor_id, max(actor_login) AS actor_login, count(*) AS event_count,
         count(DISTINCT repo_id) AS unique_repos,
         any_value(d.dominant_event_type) AS dominant_event_type, {_counts()}
  FROM silver s JOIN actor_dominant d ON s.event_date = d.event_date AND s.actor_id = d.actor_id
  GROUP BY s.event_date, s.actor_id
)"""

MARTS = REPO_DAILY + """,
acceleration AS (
  SELECT t.event_date, t.repo_id, t.repo_name, t.event_count,
         coalesce(y.event_count, 0) AS prev_event_count,
         t.event_count - coalesce(y.event_count, 0) AS event_delta,
         CAST(t.event_count AS DOUBLE) / nullif(y.event_count, 0) AS acceleration_ratio,
         t.dominant_event_type
  FROM repo_daily t
  LEFT JOIN repo_daily y ON t.repo_id = y.repo_id AND y.event_date = t.event_date - 1
),
ratios AS (
  SELECT *, CAST(watch_count AS DOUBLE) / event_count AS watch_ratio,
         CAST(fork_count AS DOUBLE) / event_count AS fork_ratio
  FROM repo_daily
),
spread AS (
  SELECT event_date, avg(event_count) AS am, stddev_pop(event_count) AS asd,
         avg(watch_ratio) AS wm, stddev_pop(watch_ratio) AS wsd,
         avg(fork_ratio) AS fm, stddev_pop(fork_ratio) AS fsd
  FROM ratios GROUP BY event_date
),
scored AS (
  SELECT r.*, coalesce((event_count - am) / nullif(asd, 0), 0) AS activity_zscore,
         coalesce((watch_ratio - wm) / nullif(wsd, 0), 0) AS watch_zscore,
         coalesce((fork_ratio - fm) / nullif(fsd, 0), 0) AS fork_zscore
  FROM ratios r JOIN spread USING (event_date)
),
anomaly AS (
  SELECT *, sqrt(activity_zscore ** 2 + watch_zscore ** 2 + fork_zscore ** 2) AS anomaly_score
  FROM scored
)"""

RANKED = MARTS + """,
weighted AS (
  SELECT d.event_date, d.repo_id, d.repo_name, d.event_count, d.dominant_event_type,
         a.acceleration_ratio, a.prev_event_count, n.anomaly_score, n.watch_ratio, n.watch_zscore,
         0.4::DOUBLE * least(coalesce(a.acceleration_ratio, 0), 10)
           + 0.4::DOUBLE * coalesce(n.anomaly_score, 0)
           + 0.2::DOUBLE * ln(d.event_count + 1) AS rank_score
  FROM repo_daily d
  LEFT JOIN acceleration a ON d.repo_id = a.repo_id AND d.event_date = a.event_date
  LEFT JOIN anomaly n ON d.repo_id = n.repo_id AND d.event_date = n.event_date
  WHERE d.event_count >= 5 AND coalesce(a.prev_event_count, 0) >= 3
    AND coalesce(n.watch_zscore, -999) > 0
),
ranked AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY event_date ORDER BY round(rank_score, 9) DESC, repo_id)
                   AS INTEGER) AS rank FROM weighted) WHERE rank <= 10
)"""

HOURLY = SILVER + f""",
hour_dominant AS ({_dominant("silver", "event_date, hour_no, repo_id")}),
repo_hourly AS (
  SELECT s.event_date, s.hour_no AS hour, s.repo_id, max(repo_name) AS repo_name,
         count(*) AS event_count, any_value(d.dominant_event_type) AS dominant_event_type
  FROM silver s JOIN hour_dominant d
    ON s.event_date = d.event_date AND s.hour_no = d.hour_no AND s.repo_id = d.repo_id
  GROUP BY s.event_date, s.hour_no, s.repo_id
)"""

RECENT = ARCHIVE_FIRST + f""",
recent_dominant AS ({_dominant("archive_first", "event_date, hour_no, repo_id")}),
recent AS (
  SELECT s.event_date, s.hour_no AS hour,
         CAST(s.event_date AS TIMESTAMP) + to_hours(s.hour_no) AS hour_ts, s.repo_id,
         max(repo_name) AS repo_name, count(*) AS event_count,
         count(DISTINCT actor_id) AS unique_actors, {_counts()},
         any_value(d.dominant_event_type) AS dominant_event_type
  FROM archive_first s JOIN recent_dominant d
    ON s.event_date = d.event_date AND s.hour_no = d.hour_no AND s.repo_id = d.repo_id
  GROUP BY s.event_date, s.hour_no, s.repo_id
)"""

LANGUAGES = SILVER + """,
language_activity AS (
  SELECT event_date, hour_no AS hour, repo_language AS language, count(*) AS event_count,
         count(DISTINCT repo_id) AS unique_repos, count(DISTINCT actor_id) AS unique_actors
  FROM silver GROUP BY event_date, hour_no, repo_language
)"""

HEATMAP = SILVER + """,
heat AS (
  SELECT event_date, hour_no AS hour, type AS type_raw, count(*) AS event_count,
         count(DISTINCT repo_id) AS unique_repos
  FROM silver GROUP BY event_date, hour_no, type
),
heat_types AS (
  SELECT event_date, type_raw AS type, CAST(sum(event_count) AS BIGINT) AS total,
         CASE type_raw WHEN 'PushEvent' THEN 'Push' WHEN 'PullRequestEvent' THEN 'PR'
              WHEN 'IssuesEvent' THEN 'Issue' WHEN 'WatchEvent' THEN 'Star'
              WHEN 'ForkEvent' THEN 'Fork' END AS label,
         CAST(row_number() OVER (PARTITION BY event_date ORDER BY sum(event_count) DESC, type_raw)
              AS INTEGER) AS type_order
  FROM heat GROUP BY event_date, type_raw
)"""

METRICS_5MIN = SILVER + """,
m5 AS (
  SELECT repo_id, time_bucket(INTERVAL 5 MINUTE, created_at) AS ts_5min,
         max(repo_name) AS repo_name,
         CAST(sum(CASE WHEN type = 'WatchEvent' THEN 1 ELSE 0 END) AS BIGINT) AS star_count,
         CAST(sum(CASE WHEN type = 'ForkEvent' THEN 1 ELSE 0 END) AS BIGINT) AS fork_count,
         CAST(sum(CASE WHEN type = 'PullRequestEvent' THEN 1 ELSE 0 END) AS BIGINT) AS pr_count,
         CAST(sum(CASE WHEN type = 'PushEvent' THEN 1 ELSE 0 END) AS BIGINT) AS commit_count,
         count(DISTINCT actor_id) AS unique_actors, max(repo_language) AS primary_language
  FROM silver GROUP BY repo_id, ts_5min
)"""

DOCUMENTS = """
docs AS (
  SELECT doc_id, strftime(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER), '%Y-%m-%d') AS date,
         source || '/doc-' || doc_id AS repo_name, CAST(doc_id AS VARCHAR) AS repo_id,
         CAST(n_chars AS INTEGER) AS event_count,
         CAST(n_chars AS DOUBLE) / 100 AS anomaly_score,
         CAST(n_chars % 1000 AS DOUBLE) / 10 AS rank_score,
         '### report' || chr(10) || chr(10) || '#### 1. ' || source || '/doc-' || doc_id || chr(10)
           || text || chr(10) || '#### 2. other/one' || chr(10) || 'more' AS insight_markdown,
         source IN ('src0', 'src5', 'src10', 'src15') AS done, source, n_chars, text
  FROM documents
)"""

TOKENS = DOCUMENTS + """,
field_texts AS (
  SELECT date, repo_name, 'name' AS field, repo_name AS body FROM docs
  UNION ALL SELECT date, repo_name, 'body', insight_markdown FROM docs
),
token_lists AS (
  SELECT date, repo_name, field,
         list_filter(regexp_split_to_array(lower(body), '[^\\p{L}\\p{N}_]+'), lambda x: x <> '') AS toks
  FROM field_texts
),
postings AS (
  SELECT date, repo_name, field, token, count(*) AS tf, any_value(dl) AS dl
  FROM (SELECT date, repo_name, field, len(toks) AS dl, unnest(toks) AS token FROM token_lists)
  GROUP BY date, repo_name, field, token
)"""

MATCHES = TOKENS + """,
field_stats AS (
  SELECT field, count(*) AS n, avg(len(toks)) AS avg_dl FROM token_lists
  WHERE len(toks) > 0 GROUP BY field
),
hits AS (SELECT * FROM postings WHERE token IN ('and', 'the', 'of')),
dfs AS (SELECT field, token, count(*) AS df FROM hits GROUP BY field, token),
found AS (
  SELECT h.date, h.repo_name, h.field,
         sum(ln(1 + (n - df + 0.5) / (df + 0.5))
             * tf / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avg_dl)))
           * CASE h.field WHEN 'name' THEN 2 ELSE 1 END AS score
  FROM hits h JOIN dfs USING (field, token) JOIN field_stats USING (field)
  GROUP BY h.date, h.repo_name, h.field HAVING count(*) = 3
),
matched AS (SELECT date, repo_name, max(score) AS score FROM found GROUP BY date, repo_name)"""

CATEGORIES = RANKED + """,
merged AS (
  SELECT r.*,
         CASE WHEN d.repo_id % 3 <> 0 THEN CASE WHEN d.repo_id % 2 = 0 THEN 'Web' ELSE 'Game' END
         END AS category,
         CASE WHEN d.repo_id % 3 <> 0 THEN 0.8::DOUBLE END AS category_confidence
  FROM ranked r LEFT JOIN repo_daily d
    ON r.event_date = d.event_date AND r.repo_name = d.repo_name
)"""

GRAIN = DELIVERIES + """,
arrivals AS (SELECT *, date_trunc('minute', arrived) AS minute FROM deliveries)"""

LAST_DAY = GRAIN + """,
last_day AS (
  SELECT * FROM arrivals
  WHERE minute > (SELECT max(minute) FROM arrivals) - INTERVAL 1440 MINUTE
)"""

FIXED2 = "printf('%.2f', coalesce({0}, 0))"


def _round(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in columns)


SILVER_COLUMNS = (
    "event_id, type, actor_login, actor_id, repo_name, repo_id, payload, payload_action, public, "
    "created_at, org_login, repo_language, source, year, month, day, hour"
)
RANK_COLUMNS = (
    "event_date, repo_id, repo_name, event_count, dominant_event_type, prev_event_count, "
    + _round("acceleration_ratio", "anomaly_score", "watch_ratio", "watch_zscore", "rank_score")
)


def _with(parts: str, body: str) -> str:
    return f"WITH {parts}\n{body}"


def _cells() -> str:
    return ", ".join(
        f"CAST(coalesce(sum(CASE WHEN h.hour = {h} THEN h.event_count END), 0) AS BIGINT) AS h{h:02d}"
        for h in range(24)
    )


def _section() -> str:
    mark = "chr(10) || '#### '"
    part = f"list_filter(string_split(insight_markdown, {mark}), lambda p: contains(p, repo_name))[1]"
    return f"CASE WHEN starts_with({part}, '#') THEN {part} ELSE '#### ' || {part} END"


# words that name a category, between characters that are no letter or digit
RULES = [
    ("Other", "test|tests|bot|bots|e2e"),
    ("DevTools", "warp|n8n|zapier|mattpocock/skills"),
    ("AI/ML", "llm|llms|neural|gpt|agent|agents|codex|nn-zero|diffusion|transformer|transformers"
              "|machinelearning|machine-learning"),
    ("Infra", "kube|kubectl|kubernetes|docker|terraform|postgres|redis|kafka|grafana|cloud|spark"),
    ("Web", "react|nuxt|vue|svelte|tailwind|shadcn|django|nextjs|next[.]js|http|https"),
    ("Game", "godot|unreal|unity|game|games"),
    ("DevTools", "cli|sdk|lint|linter|compiler|vscode|editor|build|plugin|plugins"),
]


def _rules(kind: str) -> str:
    """CASE over the name rules, name before text."""
    whens = []
    for text, confidence in (("lower(repo_name)", "0.9"), ("lower(section)", "0.6")):
        for category, words in RULES:
            pattern = f"(?:^|[^a-z0-9])({words})(?:[^a-z0-9]|$)"
            value = {
                "category": f"'{category}'",
                "confidence": f"{confidence}::DOUBLE",
                "reasoning": f"'matched ' || regexp_extract({text}, '{pattern}', 1)",
            }[kind]
            whens.append(f"WHEN regexp_matches({text}, '{pattern}') THEN {value}")
    default = {"category": "'Other'", "confidence": "0.3::DOUBLE", "reasoning": "'no rule matched'"}
    return f"CASE {' '.join(whens)} ELSE {default[kind]} END AS {kind}"


RULED = DOCUMENTS + f""",
sectioned AS (
  SELECT *, regexp_replace({_section()}, '^\\s+|\\s+$', '', 'g') AS section FROM docs
),
ruled AS (
  SELECT *, {_rules("category")}, {_rules("confidence")}, {_rules("reasoning")} FROM sectioned
)"""


def _fmt(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '—' ELSE printf('%.2f', {column}) END"


def _count_or(column: str, default: str) -> str:
    return f"CASE WHEN coalesce({column}, 0) = 0 THEN '{default}' ELSE CAST({column} AS VARCHAR) END"


ORACLES = {
    "union_sources": _with(DELIVERIES, """
SELECT source, type, count(*) AS deliveries, count(DISTINCT id) AS ids,
       min(created_at) AS first_created, max(ingested_at) AS last_ingested
FROM deliveries GROUP BY source, type"""),
    "flatten_event": _with(DELIVERIES, """
SELECT id, type, actor_id, actor_login, repo_id, repo_name, payload, public, created_at, org_login,
       source, CASE WHEN source = 'live' THEN ingested_at END AS ingested_at, year, month, day, hour
FROM deliveries"""),
    "dedup_live_first": _with(SILVER, """
SELECT id, source, ingested_at, year, month, day, hour FROM live_first"""),
    "dedup_archive_first": _with(ARCHIVE_FIRST, """
SELECT id, source, ingested_at, year, month, day, hour FROM archive_first"""),
    "silver_events": _with(SILVER, f"SELECT {SILVER_COLUMNS} FROM silver"),
    "bronze_files": _with(SILVER, f"SELECT {SILVER_COLUMNS} FROM silver"),
    "read_silver": _with(SILVER, """
SELECT year, month, day, hour, count(*) AS n, count(DISTINCT event_id) AS ids
FROM silver GROUP BY year, month, day, hour"""),
    "normalize_language": _with(SILVER, """
SELECT repo_language, payload_action, count(*) AS n FROM silver GROUP BY repo_language, payload_action"""),
    "partition_by_created_at": _with(DELIVERIES, """
SELECT id, source, created_at, year, month, day, hour FROM deliveries"""),
    "quarantine_malformed": _with(DELIVERIES, """
SELECT CASE WHEN shape = 5 THEN 'bad' ELSE 'good' END AS kind, year, month, day, count(*) AS n
FROM deliveries GROUP BY 1, year, month, day"""),
    "append_archive_hour": _with(DELIVERIES, """
SELECT type, '15' AS day, '03' AS hour, count(*) AS n, count(DISTINCT repo_id) AS repos,
       true AS landed_first, false AS landed_again
FROM deliveries WHERE source = 'archive' GROUP BY type"""),
    "overwrite_day": _with(REPO_DAILY, """
SELECT event_date, repo_id,
       CASE WHEN event_date = DATE '2024-01-15' THEN event_count ELSE event_count * 2 END AS event_count,
       strftime(event_date, '%Y') AS year, strftime(event_date, '%m') AS month,
       strftime(event_date, '%d') AS day FROM repo_daily"""),
    "overwrite_hour": _with(RECENT, """
SELECT event_date, hour, repo_id,
       CASE WHEN event_date = DATE '2024-01-15' AND hour >= 12 THEN event_count
            ELSE event_count * 2 END AS event_count,
       CASE WHEN hour < 12 THEN '00' ELSE '12' END AS hour_p FROM recent"""),
    "repo_daily": _with(REPO_DAILY, "SELECT * FROM repo_daily"),
    "actor_daily": _with(ACTOR_DAILY, "SELECT * FROM actor_daily"),
    "repo_acceleration": _with(MARTS, f"""
SELECT event_date, repo_id, repo_name, event_count, prev_event_count, event_delta,
       {_round("acceleration_ratio")}, dominant_event_type FROM acceleration"""),
    "join_prev_day": _with(REPO_DAILY, """
SELECT t.event_date, t.repo_id, t.event_count, y.event_count AS prev_event_count
FROM repo_daily t LEFT JOIN repo_daily y ON t.repo_id = y.repo_id AND y.event_date = t.event_date - 1"""),
    "repo_anomaly": _with(MARTS, f"""
SELECT event_date, repo_id, repo_name, event_count, watch_count,
       {_round("activity_zscore", "watch_ratio", "watch_zscore", "fork_ratio", "fork_zscore", "anomaly_score")}
FROM anomaly"""),
    "repo_hourly": _with(HOURLY, "SELECT * FROM repo_hourly"),
    "language_activity": _with(LANGUAGES, "SELECT * FROM language_activity"),
    "hourly_recent": _with(RECENT, "SELECT * FROM recent"),
    "read_gold": _with(REPO_DAILY, """
SELECT strftime(event_date, '%Y') AS year, strftime(event_date, '%m') AS month,
       strftime(event_date, '%d') AS day, count(*) AS repos, CAST(sum(event_count) AS BIGINT) AS events
FROM repo_daily GROUP BY event_date"""),
    "join_daily_marts": _with(MARTS, f"""
SELECT d.event_date, d.repo_id, d.event_count, a.prev_event_count,
       round(a.acceleration_ratio, 6) + 0.0 AS acceleration_ratio,
       round(n.anomaly_score, 6) + 0.0 AS anomaly_score, round(n.watch_zscore, 6) + 0.0 AS watch_zscore
FROM repo_daily d
LEFT JOIN acceleration a ON d.repo_id = a.repo_id AND d.event_date = a.event_date
LEFT JOIN anomaly n ON d.repo_id = n.repo_id AND d.event_date = n.event_date"""),
    "rank_top": _with(RANKED, f"SELECT {RANK_COLUMNS}, rank FROM ranked"),
    "top_acceleration": _with(MARTS, f"""
SELECT * FROM (
  SELECT event_date, CAST(row_number() OVER (PARTITION BY event_date
           ORDER BY round(a.acceleration_ratio, 9) DESC NULLS LAST, repo_id) AS INTEGER) AS rank,
         repo_id, repo_name, event_count, prev_event_count, {_round("acceleration_ratio")},
         dominant_event_type
  FROM acceleration a WHERE prev_event_count >= 5) WHERE rank <= 10"""),
    "top_anomaly": _with(MARTS, f"""
SELECT * FROM (
  SELECT event_date, CAST(row_number() OVER (PARTITION BY event_date
           ORDER BY round(a.anomaly_score, 9) DESC NULLS LAST, repo_id) AS INTEGER) AS rank,
         repo_id, repo_name, event_count,
         {_round("watch_ratio", "watch_zscore", "activity_zscore", "anomaly_score")}
  FROM anomaly a) WHERE rank <= 10"""),
    "repo_hour_series": _with(HOURLY, """
SELECT event_date, repo_id, repo_name, hour, event_count, dominant_event_type FROM repo_hourly"""),
    "hour_distribution": _with(HOURLY, """
SELECT event_date, hour, CAST(sum(event_count) AS BIGINT) AS total_events,
       count(DISTINCT repo_id) AS active_repos FROM repo_hourly GROUP BY event_date, hour"""),
    "available_dates": _with(REPO_DAILY, """
SELECT DISTINCT strftime(event_date, '%Y-%m-%d') AS date_str FROM repo_daily ORDER BY 1 DESC LIMIT 30"""),
    "topn_summary": _with(RANKED, """
SELECT event_date, count(*) AS repos, CAST(sum(event_count) AS BIGINT) AS total_events,
       round(avg(rank_score), 6) + 0.0 AS avg_rank_score,
       round(max(watch_zscore), 6) + 0.0 AS max_watch_zscore FROM ranked GROUP BY event_date"""),
    "type_share": _with(REPO_DAILY, """,
long AS (
  UNPIVOT repo_daily ON push_count, pr_count, issue_count, watch_count, fork_count
  INTO NAME count_column VALUE type_count
)
SELECT event_date, repo_id, repo_name, count_column, type_count,
       round(type_count * 100.0::DOUBLE / event_count, 1) AS share_pct FROM long"""),
    "export_csv": _with(RANKED, """
SELECT event_date, rank, repo_name, event_count, round(rank_score, 6) + 0.0 AS rank_score FROM ranked"""),
    "activity_heatmap_long": _with(HEATMAP, "SELECT * FROM heat"),
    "activity_heatmap_matrix": _with(HEATMAP, f"""
SELECT t.event_date, t.type, any_value(t.total) AS total, {_cells()},
       any_value(t.label) AS label, any_value(t.type_order) AS type_order
FROM heat_types t JOIN heat h ON t.event_date = h.event_date AND t.type = h.type_raw
GROUP BY t.event_date, t.type"""),
    "activity_heatmap_cells": _with(HEATMAP, """
SELECT t.event_date, CAST(s.hour AS INTEGER) AS hour, t.type_order, t.type, t.label, t.total,
       coalesce(h.event_count, 0) AS event_count
FROM heat_types t JOIN range(24) s(hour) ON true
LEFT JOIN heat h ON h.event_date = t.event_date AND h.type_raw = t.type AND h.hour = s.hour"""),
    "heatmap_coverage": _with(HEATMAP, """
SELECT event_date, CAST(sum(event_count) AS BIGINT) AS total_events,
       CAST(sum(event_count) AS BIGINT) AS known_events, CAST(100.0 AS DOUBLE) AS known_pct
FROM heat GROUP BY event_date"""),
    "hourly_today_hours": _with(RECENT, """
SELECT event_date, hour, CAST(sum(event_count) AS BIGINT) AS events,
       count(DISTINCT repo_id) AS unique_repos, CAST(sum(unique_actors) AS BIGINT) AS unique_actors,
       CAST(sum(push_count) AS BIGINT) AS push_count, CAST(sum(pr_count) AS BIGINT) AS pr_count,
       CAST(sum(issue_count) AS BIGINT) AS issue_count,
       CAST(sum(watch_count) AS BIGINT) AS watch_count,
       CAST(sum(fork_count) AS BIGINT) AS fork_count, (hour + 9) % 24 AS hour_kst
FROM recent GROUP BY event_date, hour"""),
    "hourly_today_totals": _with(RECENT, """
SELECT event_date, CAST(sum(event_count) AS BIGINT) AS events,
       CAST(sum(unique_actors) AS BIGINT) AS unique_actors FROM recent GROUP BY event_date"""),
    "hourly_today_top": _with(RECENT, """,
busiest AS (
  SELECT * FROM (
    SELECT event_date, repo_name, dominant_event_type, row_number() OVER (
        PARTITION BY event_date, repo_name
        ORDER BY event_count DESC, dominant_event_type DESC) AS rn FROM recent) WHERE rn = 1
),
sums AS (
  SELECT event_date, repo_name, CAST(sum(event_count) AS BIGINT) AS events
  FROM recent GROUP BY event_date, repo_name
)
SELECT * FROM (
  SELECT s.event_date, s.repo_name, s.events, b.dominant_event_type AS primary_type,
         CAST(row_number() OVER (PARTITION BY s.event_date ORDER BY s.events DESC, s.repo_name)
              AS INTEGER) AS rank
  FROM sums s JOIN busiest b ON s.event_date = b.event_date AND s.repo_name = b.repo_name)
WHERE rank <= 10"""),
    "repo_profile_metrics": _with(MARTS, """
SELECT d.event_date, d.repo_id, d.repo_name, d.event_count, d.unique_actors, d.dominant_event_type,
       d.push_count, d.pr_count, d.issue_count, d.watch_count, d.fork_count,
       d.first_event_at, d.last_event_at,
       round(a.acceleration_ratio, 6) + 0.0 AS acceleration_ratio, a.prev_event_count,
       round(n.anomaly_score, 6) + 0.0 AS anomaly_score,
       round(n.watch_ratio, 6) + 0.0 AS watch_ratio, round(n.watch_zscore, 6) + 0.0 AS watch_zscore
FROM repo_daily d
LEFT JOIN acceleration a ON d.repo_id = a.repo_id AND d.event_date = a.event_date
LEFT JOIN anomaly n ON d.repo_id = n.repo_id AND d.event_date = n.event_date"""),
    "repo_profile_timeline": _with(HOURLY, """,
names AS (SELECT DISTINCT event_date, repo_name FROM repo_hourly),
per_hour AS (
  SELECT event_date, repo_name, hour, CAST(sum(event_count) AS BIGINT) AS event_count,
         max(struct_pack(n := event_count, t := dominant_event_type)).t AS dominant_event_type
  FROM repo_hourly GROUP BY event_date, repo_name, hour
)
SELECT n.event_date, n.repo_name, CAST(s.hour AS INTEGER) AS hour,
       coalesce(p.event_count, 0) AS event_count, p.dominant_event_type
FROM names n JOIN range(24) s(hour) ON true
LEFT JOIN per_hour p
  ON p.event_date = n.event_date AND p.repo_name = n.repo_name AND p.hour = s.hour"""),
    "profile_7d": _with(REPO_DAILY, """
SELECT d.event_date, d.repo_id, any_value(d.repo_name) AS repo_name,
       any_value(d.event_count) AS event_count, CAST(sum(w.event_count) AS BIGINT) AS events_7d,
       count(*) AS active_days_7d, max(w.event_count) AS peak_7d
FROM repo_daily d JOIN repo_daily w
  ON w.repo_id = d.repo_id AND w.event_date BETWEEN d.event_date - 6 AND d.event_date
GROUP BY d.event_date, d.repo_id"""),
    "silver_ready": _with(SILVER, "SELECT event_date, count(*) AS cnt FROM silver GROUP BY event_date"),
    "sources_ready": _with(DELIVERIES, """
SELECT year, month, day, hour,
       CAST(sum(CASE WHEN source = 'live' THEN 1 ELSE 0 END) AS BIGINT) AS live_cnt,
       CAST(sum(CASE WHEN source = 'archive' THEN 1 ELSE 0 END) AS BIGINT) AS archive_cnt
FROM deliveries GROUP BY year, month, day, hour"""),
    "verify_silver": _with(SILVER, """
SELECT event_date, count(*) AS cnt, count(DISTINCT hour) AS hrs,
       CAST(sum(CASE WHEN source = 'live' THEN 1 ELSE 0 END) AS BIGINT) AS live_rows,
       CAST(sum(CASE WHEN source = 'archive' THEN 1 ELSE 0 END) AS BIGINT) AS archive_rows,
       CAST(sum(CASE WHEN repo_language <> 'Unknown' THEN 1 ELSE 0 END) AS BIGINT) AS lang_known
FROM silver GROUP BY event_date"""),
    "verify_gold": _with(SILVER, """
SELECT event_date, count(DISTINCT repo_id) AS repos, count(DISTINCT actor_id) AS actors,
       count(DISTINCT repo_id) AS accel, count(DISTINCT repo_id) AS anomaly,
       count(DISTINCT (hour_no, repo_id)) AS hourly, count(DISTINCT (hour_no, repo_language)) AS lang
FROM silver GROUP BY event_date"""),
    "verify_hourly": _with(RECENT, """
SELECT event_date, hour, count(*) AS repos FROM recent GROUP BY event_date, hour"""),
    "repo_metrics_5min": _with(METRICS_5MIN, "SELECT * FROM m5"),
    "repo_velocity": _with(METRICS_5MIN, """,
slots AS (SELECT *, CAST(epoch(ts_5min) / 300 AS BIGINT) AS slot FROM m5),
sums AS (
  SELECT a.repo_id, a.slot, any_value(a.repo_name) AS repo_name, any_value(a.ts_5min) AS ts_5min,
         any_value(a.star_count) AS star_count,
         coalesce(sum(CASE WHEN b.slot <= a.slot - 1 THEN b.star_count END), 0) AS s1,
         coalesce(sum(CASE WHEN b.slot <= a.slot - 1 THEN b.star_count * b.star_count END), 0) AS s2,
         coalesce(sum(CASE WHEN b.slot = a.slot - 12 THEN b.star_count END), 0) AS ago
  FROM slots a JOIN slots b ON a.repo_id = b.repo_id AND b.slot BETWEEN a.slot - 288 AND a.slot
  GROUP BY a.repo_id, a.slot
),
stats AS (
  SELECT *, CAST(s1 AS DOUBLE) / 288 AS mean,
         sqrt(CAST(s2 AS DOUBLE) / 288 - (CAST(s1 AS DOUBLE) / 288) ** 2) AS std FROM sums
)
SELECT repo_id, repo_name, ts_5min, star_count, CAST(ago AS BIGINT) AS star_1h_ago,
       round(mean, 6) + 0.0 AS star_avg_24h, round(std, 6) + 0.0 AS star_std_24h,
       round((star_count - mean) / nullif(std, 0), 6) + 0.0 AS z_score,
       coalesce((star_count - mean) / nullif(std, 0) > 3, false) AS anomaly_flag,
       CAST((star_count - ago) * 12 AS BIGINT) AS delta_stars_per_hour
FROM stats"""),
    "anomaly_kind": _with(REPO_DAILY, """
SELECT event_date, repo_id, repo_name, event_count, unique_actors,
       round(CAST(unique_actors AS DOUBLE) / event_count, 6) + 0.0 AS actor_ratio,
       CASE WHEN CAST(unique_actors AS DOUBLE) / event_count < 0.95 THEN 'bot' ELSE 'viral' END
         AS anomaly_kind
FROM repo_daily"""),
    "upsert_docs": _with(DOCUMENTS, """,
base AS (SELECT *, 'src' || (doc_id % 20) || '/doc-' || doc_id AS key FROM docs),
changes AS (
  SELECT doc_id AS seq, (doc_id // 2) * 3 AS target, repo_id, event_count,
         CASE WHEN doc_id % 2 = 1 THEN anomaly_score END AS anomaly_score, rank_score,
         insight_markdown,
         CASE WHEN doc_id % 2 = 0 THEN 'Web' END AS category,
         CASE WHEN doc_id % 4 = 0 THEN 'renewed' END AS reasoning
  FROM docs
),
last_core AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY seq DESC) AS rn
                 FROM changes) WHERE rn = 1
),
last_category AS (
  SELECT target, max(category) AS category, max(reasoning) AS reasoning FROM changes
  WHERE category IS NOT NULL GROUP BY target
),
news AS (
  SELECT c.*, g.category AS new_category, g.reasoning AS new_reasoning,
         strftime(DATE '2024-01-01' + CAST(c.target % 30 AS INTEGER), '%Y-%m-%d') AS new_date,
         'src' || (c.target % 20) || '/doc-' || c.target AS new_key
  FROM last_core c LEFT JOIN last_category g ON c.target = g.target
)
SELECT coalesce(b.date, u.new_date) AS date, coalesce(b.key, u.new_key) AS repo_name,
       CASE WHEN u.seq IS NOT NULL THEN u.repo_id ELSE b.repo_id END AS repo_id,
       CASE WHEN u.seq IS NOT NULL THEN u.event_count ELSE b.event_count END AS event_count,
       round(CASE WHEN u.seq IS NOT NULL THEN u.anomaly_score ELSE b.anomaly_score END, 6) + 0.0
         AS anomaly_score,
       round(CASE WHEN u.seq IS NOT NULL THEN u.rank_score ELSE b.rank_score END, 6) + 0.0 AS rank_score,
       md5(CASE WHEN u.seq IS NOT NULL THEN u.insight_markdown ELSE b.insight_markdown END) AS insight_md5,
       CASE WHEN u.new_category IS NOT NULL THEN u.new_category WHEN b.done THEN 'Infra' END AS category,
       CASE WHEN u.new_category IS NOT NULL THEN 0.5::DOUBLE WHEN b.done THEN 0.75::DOUBLE END
         AS category_confidence,
       CASE WHEN u.new_reasoning IS NOT NULL THEN u.new_reasoning WHEN b.done THEN 'seen before' END
         AS category_reasoning,
       CASE WHEN u.new_category IS NOT NULL THEN TIMESTAMP '2024-03-01 00:00:00'
            WHEN b.done THEN TIMESTAMP '2024-02-02 00:00:00' END AS categorized_at
FROM base b FULL OUTER JOIN news u ON b.key = u.new_key AND b.date = u.new_date"""),
    "cache_repo_insight": _with(DOCUMENTS, """
SELECT date, repo_name, CASE WHEN done THEN 'Infra' END AS category,
       md5('cached: ' || insight_markdown) AS cached_md5,
       TIMESTAMP '2024-02-03 00:00:00' AS repo_insight_generated_at FROM docs"""),
    "docs_by_date": _with(DOCUMENTS, """
SELECT date, rank, total, repo_name, round(rank_score, 6) + 0.0 AS rank_score FROM (
  SELECT *, count(*) OVER (PARTITION BY date) AS total,
         CAST(row_number() OVER (PARTITION BY date ORDER BY d.rank_score DESC NULLS LAST, repo_name)
              AS INTEGER) AS rank FROM docs d) WHERE rank <= 5"""),
    "indexed_dates": _with(DOCUMENTS, "SELECT DISTINCT date FROM docs ORDER BY date DESC LIMIT 30"),
    "build_token_index": _with(TOKENS, """
SELECT field, token, count(*) AS docs, CAST(sum(tf) AS BIGINT) AS tf, max(dl) AS max_dl
FROM postings GROUP BY field, token"""),
    "search_documents": _with(MATCHES, """,
best AS (
  SELECT *, CAST(row_number() OVER (ORDER BY round(score, 9) DESC, date DESC, repo_name) AS INTEGER) AS rank
  FROM matched
)
SELECT b.date, b.repo_name, round(round(b.score, 9), 6) + 0.0 AS score, b.rank,
       (SELECT count(*) FROM matched) AS total, d.event_count, round(d.rank_score, 6) + 0.0 AS rank_score,
       md5(d.insight_markdown) AS insight_md5
FROM best b JOIN docs d USING (date, repo_name) WHERE b.rank <= 20"""),
    "index_stats": "SELECT count(*) AS doc_count, true AS has_bytes FROM documents",
    "get_repo_insight": _with(DOCUMENTS, """
SELECT date, repo_name, md5(insight_markdown) AS insight_md5 FROM docs
WHERE doc_id = (SELECT min(doc_id) FROM documents)"""),
    "upsert_docs_twice": _with(DOCUMENTS, """
SELECT date, repo_name, CAST(1 AS BIGINT) AS rows, round(rank_score, 6) + 0.0 AS rank_score FROM docs
UNION ALL
SELECT date, 'many/' || (event_count % 50), CAST(1 AS BIGINT), round(max(rank_score), 6) + 0.0
FROM docs GROUP BY ALL"""),
    "repo_metrics_5min_sketch": _with(METRICS_5MIN, """
SELECT repo_id, ts_5min, commit_count, true AS within_bound FROM m5"""),
    "stream_pulse_restart": _with(GRAIN, """
SELECT minute, count(*) AS events, count(DISTINCT repo_name) AS unique_repos,
       count(DISTINCT actor_id) AS unique_actors
FROM arrivals WHERE source = 'live' GROUP BY minute"""),
    "backfill_keeps_days": _with(REPO_DAILY, "SELECT event_date, repo_id, event_count FROM repo_daily"),
    "search_total": _with(MATCHES, "SELECT count(*) AS total FROM matched"),
    "merge_categories": _with(CATEGORIES, """
SELECT event_date, repo_id, repo_name, category, category_confidence FROM merged"""),
    "fill_missing_categories": _with(CATEGORIES, """
SELECT event_date, repo_id, coalesce(category, 'DevTools') AS category,
       coalesce(category_confidence, 0.4::DOUBLE) AS category_confidence,
       CASE WHEN category IS NULL THEN 'batch' END AS category_reasoning FROM merged"""),
    "category_trending": _with(CATEGORIES, """
SELECT event_date, coalesce(category, 'Other') AS category, count(*) AS repos,
       CAST(sum(event_count) AS BIGINT) AS total_events,
       round(max(rank_score), 6) + 0.0 AS best_rank_score
FROM merged GROUP BY event_date, coalesce(category, 'Other')"""),
    "only_unclassified": _with(DOCUMENTS, "SELECT date, repo_name FROM docs WHERE NOT done"),
    "repo_enriched": _with(DOCUMENTS, """
SELECT CAST(date AS DATE) AS event_date, CAST(repo_id AS BIGINT) AS repo_id, repo_name,
       CASE WHEN done THEN 'Infra' END AS category,
       CASE WHEN done THEN 0.75::DOUBLE END AS category_confidence,
       CASE WHEN done THEN 'seen before' END AS category_reasoning,
       md5(insight_markdown) AS insight_markdown, 'local-rules' AS model_id,
       CASE WHEN done THEN TIMESTAMP '2024-02-02 00:00:00'
            ELSE TIMESTAMP '2024-02-01 00:00:00' END AS generated_at FROM docs"""),
    "parse_category_response": f"""
SELECT doc_id,
       CASE doc_id % 6 WHEN 0 THEN 'AI/ML' WHEN 1 THEN 'Infra' WHEN 2 THEN 'Game' WHEN 3 THEN 'Web'
            ELSE 'Other' END AS category,
       CASE doc_id % 6 WHEN 0 THEN 0.9 WHEN 1 THEN 0.25 WHEN 2 THEN 0.5 WHEN 3 THEN 1.0
            ELSE 0.0 END::DOUBLE AS confidence,
       CASE WHEN doc_id % 6 = 5 THEN 'JSON parse failed' ELSE text END AS reasoning
FROM documents""",
    "parse_batch_response": f"""
SELECT doc_id, 0 AS position, source || '/a' AS repo_name, 'Web' AS category,
       0.78::DOUBLE AS confidence, text AS reasoning FROM documents
UNION ALL SELECT doc_id, 1, source || '/b', 'Other', 0.0::DOUBLE, '' FROM documents
UNION ALL SELECT doc_id, 2, '', 'Game', 1.0::DOUBLE, '' FROM documents""",
    "extract_repo_section": _with(DOCUMENTS, f"""
SELECT date, repo_name, regexp_replace({_section()}, '^\\s+|\\s+$', '', 'g') AS section
FROM docs"""),
    "rank_table_markdown": _with(RANKED, f"""
SELECT event_date,
  '| # | repo | events | dominant | acc | anomaly | watch_z |' || chr(10)
  || '|---|------|--------|----------|-----|---------|---------|' || chr(10)
  || string_agg('| ' || rank || ' | ' || repo_name || ' | ' || event_count || ' | '
       || dominant_event_type || ' | ' || {FIXED2.format("acceleration_ratio")} || ' | '
       || {FIXED2.format("anomaly_score")} || ' | ' || {FIXED2.format("watch_zscore")} || ' |',
       chr(10) ORDER BY rank) AS repo_table
FROM ranked GROUP BY event_date"""),
    "repo_lines": _with(RANKED, """
SELECT event_date, count(*) AS n,
       string_agg('- ' || repo_name || ' (주요 활동: ' || dominant_event_type || ', 활동수: '
                  || event_count || ')', chr(10) ORDER BY rank) AS repo_lines
FROM ranked GROUP BY event_date"""),
    "render_prompt": _with(MARTS, f"""
SELECT d.event_date, d.repo_id, '# single repository' || chr(10) || chr(10) || chr(10)
         || 'You explain activity.' AS system_text,
       strftime(d.event_date, '%Y-%m-%d') || ': `' || d.repo_name || '` had ' || d.event_count
         || ' events, mostly ' || d.dominant_event_type || '.' || chr(10)
         || 'x' || {_fmt("a.acceleration_ratio")} || ', anomaly ' || {_fmt("n.anomaly_score")}
         || ', watch ' || {_fmt("n.watch_zscore")} || '.' || chr(10)
         || 'Stars ' || {_count_or("d.watch_count", "0")} || ', forks ' || {_count_or("d.fork_count", "0")}
         || ', PRs ' || {_count_or("d.pr_count", "0")} || ', pushes ' || {_count_or("d.push_count", "0")}
         || '; again ' || d.repo_name || '.' AS user_text
FROM repo_daily d
LEFT JOIN acceleration a ON d.repo_id = a.repo_id AND d.event_date = a.event_date
LEFT JOIN anomaly n ON d.repo_id = n.repo_id AND d.event_date = n.event_date"""),
    "flag_bot_names": """
WITH ks AS (SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
names AS (
  SELECT 'acme/' || CASE WHEN k % 5 = 0 THEN CAST(k AS VARCHAR) ELSE
    CASE k % 8 WHEN 0 THEN 'trading-bot' WHEN 1 THEN 'Casino' WHEN 2 THEN 'sandbox' WHEN 3 THEN 'webapp'
         WHEN 4 THEN 'copy_bot' WHEN 5 THEN 'bad name' WHEN 6 THEN 'robotics' ELSE 'playground' END
    || '-' || k END AS name, k FROM ks
)
SELECT name, count(*) AS n,
       any_value(k % 5 = 0 OR k % 8 IN (0, 1, 2, 4, 7)) AS is_bot,
       any_value(k % 5 = 0 OR k % 8 <> 5) AS is_valid
FROM names GROUP BY name""",
    "validate_date": """
WITH ks AS (SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
texts AS (SELECT printf('2024-%02d-%02d', k % 15, k % 34) AS text FROM ks)
SELECT text, count(*) AS n, TRY_CAST(text AS DATE) IS NOT NULL AS is_date FROM texts GROUP BY text""",
    "type_display_names": _with(SILVER, """
SELECT type, count(*) AS n,
       CASE type WHEN 'PushEvent' THEN 'Push' WHEN 'PullRequestEvent' THEN 'PR'
            WHEN 'IssuesEvent' THEN 'Issue' WHEN 'WatchEvent' THEN 'Star' ELSE 'Fork' END AS label
FROM silver GROUP BY type"""),
    "safe_numbers": """
WITH ks AS (
  SELECT event_id, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
)
SELECT event_id,
       CASE k % 4 WHEN 0 THEN k || '.0' WHEN 1 THEN '' WHEN 2 THEN 'n/a'
            ELSE CAST(CAST(value AS DECIMAL(12, 2)) AS VARCHAR) END AS text,
       CASE k % 4 WHEN 0 THEN k WHEN 3 THEN CAST(trunc(value) AS INTEGER) END AS as_int,
       CASE k % 4 WHEN 0 THEN CAST(k AS DOUBLE) WHEN 3 THEN round(value, 2) END AS as_double
FROM ks""",
    "classify_by_rules": _with(RULED, """
SELECT date, repo_name, category, confidence, reasoning, false AS failed FROM ruled"""),
    "classify_repos": _with(RULED, """
SELECT date, repo_name,
       CASE WHEN answered THEN CASE length(section) % 3 WHEN 0 THEN 'Infra' WHEN 1 THEN 'Web' ELSE 'Other' END END
         AS category,
       CASE WHEN answered THEN greatest(0.0, least(1.0, length(section) % 5 - 1.5))::DOUBLE END AS confidence,
       CASE WHEN answered THEN length(section) || ' characters' END AS reasoning,
       NOT answered AS failed
FROM (SELECT *, NOT ends_with(repo_name, '7') AS answered FROM ruled WHERE NOT done)"""),
    "apply_categories": _with(RULED, """
SELECT date, repo_name, event_count, CASE WHEN done THEN 'Infra' ELSE category END AS category,
       CASE WHEN done THEN 0.75::DOUBLE ELSE confidence END AS category_confidence,
       CASE WHEN done THEN TIMESTAMP '2024-02-02 00:00:00'
            ELSE TIMESTAMP '2024-02-04 00:00:00' END AS categorized_at FROM ruled"""),
    "stamp_and_key": _with(DELIVERIES, """
SELECT CAST(repo_id AS VARCHAR) AS key, count(*) AS records, count(DISTINCT id) AS ids,
       count(*) AS stamped FROM deliveries GROUP BY repo_id"""),
    "pulse_grain": _with(GRAIN, """
SELECT minute, type, repo_name, actor_id, count(*) AS n FROM arrivals
GROUP BY minute, type, repo_name, actor_id"""),
    "minute_activity": _with(GRAIN, """
SELECT minute, count(*) AS events, count(DISTINCT repo_name) AS unique_repos,
       count(DISTINCT actor_id) AS unique_actors FROM arrivals GROUP BY minute"""),
    "minute_types": _with(GRAIN, """
SELECT minute, type, count(*) AS events FROM arrivals GROUP BY minute, type"""),
    "pulse_minutes": _with(GRAIN, """,
last AS (SELECT max(minute) AS m FROM arrivals),
spine AS (SELECT m - to_minutes(CAST(i AS INTEGER)) AS minute FROM last, range(60) r(i))
SELECT s.minute, count(a.id) AS events, count(DISTINCT a.repo_name) AS unique_repos
FROM spine s LEFT JOIN arrivals a ON a.minute = s.minute GROUP BY s.minute"""),
    "current_minute": _with(GRAIN, """
SELECT minute, count(*) AS events, count(DISTINCT repo_name) AS unique_repos FROM arrivals
WHERE minute = (SELECT max(minute) FROM arrivals) GROUP BY minute"""),
    "pulse_totals": _with(LAST_DAY, """
SELECT count(*) AS events, count(DISTINCT repo_name) AS unique_repos,
       count(DISTINCT actor_id) AS unique_actors FROM last_day"""),
    "pulse_types": _with(LAST_DAY, "SELECT type, count(*) AS events FROM last_day GROUP BY type"),
    "pulse_top": _with(LAST_DAY, """,
types AS (
  SELECT * FROM (
    SELECT repo_name, type, row_number() OVER (PARTITION BY repo_name ORDER BY count(*) DESC, type DESC) AS rn
    FROM last_day GROUP BY repo_name, type) WHERE rn = 1
)
SELECT l.repo_name, count(*) AS events, any_value(t.type) AS primary_type
FROM last_day l JOIN types t ON l.repo_name = t.repo_name
GROUP BY l.repo_name ORDER BY events DESC, l.repo_name LIMIT 10"""),
    "freshness": _with(DELIVERIES, """
SELECT count(*) AS messages, max(arrived) AS last_event_at,
       round((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(max(arrived))) / 1000000.0::DOUBLE, 6)
         + 0.0 AS lag_seconds
FROM deliveries"""),
    "stream_pulse": _with(GRAIN, """
SELECT minute, count(*) AS events, count(DISTINCT repo_name) AS unique_repos,
       count(DISTINCT actor_id) AS unique_actors FROM arrivals WHERE source = 'live' GROUP BY minute"""),
    "stream_bronze_sink": _with(DELIVERIES, """
SELECT year, month, day, hour, count(*) AS n, count(DISTINCT id) AS ids
FROM deliveries WHERE source = 'live' GROUP BY year, month, day, hour"""),
}
