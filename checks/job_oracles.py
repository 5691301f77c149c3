"""DuckDB SQL for the queries of ``checks.jobs``."""

from __future__ import annotations

from checks.oracles import (
    ACTOR_DAILY,
    DELIVERIES,
    DOCUMENTS,
    GRAIN,
    HOURLY,
    LANGUAGES,
    MATCHES,
    ORACLES,
    RANKED,
    REPO_DAILY,
    SILVER,
    TOKENS,
    _with,
)

JOB_ORACLES = {
    "update_token_index": ORACLES["build_token_index"],
    "token_bounds": _with(TOKENS, """
SELECT field, token, CAST(count(*) AS BIGINT) AS docs, max(tf) AS max_tf, min(dl) AS min_dl
FROM postings GROUP BY field, token"""),
    "best_documents": _with(MATCHES, """
SELECT date, repo_name, round(round(score, 9), 6) + 0.0 AS score FROM matched
ORDER BY round(matched.score, 9) DESC, date DESC, repo_name LIMIT 20"""),
    "upsert_docs_buckets": ORACLES["upsert_docs"],
    "stream_dedup": ORACLES["dedup_live_first"],
    "folded_pulse": ORACLES["minute_activity"],
    "pulse_totals_sketched": _with(GRAIN, """
SELECT 'hour' AS span, CAST(date_trunc('hour', minute) AS TIMESTAMP) AS start, count(*) AS events,
       true AS repos_within, true AS actors_within FROM arrivals GROUP BY 2
UNION ALL
SELECT 'day', CAST(date_trunc('day', minute) AS TIMESTAMP), count(*), true, true FROM arrivals GROUP BY 2"""),
    "stream_defaults": _with(DELIVERIES, """,
bare AS (
  SELECT coalesce(CASE WHEN CAST(id AS BIGINT) % 20 <> 0 THEN type END, 'Unknown') AS type,
         CASE WHEN CAST(id AS BIGINT) % 30 <> 0 THEN repo_name END AS repo_name
  FROM deliveries WHERE source = 'live'
)
SELECT type, count(*) AS events, count(*) - count(repo_name) AS without_repo, count(DISTINCT repo_name) AS repos
FROM bare GROUP BY type"""),
    "stream_health": _with(DELIVERIES, """
SELECT count(*) AS messages, true AS restarted, true AS fresh FROM deliveries WHERE source = 'live'"""),
    "silver_ledger": _with(SILVER, """
SELECT year || '-' || month || '-' || day AS day, count(*) AS rows,
       count(*) FILTER (source = 'live') AS live, count(*) FILTER (source = 'archive') AS archive
FROM silver GROUP BY 1"""),
    "create_tables": " UNION ALL ".join(
        f"""SELECT * FROM ({_with(part, f"""
SELECT strftime(event_date, '%Y') AS year, strftime(event_date, '%m') AS month,
       strftime(event_date, '%d') AS day, count(*) AS n, '{name}' AS name
FROM {name} GROUP BY 1, 2, 3""")})"""
        for name, part in (
            ("repo_daily", REPO_DAILY),
            ("actor_daily", ACTOR_DAILY),
            ("repo_hourly", HOURLY),
            ("language_activity", LANGUAGES),
        )
    ),
    "expire_bronze": _with(DELIVERIES, """
SELECT year, month, day, count(*) AS n FROM deliveries
WHERE source = 'archive' AND year || '-' || month || '-' || day >= '2024-01-11' GROUP BY year, month, day"""),
    "daily_insights": _with(RANKED, """
SELECT strftime(event_date, '%Y-%m-%d') AS date, repo_name, CAST(repo_id AS VARCHAR) AS repo_id,
       CAST(event_count AS INTEGER) AS event_count,
       round(rank_score, 6) + 0.0 AS rank_score,
       CASE WHEN repo_name = 'org/repo-1' THEN 'Infra'
            WHEN repo_name IN ('org/repo-2', 'org/repo-2-v2') THEN 'Game' ELSE 'Other' END AS category,
       CASE WHEN repo_name = 'org/repo-1' THEN 'matched kafka'
            WHEN repo_name IN ('org/repo-2', 'org/repo-2-v2') THEN 'matched game'
            ELSE 'no rule matched' END AS category_reasoning
FROM ranked"""),
    "categorize_daily": _with(DOCUMENTS, """
SELECT 1 AS run, count(*) AS total, count(*) FILTER (NOT done) AS classified,
       count(*) FILTER (done) AS skipped, CAST(0 AS BIGINT) AS errors FROM docs
UNION ALL SELECT 2, count(*), 0, count(*), 0 FROM docs"""),
}
