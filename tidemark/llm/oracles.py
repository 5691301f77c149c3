"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

CONTAMINATED = f"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
),
items AS (
  SELECT item, w, least(len(w), 10) AS n FROM (
    SELECT CAST(item_id AS VARCHAR) AS item,
           regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
  ) WHERE len(w) > 0
),
item_windows AS (
  SELECT DISTINCT item, n, array_to_string(w[k : k + n - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM items)
),
doc_windows AS (
  SELECT doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k
        FROM texts, (SELECT DISTINCT n FROM items) WHERE len(w) >= n)
),
hits AS (SELECT d.doc_id, d.k, d.n, i.item FROM doc_windows d JOIN item_windows i USING (n, win)),
counted AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS place FROM hits)
  GROUP BY doc_id
),
listed AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM texts LEFT JOIN counted USING (doc_id) LEFT JOIN listed USING (doc_id)"""

JOINED = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k : k + 4], ' '))) END AS s
  FROM texts
),
spread AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM shingled),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM spread a JOIN spread b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id
FROM shingled LEFT JOIN least_of ON a = doc_id"""

ARCHIVED = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
),
firsts AS (SELECT hex, min(page_id) AS first FROM payloads GROUP BY hex)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM payloads JOIN firsts USING (hex)"""

ORACLES = {
    "op3_decontaminate": CONTAMINATED,
    "op7_ngram_jaccard_join": JOINED,
    "op8_warc": ARCHIVED,
}
