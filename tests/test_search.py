from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from tests.conftest import rows_of
from tidemark.operators import search
from tidemark.schemas import DOCUMENT

WORDS = ["the", "agent", "rust", "terminal", "snake_case", "naïve", "ai", "kit"]


def corpus(spark, texts):
    """texts: (date, repo_name, body)"""
    names = DOCUMENT.fieldNames()
    rows = [tuple({"date": d, "repo_name": n, "insight_markdown": b}.get(f) for f in names) for d, n, b in texts]
    return spark.createDataFrame(rows, DOCUMENT)


def index_of(spark, texts):
    docs = corpus(spark, texts)
    index = search.build_token_index(docs)
    return index, search.field_stats(index)


def test_tokens(spark):
    assert search.query_tokens(spark, "Foo-bar/BAZ_1, ÉTÉ été's  v2.0") == ["foo", "bar", "baz_1", "été", "s", "v2", "0"]
    assert search.query_tokens(spark, " -/! ") == []


def test_all_tokens_must_stand_in_one_field(spark):
    texts = [("d1", "o/agent", "rust only"), ("d1", "o/none", "a rust agent"), ("d1", "rust/agent", None), ("d1", "o/x", "agent")]
    found = search.search(*index_of(spark, texts), "Agent RUST")
    assert [r.repo_name for r in found.collect()] == ["rust/agent", "o/none"]
    assert search.search_total(*index_of(spark, texts), "agent rust").first().total == 2
    assert search.search(*index_of(spark, texts), "").isEmpty()
    assert search.search(*index_of(spark, texts), "unknown").isEmpty()


def test_equal_scores_show_the_newest_first(spark):
    texts = [("2024-01-01", "a/kit", "x"), ("2024-01-03", "b/kit", "x"), ("2024-01-03", "a/kit", "x")]
    found = search.search(*index_of(spark, texts), "kit", 2).collect()
    assert [(r.date, r.repo_name) for r in found] == [("2024-01-03", "a/kit"), ("2024-01-03", "b/kit")]


def brute_force(texts, terms):
    scores = {}
    for field, weight in (("name", 2.0), ("body", 1.0)):
        split = {}
        for d, n, b in texts:
            text = n if field == "name" else (b or "")
            split[(d, n)] = [t for t in text.lower().replace("/", " ").replace("-", " ").split() if t]
        split = {k: v for k, v in split.items() if v}
        mean = sum(map(len, split.values())) / len(split)
        df = Counter(t for v in split.values() for t in set(v))
        for key, toks in split.items():
            tf = Counter(toks)
            if not all(tf[t] for t in terms):
                continue
            score = sum(
                math.log(1 + (len(split) - df[t] + 0.5) / (df[t] + 0.5))
                * tf[t] / (tf[t] + 1.2 * (0.25 + 0.75 * len(toks) / mean))
                for t in terms
            )
            scores[key] = max(scores.get(key, 0.0), weight * score)
    return scores


def test_scores_equal_brute_force_with_a_token_in_every_document(spark, tmp_path):
    rng = random.Random(3)
    texts = [
        (f"2024-01-{1 + i % 9:02d}", f"org{i}/{rng.choice(WORDS)}-{rng.choice(WORDS)}",
         " ".join(["the"] * rng.randrange(1, 40) + rng.choices(WORDS, k=rng.randrange(30))))
        for i in range(300)
    ]
    docs = corpus(spark, texts)
    search.write_token_index(docs, str(tmp_path))
    stored = [spark.read.parquet(f"{tmp_path}/{t}") for t in ("postings", "fields")]
    for query in ("the", "agent the", "rust snake_case naïve"):
        want = brute_force(texts, query.split())
        got = {(r.date, r.repo_name): r.score for r in search.matches(*stored, query.split()).collect()}
        assert set(got) == set(want)
        for key, score in want.items():
            assert got[key] == pytest.approx(score, abs=1e-9)
    plan = search.matches(*stored, ["rust"])._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(token), EqualTo(token,rust)" in plan


def test_index_counts(spark):
    index, fields = index_of(spark, [("d", "o/a", "the The x"), ("d", "o/b", "")])
    assert rows_of(index.where("field = 'body'"), "token", "tf", "dl") == [("the", 2, 3), ("x", 1, 3)]
    assert rows_of(fields, "field", "docs", "avg_dl") == [("body", 1, 3.0), ("name", 2, 2.0)]


def test_hits_are_documents(spark):
    texts = [("d1", "o/agent", "rust only"), ("d2", "o/none", "a rust agent"), ("d2", "o/x", "agent")]
    found = search.search_documents(*index_of(spark, texts), corpus(spark, texts), "agent", 2)
    assert rows_of(found, "rank", "repo_name", "total", "insight_markdown") == [
        (1, "o/agent", 3, "rust only"), (2, "o/x", 3, "agent"),
    ]
