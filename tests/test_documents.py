from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.operators import classify, documents
from tidemark.plans import insights
from tidemark.schemas import DOCUMENT
from tidemark.sources import tables
from tidemark.sources.tables import read_documents, with_date_parts, write_gold

T1, T2 = dt.datetime(2024, 1, 16), dt.datetime(2024, 1, 17)
DAY = "2024-01-15"


def docs(spark, *rows):
    names = DOCUMENT.fieldNames()
    base = {"date": DAY}
    return spark.createDataFrame([tuple((base | r).get(n) for n in names) for r in rows], DOCUMENT)


def by_name(frame):
    return {r.repo_name: r for r in frame.collect()}


def test_core_fields_win_even_when_null_and_others_survive(spark):
    base = docs(spark, {"repo_name": "o/a", "event_count": 5, "anomaly_score": 2.0, "category": "Web", "category_confidence": 0.9,
                        "category_reasoning": "old", "categorized_at": T1, "repo_insight_markdown": "cached"},
                {"repo_name": "o/keep", "event_count": 1})
    new = docs(spark, {"repo_name": "o/a", "event_count": 7, "indexed_at": T2, "categorized_at": T2, "category_reasoning": "ignored"},
               {"repo_name": "o/new", "event_count": 3})
    found = by_name(documents.upsert_docs(base, new))
    a = found["o/a"]
    assert (a.event_count, a.anomaly_score, a.indexed_at) == (7, None, T2)
    assert (a.category, a.category_confidence, a.category_reasoning, a.categorized_at) == ("Web", 0.9, "old", T1)
    assert a.repo_insight_markdown == "cached"
    assert found["o/keep"].event_count == 1 and found["o/new"].event_count == 3


def test_category_block_needs_a_category_and_reasoning_text(spark):
    base = docs(spark, *[{"repo_name": n, "category": "Web", "category_reasoning": "old", "category_confidence": 0.9} for n in "abc"])
    new = docs(spark, {"repo_name": "a", "category": "Game", "category_reasoning": ""},
               {"repo_name": "b", "category": "", "category_reasoning": "x"},
               {"repo_name": "c", "category": "Infra", "category_reasoning": "new", "category_confidence": 0.1})
    found = {k: (r.category, r.category_reasoning, r.category_confidence) for k, r in by_name(documents.upsert_docs(base, new)).items()}
    assert found == {"a": ("Game", "old", None), "b": ("Web", "old", 0.9), "c": ("Infra", "new", 0.1)}


def test_names_that_differ_in_one_character_stay_apart(spark):
    merged = documents.upsert_docs(docs(spark, {"repo_name": "a/b_c"}), docs(spark, {"repo_name": "a_b/c"}))
    assert rows_of(merged, "repo_name") == [("a/b_c",), ("a_b/c",)]


def test_many_updates_of_one_key_equal_applying_them_one_by_one(spark):
    steps = [
        {"event_count": 1, "category": "Web", "category_reasoning": "first", "category_confidence": 0.1},
        {"event_count": 2, "anomaly_score": 5.0},
        {"event_count": None, "category": "Game", "category_reasoning": "", "category_confidence": 0.2},
        {"event_count": 4},
    ] * 25
    base = docs(spark, {"repo_name": "x", "event_count": 0})
    one_by_one = {"event_count": 0, "anomaly_score": None, "category": None, "category_reasoning": None, "category_confidence": None}
    for s in steps:
        one_by_one |= {k: s.get(k) for k in ("event_count", "anomaly_score")}
        if s.get("category"):
            one_by_one |= {"category": s["category"], "category_confidence": s["category_confidence"]}
            if s["category_reasoning"]:
                one_by_one["category_reasoning"] = s["category_reasoning"]
    batch = docs(spark, *[{"repo_name": "x", "repo_id": str(i)} | s for i, s in enumerate(steps)])
    seq = F.col("repo_id").cast("int")
    row = documents.upsert_docs(base, batch, seq).first().asDict()
    assert {k: row[k] for k in one_by_one} == one_by_one


def test_insight_cache(spark):
    base = docs(spark, {"repo_name": "o/a", "event_count": 5})
    texts = spark.createDataFrame([(DAY, "o/a", "text"), (DAY, "o/b", "more")], "date string, repo_name string, repo_insight_markdown string")
    stored = documents.cache_repo_insight(base, texts, F.lit(T1).cast("timestamp_ntz"))
    found = by_name(stored)
    assert (found["o/a"].event_count, found["o/a"].repo_insight_markdown, found["o/a"].repo_insight_generated_at) == (5, "text", T1)
    assert found["o/b"].event_count is None
    assert rows_of(documents.get_repo_insight(stored, DAY, "o/b"), "repo_insight_markdown") == [("more",)]
    assert documents.get_repo_insight(stored, DAY, "o/c").isEmpty()


def test_docs_by_date_and_dates(spark):
    rows = [{"repo_name": n, "rank_score": s} for n, s in (("a", 1.0), ("b", None), ("c", 3.0), ("d", 1.0))]
    frame = docs(spark, *rows, {"repo_name": "z", "date": "2024-01-14", "rank_score": 9.0})
    assert rows_of(documents.docs_by_date(frame, DAY, 3), "rank", "repo_name", "total") == [(1, "c", 4), (2, "a", 4), (3, "d", 4)]
    assert documents.docs_by_date(frame, size=10).count() == 5
    assert [r[0] for r in documents.indexed_dates(frame).collect()] == [DAY, "2024-01-14"]


def ranked(spark, *rows):
    cols = "event_date date, repo_id bigint, repo_name string, event_count bigint, rank_score double"
    return spark.createDataFrame([(dt.date(2024, 1, 15), *r) for r in rows], cols)


def test_merge_fill_and_trend(spark):
    rows = ranked(spark, (1, "o/a", 10, 3.0), (2, "o/b", 5, 2.0), (3, "o/c", 1, 1.0))
    stored = docs(spark, {"repo_name": "o/a", "category": "Web", "category_confidence": 0.9}, {"repo_name": "o/b"},
                  {"repo_name": "o/c", "date": "2024-01-14", "category": "Game"})
    merged = documents.merge_categories(rows, stored)
    assert rows_of(merged, "repo_name", "category") == [("o/a", "Web"), ("o/b", None), ("o/c", None)]
    answers = spark.createDataFrame(
        [(dt.date(2024, 1, 15), n, c, 0.5, "r", p) for n, c, p in (("o/a", "Infra", 0), ("o/b", "Game", 0), ("o/b", "Infra", 1))],
        "event_date date, repo_name string, category string, confidence double, reasoning string, position int")
    filled = documents.fill_missing_categories(merged, answers)
    assert rows_of(filled, "repo_name", "category", "category_confidence") == [("o/a", "Web", 0.9), ("o/b", "Infra", 0.5), ("o/c", None, None)]
    assert rows_of(documents.category_trending(filled), "category", "repos", "total_events") == [("Infra", 1, 5), ("Other", 1, 1), ("Web", 1, 10)]
    assert documents.category_trending(filled, 1).count() == 3


def test_replacing_documents_touches_their_dates_only(spark, tmp_path):
    root = str(tmp_path)
    documents.replace_documents(spark, root, docs(spark, {"repo_name": "a"}, {"repo_name": "b", "date": "2024-01-14"}))
    documents.index_daily(spark, root, docs(spark, {"repo_name": "c", "event_count": 1}, {"repo_name": "no", "date": "2024-01-13"}), DAY)
    found = rows_of(read_documents(spark, root), "date", "repo_name")
    assert found == [("2024-01-14", "b"), (DAY, "a"), (DAY, "c")]
    stats = documents.index_stats(spark, root).first()
    assert stats.doc_count == 3 and stats.size_bytes > 0


def test_categorize_daily_counts_skips_and_errors(spark, tmp_path):
    root = str(tmp_path)
    text = "intro\n#### 1. o/new\nbody\n#### 2. o/done"
    documents.replace_documents(spark, root, docs(
        spark,
        {"repo_name": "o/new", "insight_markdown": text, "rank_score": 2.0, "event_count": 4},
        {"repo_name": "o/poison", "rank_score": 1.0},
        {"repo_name": "o/done", "category": "Web", "categorized_at": T1, "rank_score": 3.0},
    ))

    def fn(batch):  # nested, so that workers get it by value
        if (batch["repo_name"] == "o/poison").any():
            raise ValueError("cannot classify")
        return pd.DataFrame({"category": "Infra", "confidence": 0.5, "reasoning": batch["excerpt"]})

    report = insights.categorize_daily(spark, root, DAY, fn)
    assert report == {"date": DAY, "total": 3, "classified": 1, "skipped": 1, "errors": 1}
    found = by_name(read_documents(spark, root))
    assert (found["o/new"].category, found["o/new"].category_reasoning) == ("Infra", "#### 1. o/new\nbody")
    assert found["o/new"].event_count == 4 and found["o/new"].categorized_at is not None
    assert found["o/done"].category == "Web" and found["o/poison"].category is None
    again = insights.categorize_daily(spark, root, DAY, fn)
    assert (again["classified"], again["skipped"], again["errors"]) == (0, 2, 1)
    best = insights.categorize_daily(spark, root, DAY, force=True, size=1)
    assert best == {"date": DAY, "total": 1, "classified": 1, "skipped": 0, "errors": 0}
    assert insights.categorize_daily(spark, root, "2020-01-01")["total"] == 0


def test_keyword_rules(spark):
    names = {"o/tiny-llm": "AI/ML", "k/kubectl-x": "Infra", "r/react-kit": "Web", "g/godot-demo": "Game", "t/e2e": "Other",
             "x/copy-bot": "Other", "c/some-cli": "DevTools", "z/zzz": "Other"}
    frame = spark.createDataFrame([(DAY, n, "PushEvent", 1, "") for n in names],
                                  "date string, repo_name string, dominant_event_type string, event_count int, excerpt string")
    found = classify.classify_repos(frame)
    assert dict(rows_of(found, "repo_name", "category")) == names
    hinted = frame.where("repo_name = 'z/zzz'").withColumn("excerpt", F.lit("a Docker helper"))
    assert rows_of(classify.classify_repos(hinted), "category", "confidence") == [("Infra", 0.6)]


def test_daily_insights_ranks_classifies_and_indexes(spark, tmp_path):
    root = str(tmp_path)
    day = dt.date(2024, 1, 15)
    write_gold(with_date_parts(spark.createDataFrame(
        [(day, i, f"o/llm-{i}", 60 + i, 1, "PushEvent", 0, 0, 0, 0, 0, T1, T1) for i in range(3)],
        tables.GOLD["repo_daily"])), root, "repo_daily")
    write_gold(with_date_parts(spark.createDataFrame(
        [(day, i, f"o/llm-{i}", 60 + i, 20, 40, 2.0, "PushEvent") for i in range(3)], tables.GOLD["repo_acceleration"])), root, "repo_acceleration")
    write_gold(with_date_parts(spark.createDataFrame(
        [(day, i, f"o/llm-{i}", 60 + i, 0.0, 5, 0.1, 1.0, 0.1, 0.0, 1.0) for i in range(3)], tables.GOLD["repo_anomaly"])), root, "repo_anomaly")
    documents.replace_documents(spark, root, docs(spark, {"repo_name": "o/llm-1", "category": "Web", "category_confidence": 0.4, "category_reasoning": "kept"}))
    rows = insights.daily_insights(spark, root, DAY, "the day's text")
    assert rows_of(rows, "repo_name", "category") == [("o/llm-0", "AI/ML"), ("o/llm-1", "Web"), ("o/llm-2", "AI/ML")]
    found = by_name(read_documents(spark, root))
    assert set(found) == {"o/llm-0", "o/llm-1", "o/llm-2"}
    assert found["o/llm-2"].insight_markdown == "the day's text" and found["o/llm-2"].repo_id == "2"
    assert found["o/llm-1"].category_reasoning == "kept"
    insights.write_repo_enriched(spark, root, DAY, "rules")
    enriched = tables.read_gold(spark, root, "repo_enriched", DAY)
    assert rows_of(enriched, "repo_id", "category", "model_id") == [(0, "AI/ML", "rules"), (1, "Web", "rules"), (2, "AI/ML", "rules")]
    assert insights.daily_insights(spark, root, "2024-01-16").isEmpty()


def test_updates_of_one_key_without_an_order_leave_one_row(spark, tmp_path):
    root = str(tmp_path)
    new = docs(spark, {"repo_name": "o/a", "rank_score": 1.0, "event_count": 1}, {"repo_name": "o/a", "rank_score": 2.0, "event_count": 2},
               {"repo_name": None, "event_count": 3}, {"repo_name": None, "event_count": 3})
    for _ in range(3):
        documents.index_daily(spark, root, new, DAY)
    assert rows_of(read_documents(spark, root), "repo_name", "event_count") == [("o/a", 2), (None, 3)]


def rows_to_classify(spark, *names):
    return spark.createDataFrame([(DAY, n, "PushEvent", 1, "") for n in names],
                                 "date string, repo_name string, dominant_event_type string, event_count int, excerpt string")


def test_answers_are_checked_and_missing_ones_fail(spark):
    def few(batch):
        return pd.DataFrame({"date": DAY, "repo_name": ["b", "a"], "category": ["Cooking", None], "confidence": [9.0, 0.1], "reasoning": ["r", "s"]})

    found = rows_of(classify.classify_repos(rows_to_classify(spark, "a", "b", "c").coalesce(1), few), "repo_name", "category", "confidence", "failed")
    assert found == [("a", None, None, True), ("b", "Other", 1.0, False), ("c", None, None, True)]

    def one(batch):  # too few answers without names: asked again row by row
        return pd.DataFrame({"category": ["Web"], "confidence": ["high"], "reasoning": [batch["repo_name"].iloc[0]]})

    found = rows_of(classify.classify_repos(rows_to_classify(spark, "a", "b").coalesce(1), one), "repo_name", "category", "confidence", "reasoning", "failed")
    assert found == [("a", "Web", 0.0, "a", False), ("b", "Web", 0.0, "b", False)]


def test_rules_need_whole_words(spark):
    names = {"o/client": "Other", "o/my-bottle": "Other", "o/rebuilding": "Other", "o/cloudy": "Other", "o/sdk_x": "DevTools"}
    found = classify.classify_repos(rows_to_classify(spark, *names))
    assert dict(rows_of(found, "repo_name", "category")) == names
    assert {r.reasoning for r in found.where("repo_name != 'o/sdk_x'").collect()} == {"no rule matched"}
