from __future__ import annotations

import random

import pytest

from tests.conftest import rows_of
from tests.test_search import WORDS, corpus
from tidemark.operators import search, token_store


def texts_of(rng, n, dates=9):
    """Documents of very different lengths; 'the' is in every one."""
    return [
        (
            f"2024-01-{1 + i % dates:02d}",
            f"org{i}/{rng.choice(WORDS)}-{rng.choice(WORDS)}",
            " ".join(["the"] * rng.randrange(1, 40) + rng.choices(WORDS, k=rng.choice([0, 3, 30, 300]))),
        )
        for i in range(n)
    ]


def tables(spark, path):
    return {name: rows_of(token_store.read_table(spark, path, name)) for name in token_store.TABLES}


def test_updates_equal_a_full_build(spark, tmp_path):
    rng = random.Random(5)
    right = texts_of(rng, 60)
    stale = [(d, n, b + " stale") if i % 3 else (d, n, b) for i, (d, n, b) in enumerate(right) if i % 5]
    grown, full = str(tmp_path / "grown"), str(tmp_path / "full")
    token_store.update_token_index(corpus(spark, stale), grown)
    done = token_store.update_token_index(corpus(spark, right[:30]), grown)
    # a name never changes; 6 documents were not there, 16 of the others were stale
    assert done["texts"] == 6 * 2 + sum(1 for i in range(30) if i % 5 and i % 3)
    token_store.update_token_index(corpus(spark, right), grown)
    token_store.update_token_index(corpus(spark, right), full)
    assert tables(spark, grown) == tables(spark, full)
    wanted = search.build_token_index(corpus(spark, right))
    assert rows_of(token_store.read_table(spark, grown, "postings"), *wanted.columns) == rows_of(wanted)


def test_only_touched_dates_are_rewritten(spark, tmp_path):
    rng = random.Random(6)
    right, path = texts_of(rng, 30, dates=3), str(tmp_path / "index")
    token_store.update_token_index(corpus(spark, right), path)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "index").rglob("*.parquet")}
    assert token_store.update_token_index(corpus(spark, right), path) == {"texts": 0, "dates": 0}
    assert files == {p: p.stat().st_mtime_ns for p in (tmp_path / "index").rglob("*.parquet")}
    changed = [(d, n, "new words" if d == "2024-01-02" else b) for d, n, b in right]
    assert token_store.update_token_index(corpus(spark, changed), path)["dates"] == 1
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "index").rglob("*.parquet")}
    kept = {p: t for p, t in files.items() if "date=2024-01-02" not in str(p)}
    assert kept == {p: t for p, t in after.items() if "date=2024-01-02" not in str(p)}


def test_removed_documents_and_dates(spark, tmp_path):
    texts, path = [("d1", "o/a", "x y"), ("d1", "o/b", "x"), ("d2", "o/c", "x"), (None, "o/d", "x")], str(tmp_path / "i")
    token_store.update_token_index(corpus(spark, texts), path)
    assert rows_of(token_store.read_table(spark, path, "lengths"), "date", "field", "docs", "dl")[0] == ("d1", "body", 2, 3)
    token_store.update_token_index(corpus(spark, texts[:1]), path, whole_dates=True)
    left = token_store.read_table(spark, path, "texts")
    assert rows_of(left.select("date", "repo_name").distinct()) == [("d1", "o/a"), ("d2", "o/c")]
    token_store.update_token_index(corpus(spark, [("d1", "o/a", ""), ("d2", "o/c", None)]), path)
    bodies = token_store.read_table(spark, path, "postings").where("field = 'body'")
    assert bodies.isEmpty()
    assert token_store.update_token_index(corpus(spark, []), path) == {"texts": 0, "dates": 0}


@pytest.fixture(scope="module")
def big(spark, tmp_path_factory):
    rng = random.Random(7)
    texts, path = texts_of(rng, 1500, dates=2), str(tmp_path_factory.mktemp("store"))
    old, token_store.PAGE_ROWS = token_store.PAGE_ROWS, 100
    token_store.update_token_index(corpus(spark, texts), path)
    token_store.PAGE_ROWS = old
    index = search.build_token_index(corpus(spark, texts)).cache()
    return path, index, search.field_stats(index)


@pytest.mark.parametrize(
    "query,first",
    [("the", 1), ("the", 16), ("agent the", 1), ("rust snake_case naïve", 4), ("org7", 1), ("unknown the", 1), ("", 1)],
)
def test_best_documents_are_those_of_a_full_search(spark, big, query, first):
    path, index, fields = big
    found = token_store.best_documents(spark, path, query, 20, first).collect()
    wanted = search.search(index, fields, query, 20).collect()
    assert [(r.date, r.repo_name) for r in found] == [(r.date, r.repo_name) for r in wanted]
    assert [r.score for r in found] == pytest.approx([r.score for r in wanted], abs=2e-9)


def rows_read(frame):
    """Rows that the scans of a plan without shuffles gave out."""
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_few_postings_are_read(spark, big, monkeypatch):
    path, index, _ = big
    seen, within = [], token_store._within

    def counted(postings, slices):
        frame = within(postings, slices)
        if frame is not None:
            seen.append(rows_read(frame))
        return frame

    monkeypatch.setattr(token_store, "_within", counted)
    token_store.best_documents(spark, path, "the", 5, first_slices=4)
    postings = index.where("token = 'the'").count()
    assert seen and sum(seen) < 0.8 * postings


def shuffled_rows(frame):
    """Rows that the exchanges of a frame's plan wrote."""
    frame.collect()
    plans, rows = [frame._jdf.queryExecution().executedPlan()], 0
    while plans:
        plan = plans.pop()
        plans += [plan.children().apply(i) for i in range(plan.children().size())]
        if plan.nodeName() == "Exchange":
            rows += plan.metrics().apply("shuffleRecordsWritten").value()
    return rows


def test_an_update_shuffles_texts_not_postings(spark, tmp_path, monkeypatch):
    rng = random.Random(8)
    texts, path = texts_of(rng, 200, dates=3), str(tmp_path / "index")
    seen, replace = {}, token_store._replace

    def counted(rows, path, name, order):
        seen[name] = shuffled_rows(rows)
        replace(rows, path, name, order)

    monkeypatch.setattr(token_store, "_replace", counted)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        token_store.update_token_index(corpus(spark, texts), path)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    postings = token_store.read_table(spark, path, "postings").count()
    assert postings > 4 * 2 * len(texts)
    assert seen["postings"] == 2 * len(texts) and seen["bounds"] == 2 * len(texts)


def test_a_slice_lies_in_one_file_sorted_by_token(spark, tmp_path, monkeypatch):
    rng = random.Random(9)
    texts, path = texts_of(rng, 300, dates=2), str(tmp_path / "index")
    monkeypatch.setattr(token_store, "LEAST_TOKENS", 100)
    token_store.update_token_index(corpus(spark, texts[:200]), path)
    token_store.update_token_index(corpus(spark, texts), path)
    files = sorted((tmp_path / "index" / "postings").rglob("*.parquet"))
    slices = []
    for file in files:
        rows = spark.read.parquet(str(file)).select("token", "field", "slice").collect()
        assert rows == sorted(rows)
        slices += {(file.parent.name, r.field, r.slice) for r in rows}
    assert len(files) > 2 and len(slices) == len(set(slices))


def test_repeated_documents_add_up_as_in_a_full_build(spark, tmp_path):
    texts = [("d1", "o/a", "x y x"), ("d1", "o/a", "x y x"), ("d1", "o/a", "x"), ("d2", "o/b", "-"), ("d2", "o/b", "z")]
    path = str(tmp_path / "index")
    token_store.update_token_index(corpus(spark, texts), path)
    wanted = search.build_token_index(corpus(spark, texts))
    assert rows_of(token_store.read_table(spark, path, "postings"), *wanted.columns) == rows_of(wanted)
