"""Bucketed documents, ledgers, days of a busy repository, rules in one pass, whole-month jobs."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tests.test_search import corpus
from tidemark.operators import classify, documents, quality, velocity
from tidemark.plans import insights
from tidemark.sources import document_buckets, ledger, tables


def docs_of(spark, numbers, text="x"):
    return corpus(spark, [(f"2024-01-{1 + n % 9:02d}", f"o/{n}", f"{text} {n}") for n in numbers])


@pytest.fixture
def table(spark):
    name = "stored_documents"
    document_buckets.create_document_buckets(docs_of(spark, range(300)), name, 8)
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_merge_into_buckets(spark, table):
    updates = docs_of(spark, range(250, 350), "new")
    wanted = documents.upsert_docs(docs_of(spark, range(300)), updates)
    document_buckets.merge_document_buckets(spark, table, updates, 8)
    assert rows_of(document_buckets.read_document_buckets(spark, table)) == rows_of(wanted)
    document_buckets.merge_document_buckets(spark, table, updates, 8)
    assert rows_of(document_buckets.read_document_buckets(spark, table)) == rows_of(wanted)
    assert document_buckets.buckets_for(10 << 30) == 40 and document_buckets.buckets_for(0) == 8


def test_stored_rows_are_not_shuffled(spark, table):
    """One Exchange, that of the updates; a key that is updated very often is folded before it."""
    hot = docs_of(spark, [7] * 500 + list(range(20)), "hot")
    merged = document_buckets.merged_documents(spark, table, hot)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    stored = plan[plan.index("FullOuter") :].split("\n")
    scan = next(i for i, line in enumerate(stored) if "Bucketed: true" in line)
    assert not any("Exchange" in line for line in stored[:scan])
    assert plan.count("Exchange hashpartitioning") <= 2 and merged.count() == 300


def test_a_broken_swap_is_finished(spark, table):
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}{document_buckets.NEXT}")
    assert document_buckets.read_document_buckets(spark, table).count() == 300


def silver_rows(spark, per_day):
    rows = [(f"{d}-{i}", "live" if i % 3 else "archive", *d.split("-")) for d, n in per_day.items() for i in range(n)]
    return spark.createDataFrame(rows, "event_id string, source string, year string, month string, day string")


def test_ledger_equals_a_recount(spark, tmp_path):
    path, day = str(tmp_path / "events"), F.concat_ws("-", "year", "month", "day")
    per_day = {"2024-01-01": 10, "2024-01-02": 5, "2024-01-03": 0}
    rows = silver_rows(spark, per_day)

    def write(frame):
        frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "year", "month", "day"
        ).parquet(path)

    live = {"live": F.col("source") == "live"}
    ledger.write_counted(rows, write, path, list(per_day), day, live)
    assert rows_of(ledger.ledger_report(spark, path), "day", "rows", "live") == [
        ("2024-01-01", 10, 6), ("2024-01-02", 5, 3), ("2024-01-03", 0, 0)
    ]
    ledger.write_counted(silver_rows(spark, {"2024-01-02": 8, "2024-01-01": 3}), write, path, ["2024-01-02"], day, live)
    stored = spark.read.schema(rows.schema).parquet(path).groupBy(day.alias("day")).count()
    counted = ledger.read_ledger(spark, path).where("name = 'rows' AND rows > 0")
    assert rows_of(counted, "day", "rows") == rows_of(stored) == [("2024-01-01", 10), ("2024-01-02", 8)]
    assert ledger.require_rows(spark, path, "2024-01-02") == 8
    for missing in ("2024-01-03", "2024-01-09"):
        with pytest.raises(quality.EmptyLayerError):
            ledger.require_rows(spark, path, missing)

    def fails(frame):
        raise RuntimeError("write failed")

    with pytest.raises(RuntimeError):
        ledger.write_counted(rows, fails, path, ["2024-01-01"], day)
    with pytest.raises(quality.EmptyLayerError):  # nobody knows what is in the folder now
        ledger.require_rows(spark, path, "2024-01-01")


def test_velocity_of_a_busy_repository_over_many_days(spark):
    """One repository with most rows: same numbers as windows over its whole history, keyed by day."""
    rng, start = random.Random(4), dt.datetime(2024, 1, 1)
    slots = sorted(rng.sample(range(12 * 288), 900))
    stars = {s: rng.choice([0, 0, 1, 5, 40]) for s in slots}
    rows = [(1, "o/hot", start + dt.timedelta(minutes=5 * s), n) for s, n in stars.items()]
    rows.append((2, "o/cold", start, 3))
    frame = spark.createDataFrame(rows, "repo_id bigint, repo_name string, ts_5min timestamp_ntz, star_count bigint")
    found = velocity.repo_velocity(frame)
    assert "hashpartitioning(repo_id" in (plan := found._jdf.queryExecution().executedPlan().toString())
    assert re.search(r"hashpartitioning\(repo_id#\d+L?, day#\d+L?", plan)
    for r in found.where("repo_id = 1").collect():
        slot = (r.ts_5min - start) // dt.timedelta(minutes=5)
        before = [stars.get(slot - k, 0) for k in range(1, 289)]
        mean = sum(before) / 288
        assert r.star_avg_24h == pytest.approx(mean)
        assert r.star_std_24h == pytest.approx((sum((b - mean) ** 2 for b in before) / 288) ** 0.5)
        assert r.delta_stars_per_hour == (stars[slot] - stars.get(slot - 12, 0)) * 12
    assert found.count() == len(rows)


def by_patterns(text):
    """The first rule with a word in the text, and its leftmost word, by one search per rule."""
    lowered = (text or "").lower()
    for category, words in classify.NAME_WORDS:
        pattern = "|".join(sorted(map(re.escape, words.split()), key=len, reverse=True))
        found = re.search(rf"(?<![a-z0-9])({pattern})(?![a-z0-9])", lowered)
        if found:
            return category, f"matched {found[1]}"
    return None


def test_rules_in_one_pass_equal_a_search_per_rule(spark):
    rng = random.Random(9)
    words = [w for _, all_words in classify.NAME_WORDS for w in all_words.split()]
    pieces = words + ["next", "js", "nn", "zero", "machine", "learning", "mattpocock", "é", "x", "", "İ", "K8S"]
    texts = ["".join(rng.choice(pieces) + rng.choice([" ", "-", "_", "/", ".", "", "\n"]) for _ in range(rng.randrange(6))) for _ in range(800)]
    texts += [None, "", "Next.JS", "next.jsx", "a-next.js-b", "nn-zero", "nn_zero", "nextjs next.js", "next.js nextjs", "http://x", "GPT"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = frame.select("i", classify._first_rule(F.col("t"), 0.9).alias("a")).select("i", "a.category", "a.reasoning")
    for i, category, reasoning in rows_of(found):
        wanted = by_patterns(texts[i])
        assert ((category, reasoning) if category else None) == wanted, repr(texts[i])


def test_prompts_fill_both_parts(spark):
    from tidemark.functions import prompts

    template = "## system\nIt is {{date}}.\n## user_template\n{{repo_name}} on {{date}}"
    system, user = prompts.render_prompt(template, {"date": F.lit("2024-01-02"), "repo_name": F.lit("o/a")})
    assert rows_of(spark.range(1).select(system, user)) == [("It is 2024-01-02.", "o/a on 2024-01-02")]


def test_stages_of_a_job_are_removed(spark, tmp_path):
    from tidemark.session import shared_dir
    from tidemark.sources.paths import child_names

    root = str(tmp_path / "lake")
    documents.replace_documents(spark, root, docs_of(spark, range(20), "a game"))
    before = set(child_names(spark, shared_dir(spark)))
    for date in ("2024-01-01", None):
        insights.categorize_daily(spark, root, date)
    assert set(child_names(spark, shared_dir(spark))) == before
    assert tables.read_documents(spark, root).where("category = 'Other'").count() == 20
