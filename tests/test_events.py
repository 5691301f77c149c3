from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import bronze_frame, event, rows_of
from tidemark.functions.languages import ALIASES, LANGUAGE_PATHS, normalize_language
from tidemark.operators import events


def silver(spark, archive, live):
    return events.silver_events(bronze_frame(spark, archive), bronze_frame(spark, live, live=True))


def test_live_wins_over_archive_and_first_arrival_over_second(spark):
    archive = [event("a"), event("b")]
    live = [
        event("a", _ingested_at="2024-01-15T10:00:30Z"),
        event("c", _ingested_at="2024-01-15T10:00:90Z", actor=2),
        event("c", _ingested_at="2024-01-15T10:00:10Z", actor=1),
    ]
    found = rows_of(silver(spark, archive, live), "event_id", "source", "actor_id")
    assert found == [("a", "live", 7), ("b", "archive", 7), ("c", "live", 1)]


def test_archive_wins_in_the_hourly_order(spark):
    both = events.union_sources(
        bronze_frame(spark, [event("a")]),
        bronze_frame(spark, [event("a", _ingested_at="x"), event("b", _ingested_at="x")], live=True),
    )
    assert rows_of(events.dedup_archive_first(both), "id", "source") == [("a", "archive"), ("b", "live")]


def test_an_id_on_both_sides_of_midnight_counts_on_both_days(spark):
    rows = [event("a"), event("a", _d="16", _h="00")]
    found = rows_of(silver(spark, rows, []), "event_id", "day", "hour")
    assert found == [("a", "15", "10"), ("a", "16", "00")]


def test_rows_without_id_or_with_unreadable_time_are_set_aside(spark):
    archive = bronze_frame(
        spark,
        [event(None), event(None), event("bad", created="yesterday"), event("none", created=None), event("ok")],
    )
    live = bronze_frame(spark, [], live=True)
    good = events.silver_events(archive, live)
    assert rows_of(good, "event_id") == [("none",), ("ok",)]
    bad = events.rejected_deliveries(archive, live)
    assert rows_of(bad.groupBy("reject_reason").count()) == [("no id", 2), ("unreadable created_at", 1)]


def test_created_at_becomes_utc(spark):
    rows = [
        event("z", created="2024-01-15T10:00:00Z"),
        event("k", created="2024-01-15T19:00:00+09:00"),
        event("s", created="2024-01-15 10:00:00"),
    ]
    found = silver(spark, rows, []).select("created_at").distinct().collect()
    assert [r[0] for r in found] == [dt.datetime(2024, 1, 15, 10)]


@pytest.mark.parametrize("path", LANGUAGE_PATHS)
def test_language_is_found_on_every_path(spark, path):
    payload = "rust"
    for step in reversed(path.split(".")):
        payload = {step: payload}
    assert rows_of(silver(spark, [event(payload=payload)], []), "repo_language") == [("Rust",)]


def test_first_language_path_wins_and_null_is_passed_over(spark):
    def pr(head, base):
        return {"pull_request": {"head": {"repo": head}, "base": {"repo": base}}}

    payloads = {
        "both": pr({"language": "Go"}, {"language": "Rust"}),
        "head_null": pr({"language": None}, {"language": "Rust"}),
        "no_head": pr(None, {"language": "Rust"}),
        "object": {"forkee": {"language": {"name": "Go"}}},
        "object_then_path": {
            "repository": {"language": ["Go"]},
            "forkee": {"language": "py"},
        },
        "odd_shape": {"pull_request": "gone", "forkee": {"language": "Ruby"}},
        "number": {"repository": {"language": 7}},
        "empty": {"repository": {"language": ""}},
        "spaces": {"repository": {"language": " go "}},
    }
    rows = [event(k, payload=v) for k, v in payloads.items()] + [event("text", payload="not json")]
    assert dict(rows_of(silver(spark, rows, []), "event_id", "repo_language")) == {
        "both": "Go",
        "head_null": "Rust",
        "no_head": "Rust",
        "object": "Unknown",
        "object_then_path": "Python",
        "odd_shape": "Ruby",
        "number": "7",
        "empty": "Unknown",
        "spaces": " go ",
        "text": "Unknown",
    }


def test_every_alias_in_any_case(spark):
    frame = spark.createDataFrame([(a.upper(), n) for a, n in ALIASES.items()], "raw string, name string")
    wrong = frame.where(normalize_language(F.col("raw")) != F.col("name"))
    assert wrong.count() == 0
    other = spark.createDataFrame([("hASKELL",), (None,)], "raw string")
    assert [r[0] for r in other.select(normalize_language(F.col("raw"))).collect()] == ["hASKELL", "Unknown"]


def test_payload_action_must_be_a_scalar(spark):
    rows = [
        event("a", payload={"action": "opened"}),
        event("b", payload={"action": None}),
        event("c", payload={"action": {"x": 1}}),
        event("d", payload={}),
    ]
    found = dict(rows_of(silver(spark, rows, []), "event_id", "payload_action"))
    assert found == {"a": "opened", "b": None, "c": None, "d": None}


def test_one_id_with_very_many_copies_is_cut_before_the_shuffle(spark):
    copies = F.explode(F.sequence(F.lit(1), F.lit(3000)))
    archive = bronze_frame(spark, [event("hot")]).withColumn("_n", copies).drop("_n")
    archive = archive.unionByName(bronze_frame(spark, [event(str(i)) for i in range(50)]))
    deduped = events.dedup_live_first(
        events.union_sources(archive, bronze_frame(spark, [], live=True))
    )
    assert deduped.count() == 51
    plan = deduped._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    assert "WindowGroupLimit" in plan and "Partial" in plan
