from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import prompts, responses

FAILED = ("Other", 0.0, "JSON parse failed")

SINGLE = {
    '{"category": "Web", "confidence": 0.5, "reasoning": "r"}': ("Web", 0.5, "r"),
    'so: {"category": "Web", "confidence": "0.25"} ok': ("Web", 0.25, ""),
    'x ```json\n{"category": "Infra", "confidence": 1}\n``` y {"category": "Web"}': ("Infra", 1.0, ""),
    '```\n{"category": "Game", "confidence": 7}\n```': ("Game", 1.0, ""),
    # the json fence is unreadable, so the braces count
    '```json\nnot json\n``` {"category": "DevTools", "confidence": -1}': ("DevTools", 0.0, ""),
    # a fence that never closes
    '```json\n{"category": "AI/ML", "confidence": 0.9}': ("AI/ML", 0.9, ""),
    '{"category": "Cooking", "confidence": 0.4, "reasoning": null}': ("Other", 0.4, "None"),
    '{"confidence": "high"}': ("Other", 0.0, ""),
    '{"category": "Web", "confidence": null}': ("Web", 0.0, ""),
    '{"category": "Web", "reasoning": "' + "é" * 300 + '"}': ("Web", 0.0, "é" * 300),
    '{"category": "Web"} and {"category": "Game"}': FAILED,
    '{"category": "Web", }': FAILED,
    "{'category': 'Web'}": FAILED,
    "} nothing {": FAILED,
    "": FAILED,
    "no braces": FAILED,
    '{"category": {"a": 1}, "reasoning": [1, 2]}': ("Other", 0.0, "[1,2]"),
}


def test_single_answers(spark):
    frame = spark.createDataFrame([(t,) for t in SINGLE] + [(None,)], "t string")
    got = {r.t: tuple(r.a) for r in frame.withColumn("a", responses.parse_category_response(F.col("t"))).collect()}
    assert got == SINGLE | {None: FAILED}


BATCH = {
    '[{"repo_name": " o/a ", "category": "Web", "confidence": 0.5, "reasoning": "r"}]': [("o/a", "Web", 0.5, "r")],
    '```json\n[{"repo_name": "o/a"}, 3, "text", null, [1], {"confidence": "bad"}]\n```': [("o/a", "Other", 0.0, ""), ("", "Other", 0.0, "")],
    'here: [{"repo_name": "o/b", "category": "Game", "confidence": 9}] done': [("o/b", "Game", 1.0, "")],
    '```\n[{"repo_name": "o/c"}]\n```': [("o/c", "Other", 0.0, "")],
    "[]": [],
    '{"repo_name": "o/a"}': [],
    '```json\n[{"repo_name": "o/a"}] trailing\n```': [],
    "[1, 2": [],
    "nothing": [],
    "": [],
}


def test_batch_answers(spark):
    frame = spark.createDataFrame([(t,) for t in BATCH] + [(None,)], "t string")
    got = {r.t: [tuple(x) for x in r.a] for r in frame.withColumn("a", responses.parse_batch_response(F.col("t"))).collect()}
    assert got == BATCH | {None: []}


SECTIONS = [
    ("head\n#### 1. o/a\nbody\n#### 2. o/b\nend", "o/b", "#### 2. o/b\nend"),
    ("# o/a head\n\n#### 1. o/a\nbody", "o/a", "# o/a head"),
    ("o/a plain", "o/a", "#### o/a plain"),
    ("head\n#### 1. o/a\n  \n", "o/a", "#### 1. o/a"),
    ("head", "o/a", ""),
    ("", "o/a", ""),
    (None, "o/a", ""),
    ("x\n#### o/a " + "y" * 2000, "o/a", "#### o/a " + "y" * 2000),
]


def test_sections(spark):
    frame = spark.createDataFrame(SECTIONS, "md string, repo string, want string")
    cut = prompts.extract_repo_section(F.col("md"), F.col("repo"))
    assert [r[0] for r in frame.select(cut).collect()] == [want for *_, want in SECTIONS]


@pytest.mark.parametrize("value", [0.0, 1.125, 2.5, -0.001, -1.239, 1234567.891, 0.335, 9.995])
def test_two_decimals(spark, value):
    row = spark.createDataFrame([(value,)], "v double").select(prompts.two_decimals(F.col("v"))).first()
    assert row[0] in (f"{value:.2f}", {0.335: "0.34", 9.995: "10.00"}.get(value))


def test_missing_metrics_show_a_dash(spark):
    frame = spark.createDataFrame([("1.5",), ("",), (None,), ("NaN",), ("many",)], "v string")
    assert [r[0] for r in frame.select(prompts.fmt(F.col("v"))).collect()] == ["1.50", "—", "—", "—", "many"]


def test_prompt_template():
    system, user = prompts.split_template("# t\n\n## system\nBe brief.\n\n## user_template\n\nHi {{a}}\n")
    assert (system, user) == ("# t\n\n\nBe brief.", "Hi {{a}}")
    assert prompts.split_template("## system\nonly") == ("only", "")


def test_render_replaces_every_key(spark):
    frame = spark.createDataFrame([("x", 3), (None, None)], "a string, n int")
    text = prompts.render("{{a}}/{{n}}/{{a}} {{other}}", {"a": F.col("a"), "n": F.col("n")})
    assert [r[0] for r in frame.select(text).collect()] == ["x/3/x {{other}}", "—/—/— {{other}}"]


def test_rank_table(spark):
    day = dt.date(2024, 1, 15)
    rows = [(day, 2, "o/b", 5, None, None, 1.5, None), (day, 1, "o/a", 9, "PushEvent", 2.0, -0.001, 3.0), (day, 11, "o/z", 1, "x", 0.0, 0.0, 0.0)]
    frame = spark.createDataFrame(
        rows, "event_date date, rank int, repo_name string, event_count bigint, dominant_event_type string, "
        "acceleration_ratio double, anomaly_score double, watch_zscore double")
    table = prompts.rank_table_markdown(frame, 10).first().repo_table.split("\n")
    assert table[:2] == prompts.TABLE_HEAD
    assert table[2:] == ["| 1 | o/a | 9 | PushEvent | 2.00 | -0.00 | 3.00 |", "| 2 | o/b | 5 | None | 0.00 | 1.50 | 0.00 |"]
    assert prompts.rank_table_markdown(frame).first().repo_table.count("\n") == 4
    assert prompts.repo_lines(frame).first().n == 3
    lines = prompts.repo_lines(frame, 10).first()
    assert lines.n == 2 and lines.repo_lines.startswith("- o/a (주요 활동: PushEvent, 활동수: 9)\n- o/b")
