from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import bronze_frame, event, rows_of
from tidemark.functions import scalars
from tidemark.operators import events, heatmap, profile, progress, serving, velocity


def mart(spark, rows, kind):
    return spark.createDataFrame(rows, kind)


@pytest.fixture(scope="module")
def three(spark):
    day = dt.date(2024, 1, 15)
    daily = mart(spark, [(day, i, f"o/{i}", n, "PushEvent") for i, n in [(1, 100), (2, 50), (3, 49), (4, 80), (5, 100)]],
                 "event_date date, repo_id bigint, repo_name string, event_count bigint, dominant_event_type string")
    accel = mart(spark, [(day, 1, 25.0, 10), (day, 2, None, 0), (day, 3, 2.0, 30), (day, 4, 2.0, 40), (day, 5, 25.0, 10)],
                 "event_date date, repo_id bigint, acceleration_ratio double, prev_event_count bigint")
    anomaly = mart(spark, [(day, 1, 2.0, 0.5, 1.0), (day, 2, 3.0, 0.5, 1.0), (day, 3, 1.0, 0.1, 1.0), (day, 4, 1.0, 0.1, 0.0), (day, 5, 2.0, 0.5, 1.0)],
                   "event_date date, repo_id bigint, anomaly_score double, watch_ratio double, watch_zscore double")
    return daily, accel, anomaly


def test_rank_top_filters_caps_and_breaks_ties_by_id(three):
    ranked = serving.rank_top(*three).collect()
    assert [(r.repo_id, r.rank) for r in ranked] == [(1, 1), (5, 2)]
    want = 0.4 * 10 + 0.4 * 2 + 0.2 * math.log(101)
    assert ranked[0].rank_score == pytest.approx(want)


def test_rank_top_of_one_day_equals_that_day_of_all(three):
    one = serving.rank_top(*three, day="2024-01-15", n=1)
    assert rows_of(one) == rows_of(serving.rank_top(*three, n=1))
    assert serving.rank_top(*three, day="2024-01-16").isEmpty()
    plan = one._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan or "GlobalLimit" in plan


def test_top_acceleration_puts_missing_ratios_last(spark):
    day = dt.date(2024, 1, 15)
    rows = mart(spark, [(day, 1, "a", 9, 5, None, "x"), (day, 2, "b", 9, 9, 1.0, "x"), (day, 3, "c", 9, 4, 9.0, "x")],
                "event_date date, repo_id bigint, repo_name string, event_count bigint, prev_event_count bigint, acceleration_ratio double, dominant_event_type string")
    assert rows_of(serving.top_acceleration(rows, "2024-01-15"), "rank", "repo_id") == [(1, 2), (2, 1)]


def heat(spark, rows):
    silver = events.silver_events(bronze_frame(spark, rows), bronze_frame(spark, [], live=True))
    return heatmap.activity_heatmap_long(silver)


def test_heatmap_orders_names_and_fills(spark):
    rows = [event(str(i), "WatchEvent", _h="03") for i in range(3)]
    rows += [event("p", "PushEvent", _h="23"), event("n", None, _h="00"), event("e", "", _h="00"), event("x", "MyEvent", _h="05")]
    long = heat(spark, rows)
    cells = heatmap.activity_heatmap_cells(long)
    assert cells.count() == 24 * 4
    order = rows_of(cells.select("type_order", "type", "label", "total").distinct())
    assert order == [(1, "WatchEvent", "Star", 3), (2, "Unknown", "Unknown", 2), (3, "MyEvent", "MyEvent", 1), (4, "PushEvent", "Push", 1)]
    row = {r.type: r for r in heatmap.activity_heatmap_matrix(long).collect()}
    assert (row["WatchEvent"].h03, row["WatchEvent"].h04, row["Unknown"].h00) == (3, 0, 2)
    assert heatmap.heatmap_coverage(long).first().total_events == 7


def test_hour_outside_the_day_counts_in_total_only(spark):
    long = mart(spark, [(dt.date(2024, 1, 15), 24, "PushEvent", 2), (dt.date(2024, 1, 15), 1, "PushEvent", 1)],
                "event_date date, hour int, type_raw string, event_count bigint")
    row = heatmap.activity_heatmap_matrix(long).first()
    assert row.total == 3 and sum(row[f"h{h:02d}"] for h in range(24)) == 1
    assert heatmap.activity_heatmap_cells(long).agg(F.sum("event_count")).first()[0] == 1


def test_hourly_progress(spark):
    day = dt.date(2024, 1, 15)
    cols = "event_date date, hour int, repo_id bigint, repo_name string, event_count bigint, unique_actors bigint, push_count bigint, pr_count bigint, issue_count bigint, watch_count bigint, fork_count bigint, dominant_event_type string"
    recent = mart(spark, [
        (day, 20, 1, "a", 5, 2, 5, 0, 0, 0, 0, "PushEvent"),
        (day, 20, 2, "a", 5, 2, 0, 0, 0, 5, 0, "WatchEvent"),
        (day, 21, 3, "b", 1, 1, 0, 0, 0, 0, 1, None),
    ], cols)
    hours = progress.hourly_today_hours(recent).collect()
    assert [(h.hour, h.hour_kst, h.events, h.unique_repos, h.unique_actors) for h in hours] == [(20, 5, 10, 2, 4), (21, 6, 1, 1, 1)]
    assert rows_of(progress.hourly_today_totals(recent), "events", "unique_actors") == [(11, 5)]
    top = rows_of(progress.hourly_today_top(recent, "2024-01-15"), "rank", "repo_name", "events", "primary_type")
    assert top == [(1, "a", 10, "WatchEvent"), (2, "b", 1, "Unknown")]


def test_timeline_of_one_repository(spark):
    day = dt.date(2024, 1, 15)
    hourly = mart(spark, [(day, 3, 1, "o/a", 4, "PushEvent"), (day, 9, 2, "o/b", 1, "ForkEvent")],
                  "event_date date, hour int, repo_id bigint, repo_name string, event_count bigint, dominant_event_type string")
    line = profile.repo_profile_timeline(hourly, "o/a", "2024-01-15").orderBy("hour").collect()
    assert [r.event_count for r in line] == [4 if h == 3 else 0 for h in range(24)]
    assert line[3].dominant_event_type == "PushEvent" and line[4].dominant_event_type is None
    assert profile.repo_profile_timeline(hourly, "x' OR '1'='1").isEmpty()
    assert rows_of(serving.repo_hour_series(hourly, "o/b", "2024-01-15"), "hour", "event_count") == [(9, 1)]


def test_profile_7d_window(spark):
    rows = [(dt.date(2024, 1, d), 1, "o/a", d) for d in (1, 2, 8, 9)]
    daily = mart(spark, rows, "event_date date, repo_id bigint, repo_name string, event_count bigint")
    found = {r.event_date.day: (r.events_7d, r.active_days_7d, r.peak_7d) for r in profile.profile_7d(daily).collect()}
    assert found == {1: (1, 1, 1), 2: (3, 2, 2), 8: (10, 2, 8), 9: (17, 2, 9)}


def test_type_share_of_an_empty_total(spark):
    daily = mart(spark, [(dt.date(2024, 1, 15), 1, "o/a", 0, 0, 0, 0, 0, 0), (dt.date(2024, 1, 15), 2, "o/b", 3, 1, 0, 0, 2, 0)],
                 "event_date date, repo_id bigint, repo_name string, event_count bigint, push_count bigint, pr_count bigint, issue_count bigint, watch_count bigint, fork_count bigint")
    share = {(r.repo_id, r.count_column): r.share_pct for r in serving.type_share(daily).collect()}
    assert share[(1, "push_count")] == 0.0
    assert (share[(2, "push_count")], share[(2, "watch_count")]) == (33.3, 66.7)


def test_velocity_equals_a_zero_filled_computation(spark):
    start = dt.datetime(2024, 1, 1)
    stars = {0: 2, 1: 5, 12: 1, 13: 40, 200: 3, 300: 7, 301: 7, 700: 1}
    rows = [(1, "o/a", start + dt.timedelta(minutes=5 * s), n) for s, n in stars.items()]
    metrics = mart(spark, rows, "repo_id bigint, repo_name string, ts_5min timestamp_ntz, star_count bigint")
    for r in velocity.repo_velocity(metrics).collect():
        slot = int((r.ts_5min - start).total_seconds() // 300)
        past = [stars.get(s, 0) for s in range(slot - 288, slot)]
        mean = sum(past) / 288
        std = math.sqrt(sum((p - mean) ** 2 for p in past) / 288)
        assert r.star_avg_24h == pytest.approx(mean) and r.star_std_24h == pytest.approx(std)
        z = (r.star_count - mean) / std if std else None
        assert r.z_score == (pytest.approx(z) if z is not None else None)
        assert r.anomaly_flag == (z is not None and z > 3)
        assert r.delta_stars_per_hour == (r.star_count - stars.get(slot - 12, 0)) * 12


def test_anomaly_kind(spark):
    daily = mart(spark, [(dt.date(2024, 1, 15), 1, "a", 100, 3), (dt.date(2024, 1, 15), 2, "b", 100, 90)],
                 "event_date date, repo_id bigint, repo_name string, event_count bigint, unique_actors bigint")
    assert rows_of(velocity.anomaly_kind(daily), "repo_id", "anomaly_kind") == [(1, "bot"), (2, "viral")]


def test_names_and_dates(spark):
    names = {"o/trading-bot": (True, True), "x/casino1": (True, True), "a/123": (True, True), "a/robot": (False, True),
             "a b/c": (False, False), "a/b/c": (False, False), "a/b": (False, True), "'; drop": (False, False)}
    frame = mart(spark, [(n,) for n in names] + [(None,)], "n string")
    got = {r[0]: (r[1], r[2]) for r in frame.select("n", scalars.is_bot_name(F.col("n")), scalars.is_repo_name(F.col("n"))).collect()}
    assert got == names | {None: (False, False)}
    dates = mart(spark, [(d,) for d in ("2024-02-29", "2023-02-29", "2026-99-99", "2024-1-1", "", None)], "d string")
    assert [r[0] for r in dates.select(scalars.is_date_text(F.col("d"))).collect()] == [True] + [False] * 5


def test_safe_numbers(spark):
    frame = mart(spark, [(t,) for t in ("50.0", "7", "", None, "x", "NaN", "-3.9", "1e3")], "t string")
    found = [tuple(r) for r in frame.select(scalars.safe_int(F.col("t")), scalars.safe_double(F.col("t"))).collect()]
    assert found == [(50, 50.0), (7, 7.0), (None, None), (None, None), (None, None), (None, None), (-3, -3.9), (1000, 1000.0)]


def test_available_dates_and_limit(spark):
    daily = mart(spark, [("2024", "01", f"{d:02d}") for d in range(1, 32) for _ in range(2)], "year string, month string, day string")
    dates = [r[0] for r in serving.available_dates(daily).collect()]
    assert len(dates) == 30 and dates[0] == "2024-01-31" and dates[-1] == "2024-01-02"
