from __future__ import annotations

import datetime as dt
import math
import random
import statistics
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import bronze_frame, event, rows_of
from tidemark.operators import events, marts, quality
from tidemark.sources.tables import with_date_parts

DAY = dt.date(2024, 1, 15)


def silver_of(spark, rows):
    live = bronze_frame(spark, [], live=True)
    return events.silver_events(bronze_frame(spark, rows), live)


def on(day, **kw):
    return event(_d=f"{day:02d}", created=f"2024-01-{day:02d}T10:00:00Z", **kw)


def test_dominant_type_tie_goes_to_the_larger_name_over_renames(spark):
    rows = [
        event("1", "PushEvent", name="org/a"),
        event("2", "PushEvent", name="org/b"),
        event("3", "WatchEvent", name="org/a"),
        event("4", "WatchEvent", name="org/a"),
        event("5", "ForkEvent", name="org/a"),
    ]
    row = marts.repo_daily(silver_of(spark, rows)).first()
    assert (row.dominant_event_type, row.repo_name, row.event_count) == ("WatchEvent", "org/b", 5)
    assert (row.push_count, row.watch_count, row.fork_count, row.pr_count) == (2, 2, 1, 0)


def test_null_repo_actor_and_type(spark):
    rows = [
        event("1", None, repo=None, name=None),
        event("2", None, repo=None, name=None, actor=None),
        event("3", "PushEvent", repo=None, name=None),
        event("4", "PushEvent", actor=None),
    ]
    daily = marts.repo_daily(silver_of(spark, rows))
    found = {r.repo_id: r for r in daily.collect()}
    assert set(found) == {None, 1}
    lost = found[None]
    assert (lost.event_count, lost.unique_actors, lost.dominant_event_type) == (3, 1, None)
    assert (found[1].unique_actors, found[1].event_count) == (0, 1)
    accel = {r.repo_id: r.prev_event_count for r in marts.repo_acceleration(daily, daily).collect()}
    assert accel == {None: 0, 1: 0}


def test_hourly_mart_leaves_out_events_without_a_repository(spark):
    archive = bronze_frame(spark, [event("1"), event("2", repo=None, name=None), event(None)])
    recent = marts.hourly_recent(archive, bronze_frame(spark, [], live=True))
    row = recent.collect()
    assert [(r.repo_id, r.event_count, r.hour, r.hour_ts) for r in row] == [
        (1, 1, 10, dt.datetime(2024, 1, 15, 10))
    ]


def test_acceleration_uses_the_calendar_day_before(spark):
    rows = [on(12, id="0"), on(12, id="00")]
    rows += [on(14, id="1"), on(14, id="2"), on(15, id="3", repo=2, name="org/two")]
    rows += [on(15, id=f"n{i}") for i in range(3)]
    rows += [on(14, id="gone", repo=3, name="org/three")]
    daily = marts.repo_daily(silver_of(spark, rows))
    over_all = marts.repo_acceleration(daily)
    got = {(r.event_date.day, r.repo_id): (r.prev_event_count, r.event_delta, r.acceleration_ratio) for r in over_all.collect()}
    assert got == {
        (12, 1): (0, 2, None),
        (14, 1): (0, 2, None),
        (14, 3): (0, 1, None),
        (15, 1): (2, 1, 1.5),
        (15, 2): (0, 1, None),
    }
    today = daily.where(F.col("event_date") == "2024-01-15")
    before = daily.where(F.col("event_date") == "2024-01-14")
    joined = rows_of(marts.repo_acceleration(today, before))
    assert joined == rows_of(over_all.where(F.col("event_date") == "2024-01-15"))


def test_equal_ratios_score_zero(spark):
    rows = [event(f"{r}-{i}", "WatchEvent", repo=r) for r in (1, 2, 3) for i in range(4)]
    for row in marts.repo_anomaly(marts.repo_daily(silver_of(spark, rows))).collect():
        assert row.activity_zscore == row.watch_zscore == row.fork_zscore == row.anomaly_score == 0
        assert row.watch_ratio == 1.0


def brute_force(rows):
    """The daily mart and its scores from plain Python."""
    by_repo = defaultdict(list)
    for r in rows:
        by_repo[r["repo"]["id"]].append(r)
    daily = {}
    for repo, members in by_repo.items():
        kinds = Counter(m["type"] for m in members)
        daily[repo] = {
            "n": len(members),
            "actors": len({m["actor"]["id"] for m in members}),
            "dominant": max(kinds, key=lambda t: (kinds[t], t)),
            "name": max(m["repo"]["name"] for m in members),
            "watch": kinds["WatchEvent"] / len(members),
            "fork": kinds["ForkEvent"] / len(members),
        }
    for source, target in (("n", "az"), ("watch", "wz"), ("fork", "fz")):
        values = [d[source] for d in daily.values()]
        mean, std = statistics.fmean(values), statistics.pstdev(values)
        for d in daily.values():
            d[target] = (d[source] - mean) / std if std else 0.0
    for d in daily.values():
        d["score"] = math.sqrt(d["az"] ** 2 + d["wz"] ** 2 + d["fz"] ** 2)
    return daily


@pytest.fixture(scope="module")
def skewed():
    """A third of all events belong to one repository, most to one actor."""
    rng = random.Random(7)
    kinds = ["PushEvent", "WatchEvent", "ForkEvent", "IssuesEvent", "PullRequestEvent", "OddEvent"]
    rows = []
    for i in range(3000):
        repo = 0 if i % 3 == 0 else rng.randrange(1, 60)
        actor = 1 if rng.random() < 0.4 else rng.randrange(500)
        rows.append(
            event(str(i), rng.choice(kinds), actor, repo, f"org/r{repo}" + rng.choice(["", "-x"]), _h=f"{i % 24:02d}")
        )
    return rows


def test_marts_equal_brute_force_on_skewed_events(spark, skewed):
    silver = silver_of(spark, skewed)
    want = brute_force(skewed)
    daily = marts.repo_daily(silver)
    got = {r.repo_id: r for r in daily.collect()}
    assert set(got) == set(want)
    for repo, w in want.items():
        g = got[repo]
        assert (g.event_count, g.unique_actors, g.dominant_event_type, g.repo_name) == (
            w["n"], w["actors"], w["dominant"], w["name"],
        )
    for r in marts.repo_anomaly(daily).collect():
        w = want[r.repo_id]
        assert r.activity_zscore == pytest.approx(w["az"], abs=1e-9)
        assert r.watch_zscore == pytest.approx(w["wz"], abs=1e-9)
        assert r.fork_zscore == pytest.approx(w["fz"], abs=1e-9)
        assert r.anomaly_score == pytest.approx(w["score"], abs=1e-9)


def test_marts_agree_with_each_other(spark, skewed):
    silver = silver_of(spark, skewed).cache()
    total = silver.count()

    def events_in(mart):
        return mart.agg(F.sum("event_count")).first()[0]

    assert events_in(marts.repo_daily(silver)) == total
    assert events_in(marts.actor_daily(silver)) == total
    assert events_in(marts.repo_hourly(silver)) == total
    assert events_in(marts.language_activity(silver)) == total
    anomaly = marts.repo_anomaly(marts.repo_daily(silver))
    assert anomaly.agg(F.avg("activity_zscore")).first()[0] == pytest.approx(0, abs=1e-9)
    silver.unpersist()


def test_marts_combine_map_side_and_never_gather_one_task(spark, skewed):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    silver = silver_of(spark, skewed)
    daily = marts.repo_daily(silver)
    for mart in (daily, marts.language_activity(silver), marts.repo_anomaly(daily), marts.repo_hourly(silver)):
        plan = mart._jdf.queryExecution().explainString(mode)
        assert "partial_" in plan
        assert "SinglePartition" not in plan
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_verify_gold_counts_missing_marts_as_zero(spark):
    silver = silver_of(spark, [event("1")])
    daily = marts.repo_daily(silver)
    full = {
        "repo_daily": daily,
        "actor_daily": marts.actor_daily(silver),
        "repo_acceleration": marts.repo_acceleration(daily),
        "repo_anomaly": marts.repo_anomaly(daily),
        "repo_hourly": marts.repo_hourly(silver),
        "language_activity": marts.language_activity(silver),
    }
    assert set(quality.require_gold(quality.verify_gold(full), "2024-01-15").values()) == {1}
    full["repo_hourly"] = full["repo_hourly"].limit(0)
    with pytest.raises(quality.EmptyLayerError):
        quality.require_gold(quality.verify_gold(full), "2024-01-15")
    with pytest.raises(quality.EmptyLayerError):
        quality.require_gold(quality.verify_gold(full), "2024-01-16")


def test_date_parts_are_padded(spark):
    frame = spark.createDataFrame([(dt.date(2024, 4, 5),)], "event_date date")
    assert rows_of(with_date_parts(frame), "year", "month", "day") == [("2024", "04", "05")]
