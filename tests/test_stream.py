from __future__ import annotations

import datetime as dt
import json
import time

from pyspark.sql import functions as F

from tests.conftest import bronze_frame, event, rows_of, write_lines
from tidemark.operators import pulse
from tidemark.sources import bronze
from tidemark.streaming import sinks, source

NOW = dt.datetime(2024, 1, 15, 11, 0, 30)
ONCE = {"availableNow": True}


def arrived(minute, second=0, **kw):
    stamp = f"2024-01-15T10:{minute:02d}:{second:02d}Z" if minute < 60 else f"2024-01-15T11:{minute - 60:02d}:{second:02d}Z"
    return event(_ingested_at=stamp, **kw)


ROWS = [
    arrived(0, id="old", name="o/old"),
    arrived(1, id="1", actor=1),
    arrived(56, id="2", type=None, actor=2),
    arrived(57, 10, id="3", type="WatchEvent", name="o/b", repo=2, actor=1),
    arrived(57, 50, id="4", type="WatchEvent", name="o/b", repo=2, actor=1),
    arrived(58, id="5", type="ForkEvent", name="", actor=None),
    arrived(60, 5, id="6", type="ForkEvent", name="o/b", repo=2, actor=3),
]


def grain_of(spark, rows):
    frame = bronze_frame(spark, rows, live=True).withColumnRenamed("ingested_at", "_ingested_at")
    return pulse.pulse_grain(pulse.pulse_events(frame))


def test_pulse_window(spark):
    grain = grain_of(spark, ROWS)
    minutes = pulse.pulse_minutes(grain, NOW).collect()
    assert len(minutes) == 60 and minutes[0].minute == dt.datetime(2024, 1, 15, 10, 1)
    busy = {r.minute.strftime("%H:%M"): (r.events, r.unique_repos) for r in minutes if r.events}
    assert busy == {"10:01": (1, 1), "10:56": (1, 1), "10:57": (2, 1), "10:58": (1, 0), "11:00": (1, 1)}
    assert rows_of(pulse.pulse_totals(grain, NOW)) == [(6, 2, 3)]
    assert rows_of(pulse.pulse_types(grain, NOW)) == [("ForkEvent", 2), ("PushEvent", 1), ("Unknown", 1), ("WatchEvent", 2)]
    assert rows_of(pulse.pulse_top(grain, NOW)) == [("o/b", 3, "WatchEvent"), ("org/one", 1, "Unknown")]
    assert rows_of(pulse.pulse_top(grain, NOW, n=1), "repo_name") == [("o/b",)]
    assert rows_of(pulse.current_minute(grain, NOW), "events", "unique_repos") == [(1, 1)]
    quiet = NOW + dt.timedelta(minutes=5)
    assert rows_of(pulse.current_minute(grain, quiet), "events", "unique_repos") == [(0, 0)]
    assert pulse.pulse_minutes(grain, quiet).count() == 60
    assert rows_of(pulse.pulse_totals(grain, NOW + dt.timedelta(days=1))) == [(0, 0, 0)]
    assert [tuple(r) for r in pulse.pulse_minutes(grain).collect()] == [tuple(r) for r in minutes]


def test_freshness(spark):
    frame = bronze_frame(spark, ROWS, live=True).withColumnRenamed("ingested_at", "_ingested_at")
    row = pulse.freshness(frame, NOW.replace(tzinfo=dt.timezone.utc)).first()
    assert (row.messages, row.last_event_at, row.lag_seconds) == (7, dt.datetime(2024, 1, 15, 11, 0, 5), 25.0)


def run_pulse(spark, base):
    stream = source.file_source(spark, f"{base}/in", files_per_batch=1)
    query = sinks.pulse_sink(stream, f"{base}/grain", f"{base}/check", ONCE)
    query.awaitTermination()
    return query


def test_stream_equals_batch_and_restarts_add_nothing(spark, tmp_path):
    write_lines(tmp_path / "in/a.json", ROWS[:4])
    write_lines(tmp_path / "in/b.json", ROWS[4:6])
    run_pulse(spark, tmp_path)
    run_pulse(spark, tmp_path)
    # a late event and one that closes the hour arrive after a restart
    write_lines(tmp_path / "in/c.json", [ROWS[6], arrived(2, id="late", name="o/late")])
    intake = sinks.Intake()
    spark.streams.addListener(intake)
    query = run_pulse(spark, tmp_path)
    wait = time.time() + 20
    while intake.messages.get(str(query.id), 0) < 2 and time.time() < wait:
        time.sleep(0.1)  # listeners hear of a batch a moment later
    spark.streams.removeListener(intake)
    grain = sinks.read_grain(spark, f"{tmp_path}/grain")
    want = pulse.minute_activity(grain_of(spark, [*ROWS, arrived(2, id="late", name="o/late")]))
    assert rows_of(pulse.minute_activity(grain)) == rows_of(want)
    health = sinks.stream_health(query, intake)
    assert health["active"] is False and health["messages"] == 2 and health["lag_seconds"] >= 0


def test_a_new_checkpoint_adds_to_what_is_stored(spark, tmp_path):
    grain = f"{tmp_path}/grain"
    for part, rows in (("one", ROWS[:4]), ("two", ROWS[4:])):
        write_lines(tmp_path / part / "a.json", rows)
        stream = source.file_source(spark, f"{tmp_path}/{part}")
        sinks.pulse_sink(stream, grain, f"{tmp_path}/check-{part}", ONCE).awaitTermination()
    stored = pulse.minute_activity(sinks.read_grain(spark, grain))
    assert rows_of(stored) == rows_of(pulse.minute_activity(grain_of(spark, ROWS)))


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    frame = bronze_frame(spark, ROWS, live=True).withColumnRenamed("ingested_at", "_ingested_at")
    for _ in range(2):
        sinks.write_grain_batch(frame, 3, f"{tmp_path}/grain")
    sinks.write_grain_batch(frame.limit(1), 4, f"{tmp_path}/grain")
    total = sinks.read_grain(spark, f"{tmp_path}/grain").agg(F.sum("n")).first()[0]
    assert total == len(ROWS) + 1


def test_only_recent_folders_are_read(spark, tmp_path):
    frame = bronze_frame(spark, ROWS, live=True).withColumnRenamed("ingested_at", "_ingested_at")
    sinks.write_grain_batch(frame, 0, f"{tmp_path}/grain")
    periods = sinks.recent_periods(NOW, 60)
    assert periods == ["2024-01-15-10", "2024-01-15-11"]
    assert sinks.recent_periods(dt.datetime(2024, 1, 15, 0, 30), 60, "day") == ["2024-01-14", "2024-01-15"]
    recent = sinks.read_grain(spark, f"{tmp_path}/grain", periods)
    assert rows_of(pulse.pulse_totals(recent, NOW)) == [(6, 2, 3)]
    none = sinks.read_grain(spark, f"{tmp_path}/grain", ["2023-01-01-00"])
    assert rows_of(pulse.pulse_totals(none, NOW)) == [(0, 0, 0)]


def test_bronze_sink_lands_each_event_once(spark, tmp_path):
    rows = [event(str(i), created=f"2024-01-15T{i % 3:02d}:00:00Z", _ingested_at="2024-01-15T05:00:00Z", payload={"n": i}) for i in range(9)]
    write_lines(tmp_path / "in/a.json", [*rows, event("none", created="?", _ingested_at="2024-01-15T07:00:00Z")])
    for _ in range(2):
        stream = source.file_source(spark, f"{tmp_path}/in")
        sinks.bronze_sink(stream, f"{tmp_path}/out", f"{tmp_path}/check", ONCE, files_per_hour=1).awaitTermination()
    landed = bronze.read_bronze_live(spark, f"{tmp_path}/out")
    assert rows_of(landed.groupBy("hour").count()) == [("00", 3), ("01", 3), ("02", 3), ("07", 1)]
    payload = landed.where("id = '4'").first().payload
    assert json.loads(payload) == {"n": 4}


def test_records_are_stamped_and_keyed(spark):
    frame = bronze_frame(spark, [event("1", repo=42)])
    row = source.stamp_and_key(frame.select("id", "type", "repo")).first()
    value = json.loads(row.value)
    assert row.key == "42" and value["id"] == "1"
    stamp = dt.datetime.fromisoformat(value["_ingested_at"])
    assert abs((dt.datetime.now(dt.timezone.utc) - stamp).total_seconds()) < 300


def test_topic_values_decode(spark):
    values = [json.dumps(event("1", _ingested_at="x", payload={"a": 1})), "not json", "[1]", "3", "null", None]
    records = spark.createDataFrame([(v.encode() if v else None,) for v in values], "value binary")
    decoded = source.decode(records)
    assert [(r.id, r.payload, r._ingested_at) for r in source.readable(decoded).collect()] == [("1", '{"a":1}', "x")]
    assert rows_of(source.rejects(decoded)) == [("3",), ("[1]",), ("not json",), ("null",)]


def test_cut_lines_are_kept_by_the_reject_sink(spark, tmp_path):
    whole = json.dumps(event("1", _ingested_at="2024-01-15T05:00:00Z"))
    write_lines(tmp_path / "in/a.json", [whole, whole[:40]])
    stream = source.file_source(spark, f"{tmp_path}/in")
    sinks.bronze_sink(stream, f"{tmp_path}/out", f"{tmp_path}/check", ONCE).awaitTermination()
    sinks.reject_sink(stream, f"{tmp_path}/bad", f"{tmp_path}/check-bad", ONCE).awaitTermination()
    assert bronze.read_bronze_live(spark, f"{tmp_path}/out").count() == 1
    assert rows_of(spark.read.text(f"{tmp_path}/bad")) == [(whole[:40],)]


def test_an_unreadable_arrival_still_counts(spark):
    rows = [event("1", _ingested_at="?", created="2024-01-15T10:05:00Z"), event("2", _ingested_at=None, created="?")]
    assert rows_of(grain_of(spark, rows), "minute", "n") == [(dt.datetime(1970, 1, 1), 1), (dt.datetime(2024, 1, 15, 10, 5), 1)]


def test_the_window_filter_reaches_the_scan(spark, tmp_path):
    sinks.write_grain_batch(bronze_frame(spark, ROWS, live=True).withColumnRenamed("ingested_at", "_ingested_at"), 0, f"{tmp_path}/g")
    plan = pulse.pulse_totals(sinks.read_grain(spark, f"{tmp_path}/g", sinks.recent_periods(NOW, 60)), NOW)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(minute" in plan and "Join" not in plan
