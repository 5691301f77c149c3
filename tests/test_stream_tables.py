"""Tables that streams leave: deduplicated deliveries, folded periods, sketches, progress."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import bronze_frame, event, rows_of
from tidemark.operators import events, pulse, sketches
from tidemark.schemas import HOUR_PARTS, PULSE_GRAIN
from tidemark.streaming import compaction, dedup, health, sinks

ONCE = {"availableNow": True}


def flat(spark, rows, live, day="2024-01-15"):
    frame = bronze_frame(spark, rows, live=live, day=day)
    return events.flatten_event(frame, "live" if live else "archive")


def run_dedup(spark, tmp_path, parts, delay):
    """The parts one stream run after the other, over one checkpoint."""
    schema = events.union_sources(bronze_frame(spark, []), bronze_frame(spark, [], live=True)).schema
    for part in parts:
        part.select(*schema.fieldNames()).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        dedup.dedup_sink(stream, str(tmp_path / "out"), str(tmp_path / "check"), ONCE, delay).awaitTermination()
    return str(tmp_path / "out")


def test_stream_dedup_prefers_live_and_keeps_everything(spark, tmp_path):
    archive = [event(id=str(i), type="PushEvent") for i in range(6)] + [event(id="0", type="ForkEvent"), event(id=None)]
    live = [
        event(id="1", _ingested_at="2024-01-15T10:02:00Z"),
        event(id="1", _ingested_at="2024-01-15T10:01:00Z"),
        event(id="9", _ingested_at="2024-01-15T10:01:00Z"),
    ]
    later = [event(id="1", _ingested_at="2024-01-15T10:00:30Z"), event(id="2", _ingested_at="bad")]
    parts = [flat(spark, archive, False), flat(spark, live, True), flat(spark, later, True)]
    out = run_dedup(spark, tmp_path, parts, "2 days")
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    wanted = rows_of(events.dedup_live_first(whole), "id", "source", "type", "ingested_at")
    assert rows_of(dedup.read_deduplicated(spark, out), "id", "source", "type", "ingested_at") == wanted
    stored = sum(
        rows.count() for v in dedup.VERDICTS if (rows := dedup.read_verdict(spark, out, v)) is not None
    )
    assert stored == whole.where("id IS NOT NULL").count()
    assert dedup.read_verdict(spark, out, "late") is None


def test_rows_behind_the_watermark_go_aside(spark, tmp_path):
    """A first delivery that comes too late is late, one whose id is known is judged."""
    first = [event(id="a", created="2024-01-15T10:00:00Z"), event(id="z", created="2024-01-25T10:00:00Z")]
    push = [event(id="y", created="2024-01-25T11:00:00Z")]
    late = [event(id="b", created="2024-01-15T10:30:00Z"), event(id="a", created="2024-01-15T10:00:00Z")]
    parts = [flat(spark, rows, False) for rows in (first, push, late)]
    out = run_dedup(spark, tmp_path, parts, "1 day")
    assert rows_of(dedup.read_verdict(spark, out, "late"), "id") == [("b",)]
    assert rows_of(dedup.read_verdict(spark, out, "duplicate"), "id") == [("a",)]
    assert rows_of(dedup.read_deduplicated(spark, out), "id") == [("a",), ("b",), ("y",), ("z",)]


def delivered(spark, n, seed, day="2024-01-15", hours=24):
    rng = random.Random(seed)
    rows = [
        event(
            id=str(i), type=rng.choice(["PushEvent", "WatchEvent", None]), actor=rng.randrange(9),
            name=rng.choice(["o/a", "o/b", ""]),
            _ingested_at=f"{day}T{rng.randrange(hours):02d}:{rng.randrange(60):02d}:00Z",
        )
        for i in range(n)
    ]
    return bronze_frame(spark, rows, live=True).withColumnRenamed("ingested_at", "_ingested_at")


def grain_rows(frame):
    return rows_of(frame.groupBy(*pulse.GRAIN).agg(F.sum("n").alias("n")))


def test_folding_changes_no_rows(spark, tmp_path):
    path = str(tmp_path / "grain")
    batches = {n: delivered(spark, 120, n, hours=4) for n in range(3)}
    for n in (0, 1):
        sinks.write_grain_batch(batches[n], n, path)
    before = grain_rows(sinks.read_grain(spark, path))
    periods = compaction.stored_periods(spark, path)
    assert grain_rows(compaction.read_folded_grain(spark, path)) == before
    for period in periods:
        assert compaction.fold_period(spark, path, period) == len(compaction.batches_of(spark, path, period))
    assert grain_rows(compaction.read_folded_grain(spark, path)) == before
    sinks.write_grain_batch(batches[1], 1, path)  # a replay
    assert grain_rows(compaction.read_folded_grain(spark, path)) == before
    sinks.write_grain_batch(batches[2], 2, path)  # came late
    after = grain_rows(sinks.read_grain(spark, path))
    assert grain_rows(compaction.read_folded_grain(spark, path)) == after != before
    for period in periods[:2]:
        compaction.fold_period(spark, path, period, clean=True)
        assert compaction.batches_of(spark, path, period) == []
        assert len(compaction.files_of(spark, path, period)) == 1
    assert grain_rows(compaction.read_folded_grain(spark, path)) == after
    assert compaction.fold_period(spark, path, periods[0]) == 3
    assert compaction.newest_minute(spark, path) == max(r[0] for r in after)


def test_a_fold_without_its_marker_does_not_count(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "grain")
    sinks.write_grain_batch(delivered(spark, 50, 1), 0, path, "day")
    before = grain_rows(sinks.read_grain(spark, path))

    def fails(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(compaction, "_write_marker", fails)
        with pytest.raises(RuntimeError):
            compaction.fold_period(spark, path, "2024-01-15")
    assert grain_rows(compaction.read_folded_grain(spark, path)) == before
    assert compaction.fold_period(spark, path, "2024-01-15", clean=True) == 1
    assert grain_rows(compaction.read_folded_grain(spark, path)) == before


def test_recent_rows_come_from_few_folders(spark, tmp_path):
    path = str(tmp_path / "grain")
    for n, day in enumerate(("2024-01-14", "2024-01-15")):
        sinks.write_grain_batch(delivered(spark, 200, n, day), n, path)
    grain, now = compaction.recent_grain(spark, path, 60)
    assert len({f.split("period=")[1][:13] for f in grain.inputFiles()}) <= 2
    whole = sinks.read_grain(spark, path)
    assert rows_of(pulse.pulse_minutes(grain, now)) == rows_of(pulse.pulse_minutes(whole))
    assert compaction.recent_grain(spark, str(tmp_path / "none"), 60)[1] is None


def test_sketches_unite_to_the_sketch_of_the_union(spark):
    at = dt.datetime(2024, 1, 15)
    rows = [(at + dt.timedelta(minutes=i % 90), "PushEvent", f"o/{i % 5000}", i % 3, 1) for i in range(9000)]
    rows += [(at, "WatchEvent", None, None, 4)]
    grain = spark.createDataFrame(rows, PULSE_GRAIN)
    found = sketches.pulse_totals_sketched(sketches.pulse_sketches(grain), minutes=90).first()
    assert found.events == 9004 and found.unique_actors == 3
    assert abs(found.unique_repos - 5000) <= sketches.BOUND * 5000
    none = sketches.pulse_totals_sketched(sketches.pulse_sketches(grain.where("n < 0"))).first()
    assert tuple(none) == (0, 0, 0)


def test_progress_survives_a_new_driver(spark, tmp_path):
    """Two runs of one checkpoint and one of another; a replayed batch counts once."""
    live = delivered(spark, 90, 5).drop(*HOUR_PARTS)
    schema, path = live.schema, str(tmp_path / "progress")
    for n, checkpoint in enumerate(("one", "one", "two")):
        live.where(F.pmod(F.col("id").cast("int"), F.lit(3)) == n).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        sinks.pulse_sink(
            stream, str(tmp_path / "grain"), str(tmp_path / checkpoint), ONCE, "day", path
        ).awaitTermination()
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = sorted(health.stored_health(spark, path, now).collect(), key=lambda r: r.messages)
    assert [(r.messages, r.batches) for r in rows] == [(60, 2), (90, 1)]
    assert all(0 <= r.lag_seconds < 600 for r in rows)
    assert health.stored_health(spark, str(tmp_path / "none")).collect() == []


def test_dedup_batch_is_judged_by_spark_without_python_per_id(spark, tmp_path):
    """Verdicts of a micro-batch come from joins and windows, with the state the batch before left."""
    state = str(tmp_path / "state")
    first = flat(spark, [event(id="a", type="PushEvent"), event(id="a", type="ForkEvent")], False)
    out, after = dedup.judge_batch(first, 0, state, "2 days")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert sorted(r.verdict for r in out.collect()) == ["duplicate", "kept"]
    after.write.parquet(f"{state}/best/batch_id=0")
    live = flat(spark, [event(id="a", _ingested_at="2024-01-15T10:02:00Z"), event(id="c")], True)
    out, _ = dedup.judge_batch(live, 1, state, "2 days")
    assert rows_of(out, "id", "verdict") == [("a", "kept"), ("c", "kept")]
    out, _ = dedup.judge_batch(first, 1, state, "2 days")
    assert rows_of(out, "id", "verdict") == [("a", "duplicate"), ("a", "duplicate")]
