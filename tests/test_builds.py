from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import event, rows_of, write_lines
from tidemark.operators import quality
from tidemark.operators.events import silver_events
from tidemark.plans import daily
from tidemark.plans.daily import build_gold, build_silver
from tidemark.plans.hourly import build_hour, target_hour
from tidemark.sources import bronze, catalog, tables
from tidemark.sources.paths import child_names, day_path, delete_path, path_exists

D14, D15 = "2024-01-14", "2024-01-15"


def land(root, source, day, hour, rows):
    year, month, dom = day.split("-")
    write_lines(
        f"{root}/bronze/{source}/year={year}/month={month}/day={dom}/hour={hour:02d}/part-0.json", rows
    )


@pytest.fixture
def lake(tmp_path):
    root = str(tmp_path)
    for day, count in ((D14, 2), (D15, 5)):
        stamp = f"{day}T10:00:00Z"
        land(root, "archive", day, 10, [event(f"{day}-{i}", created=stamp) for i in range(count)])
    land(root, "archive", D15, 11, [event("late", "WatchEvent", created=f"{D15}T11:00:00Z"), "{broken", event(None)])
    land(root, "live", D15, 10, [event(f"{D15}-0", created=f"{D15}T10:00:00Z", _ingested_at=f"{D15}T10:00:30Z"),
                                 event("live", "ForkEvent", 9, 2, "org/two", {"forkee": {"language": "py"}}, f"{D15}T10:30:00Z")])
    return root


def everything(spark, root):
    return {name: rows_of(tables.read_gold(spark, root, name)) for name in quality.MART_COLUMNS}


def test_silver_then_gold(spark, lake):
    report = build_silver(spark, lake, D15)
    assert report == {"cnt": 7, "hrs": 2, "live_rows": 2, "archive_rows": 5, "lang_known": 1}
    build_silver(spark, lake, D14)
    assert build_gold(spark, lake, D14)["repos"] == 1
    counts = build_gold(spark, lake, D15)
    assert counts == {"repos": 2, "actors": 2, "accel": 2, "anomaly": 2, "hourly": 3, "lang": 3}
    accel = tables.read_gold(spark, lake, "repo_acceleration", D15)
    assert rows_of(accel, "repo_id", "event_count", "prev_event_count", "acceleration_ratio") == [
        (1, 6, 2, 3.0), (2, 1, 0, None),
    ]
    set_aside = spark.read.parquet(f"{lake}/quarantine")
    assert rows_of(set_aside, "source", "reject_reason", "_corrupt_record", "hour") == [
        ("archive", "malformed line", "{broken", "11"), ("archive", "no id", None, "11"),
    ]


def test_previous_day_falls_back_to_silver(spark, lake):
    build_silver(spark, lake, D14)
    build_silver(spark, lake, D15)
    build_gold(spark, lake, D15)
    accel = tables.read_gold(spark, lake, "repo_acceleration", D15).where("repo_id = 1")
    assert accel.first().prev_event_count == 2


def test_running_a_day_again_changes_nothing(spark, lake):
    build_silver(spark, lake, D15)
    build_gold(spark, lake, D15)
    first = everything(spark, lake)
    land(lake, "archive", D15, 11, [event("late", "WatchEvent", created=f"{D15}T11:00:00Z")])
    build_silver(spark, lake, D15)
    build_gold(spark, lake, D15)
    assert everything(spark, lake) == first
    assert child_names(spark, f"{lake}/quarantine/year=2024/month=01") == []


def test_a_rerun_with_fewer_hours_leaves_no_stale_hour(spark, lake):
    build_silver(spark, lake, D14)
    build_silver(spark, lake, D15)
    other = rows_of(tables.read_silver(spark, lake, D14))
    archive = bronze.read_bronze_archive(spark, f"{lake}/bronze/archive", D15, 10)
    live = bronze.read_bronze_live(spark, f"{lake}/bronze/live", D15, 10)
    fewer = silver_events(archive, live)
    tables.overwrite_day(fewer, f"{lake}/silver/events", D15, ["hour"])
    assert rows_of(tables.read_silver(spark, lake, D15).select("hour").distinct()) == [("10",)]
    assert rows_of(tables.read_silver(spark, lake, D14)) == other


def test_empty_bronze_replaces_nothing(spark, lake):
    build_silver(spark, lake, D15)
    before = rows_of(tables.read_silver(spark, lake, D15))
    with pytest.raises(quality.EmptyLayerError):
        build_silver(spark, lake, "2024-01-16")
    with pytest.raises(quality.EmptyLayerError):
        build_gold(spark, lake, "2024-01-16")
    assert rows_of(tables.read_silver(spark, lake, D15)) == before
    assert not path_exists(spark, f"{lake}/gold")


def test_hourly_build_waits_for_the_archive(spark, lake):
    assert build_hour(spark, lake, D15, 10) == 2
    row = {r.repo_id: r for r in tables.read_gold(spark, lake, "hourly_recent", D15).collect()}
    assert row[1].event_count == 5 and row[1].hour_ts == dt.datetime(2024, 1, 15, 10)
    assert row[1].hour_p == "10"
    land(lake, "live", D15, 12, [event("only-live")])
    with pytest.raises(quality.EmptyLayerError, match="archive"):
        build_hour(spark, lake, D15, 12)
    with pytest.raises(quality.EmptyLayerError, match="both"):
        build_hour(spark, lake, D15, 13)
    build_hour(spark, lake, D15, 11)
    assert build_hour(spark, lake, D15, 10) == 2
    assert tables.read_gold(spark, lake, "hourly_recent", D15).count() == 3


def test_target_hour_looks_two_hours_back():
    utc = dt.timezone.utc
    assert target_hour(dt.datetime(2024, 1, 15, 1, 5, tzinfo=utc)) == ("2024-01-14", 23)
    assert target_hour(dt.datetime(2024, 1, 15, 12, tzinfo=dt.timezone(dt.timedelta(hours=9)))) == (D15, 1)


def test_day_filter_prunes_partitions(spark, lake):
    build_silver(spark, lake, D14)
    build_silver(spark, lake, D15)
    day = tables.read_silver(spark, lake, D15)
    assert len(day.inputFiles()) >= 1
    plan = day.select("repo_id")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "payload" not in plan.split("ReadSchema")[-1]


def test_bronze_round_trip_keeps_payload_text_and_arrival(spark, tmp_path):
    sent = spark.createDataFrame(
        [("1", '{"action":"opened"}', "2024-04-05T03:00:00Z", "x")],
        "id string, payload string, created_at string, _ingested_at string",
    )
    placed = bronze.partition_by_created_at(sent)
    bronze.write_jsonl_gz(placed, str(tmp_path / "live"))
    row = bronze.read_bronze_live(spark, str(tmp_path / "live"), "2024-04-05", 3).first()
    assert (row.payload, row.ingested_at, row.month, row.hour) == ('{"action":"opened"}', "x", "04", "03")


def test_events_without_a_time_go_where_they_arrived(spark):
    sent = spark.createDataFrame(
        [("a", "2024-04-05T23:30:00-02:00", None), ("b", "soon", "2024-04-07T01:00:00+00:00"), ("c", None, "2024-04-08T02:00:00Z")],
        "id string, created_at string, _ingested_at string",
    )
    placed = rows_of(bronze.partition_by_created_at(sent), "id", "month", "day", "hour")
    assert placed == [("a", "04", "06", "01"), ("b", "04", "07", "01"), ("c", "04", "08", "02")]


def test_archive_hour_lands_once(spark, tmp_path):
    source, root = str(tmp_path / "in.json"), str(tmp_path / "archive")
    write_lines(source, [event("1"), "{broken"])
    assert bronze.append_archive_hour(spark, source, root, D15, 3) is True
    write_lines(source, [event("2"), event("3")])
    assert bronze.append_archive_hour(spark, source, root, D15, 3) is False
    good, bad = bronze.quarantine_malformed(bronze.read_bronze_archive(spark, root, D15, 3))
    assert rows_of(good, "id", "hour") == [("1", "03")]
    assert rows_of(bad, "_corrupt_record") == [("{broken",)]
    write_lines(source, [])
    (tmp_path / "none").mkdir()
    with pytest.raises(RuntimeError):
        bronze.append_archive_hour(spark, str(tmp_path / "none"), root, D15, 4)


def test_expired_days_are_deleted_on_request(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for day in ("2024-01-01", "2024-01-17", "2024-01-18"):
        y, m, d = day.split("-")
        write_lines(f"{root}/year={y}/month={m}/day={d}/hour=00/f.json", [event("1")])
    assert tables.expired_days(spark, root, "2024-02-01") == ["2024-01-01", "2024-01-17"]
    assert tables.expire_bronze(spark, root, "2024-02-01") == ["2024-01-01", "2024-01-17"]
    assert child_names(spark, f"{root}/year=2024/month=01") == ["day=18"]


def test_tables_can_be_created_twice_and_queried(spark, lake):
    build_silver(spark, lake, D15)
    build_gold(spark, lake, D15)
    made = catalog.create_tables(spark, lake, "lake_test")
    assert catalog.create_tables(spark, lake, "lake_test") == made
    found = spark.sql("SELECT count(*) FROM lake_test.silver_events WHERE day = '15'").first()[0]
    assert found == 7
    assert spark.sql("SELECT sum(event_count) FROM lake_test.gold_repo_daily").first()[0] == 7
    assert spark.sql("SELECT count(*) FROM lake_test.bronze_live WHERE hour = '10'").first()[0] == 2
    spark.sql("DROP DATABASE lake_test CASCADE")


def test_csv_export_has_a_header(spark, tmp_path):
    frame = spark.createDataFrame([("o/a", 1)], "repo_name string, n int")
    tables.export_csv(frame, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.columns == ["repo_name", "n"] and rows_of(back) == [("o/a", "1")]


def test_sources_report(spark, lake):
    archive = bronze.read_bronze_archive(spark, f"{lake}/bronze/archive", D15)
    live = bronze.read_bronze_live(spark, f"{lake}/bronze/live", D15)
    found = rows_of(quality.sources_ready(archive, live), "hour", "live_cnt", "archive_cnt")
    assert found == [("10", 2, 5), ("11", 0, 3)]
    assert quality.verify_silver(tables.read_silver(spark, lake)).count() == 0
    assert quality.silver_ready(tables.read_silver(spark, lake)).where(F.col("cnt") > 0).isEmpty()


def test_a_half_landed_hour_lands_again(spark, tmp_path):
    source, root = str(tmp_path / "file.json"), str(tmp_path / "bronze/archive")
    write_lines(source, [event("1")])
    partial = tmp_path / "bronze/archive/year=2024/month=01/day=15/hour=03/part-0.txt"
    write_lines(partial, ["cut"])  # data, but no completion marker
    assert bronze.append_archive_hour(spark, source, root, D15, 3) is True
    assert bronze.append_archive_hour(spark, source, root, D15, 3) is False
    assert bronze.read_bronze_archive(spark, root, D15, 3).count() == 1


def test_backfills_keep_other_days_and_refuse_empty_input(spark, lake):
    for day in (D14, D15):
        build_silver(spark, lake, day)
    build_gold(spark, lake, D14)
    build_gold(spark, lake, D15)
    before = everything(spark, lake)
    delete_path(spark, day_path(f"{lake}/silver/events", D14))
    daily.backfill_gold(spark, lake)
    assert everything(spark, lake) == before
    delete_path(spark, f"{lake}/silver")
    with pytest.raises(quality.EmptyLayerError):
        daily.backfill_gold(spark, lake)
    assert everything(spark, lake) == before


def test_the_hourly_build_keeps_its_rejects(spark, lake):
    land(lake, "live", D15, 11, [event("x", created=f"{D15}T11:05:00Z", _ingested_at=f"{D15}T11:05:30Z")])
    build_hour(spark, lake, D15, 11)
    kept = spark.read.parquet(f"{lake}/quarantine_hourly")
    assert kept.where("_corrupt_record = '{broken'").count() == 1
    before = kept.count()
    build_hour(spark, lake, D15, 11)
    assert spark.read.parquet(f"{lake}/quarantine_hourly").count() == before
