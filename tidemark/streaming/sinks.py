"""Streaming jobs: raw landing, rejects and the pulse grain."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.operators.pulse import pulse_events, pulse_grain
from tidemark.schemas import HOUR_PARTS, PULSE_GRAIN
from tidemark.sources.bronze import partition_by_created_at
from tidemark.sources.paths import path_exists
from tidemark.streaming.health import with_progress
from tidemark.streaming.source import readable, rejects

EVERY_MINUTE = {"processingTime": "60 seconds"}


def bronze_sink(
    events: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    files_per_hour: int | None = None,
) -> StreamingQuery:
    """Land events as gzip JSON lines in their own hour's folder.

    The checkpoint and the file sink's log make the output exactly-once; a
    stopped query resumes where it left off. A minute's batch spans an hour
    or two and is written where it was read; a replay of many hours should
    set ``files_per_hour``, which shuffles each hour into that many files.
    """
    placed = partition_by_created_at(readable(events))
    if files_per_hour is not None:
        placed = placed.repartition(*HOUR_PARTS, F.pmod(F.xxhash64("id"), F.lit(files_per_hour)))
    return (
        placed.writeStream.format("json")
        .option("compression", "gzip")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*HOUR_PARTS)
        .trigger(**(trigger or EVERY_MINUTE))
        .start()
    )


def reject_sink(
    events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the text of every record that could not be read."""
    return (
        rejects(events)
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_MINUTE))
        .start()
    )


# folder of the pulse table by how much one batch usually spans
FOLDERS = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd"}


def write_grain_batch(
    events: DataFrame, batch_id: int, path: str, folder: str = "hour", run: str = "run"
) -> None:
    """Store one batch's grain; writing the same batch again replaces it.

    Folders are (period, run, batch): a reader of the last hour opens no
    others, and a replayed batch overwrites exactly its own folders. ``run``
    names the stream: batch numbers start again with a new checkpoint.
    """
    grain = pulse_grain(pulse_events(readable(events)))
    (
        grain.withColumns(
            {
                "period": F.date_format("minute", FOLDERS[folder]),
                "run": F.lit(run),
                "batch_id": F.lit(batch_id).cast("bigint"),
            }
        )
        .hint("rebalance", "period")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("period", "run", "batch_id")
        .parquet(path)
    )


def pulse_sink(
    events: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    folder: str = "hour",
    progress: str | None = None,
) -> StreamingQuery:
    """Keep the pulse grain up to date; with ``progress`` also a row for each batch there.

    Each batch is reduced on its own and added up at read time, so there is
    no state to lose, late events still count and restarts add nothing twice.
    Long replays may use day folders.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        # the query's id is kept in its checkpoint: the same after a restart, new with a new one
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        write_grain_batch(batch, batch_id, path, folder, run)

    return (
        events.writeStream.foreachBatch(store if progress is None else with_progress(store, progress))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_MINUTE))
        .start()
    )


def recent_periods(now: dt.datetime, minutes: int, folder: str = "hour") -> list[str]:
    """Folders that can hold the last ``minutes`` minutes before ``now``."""
    shape = {"hour": "%Y-%m-%d-%H", "day": "%Y-%m-%d"}[folder]
    steps = range(0, minutes + 60, 60)
    moments = [now - dt.timedelta(minutes=min(step, minutes)) for step in steps]
    return sorted({moment.strftime(shape) for moment in moments})


def read_grain(spark: SparkSession, path: str, periods: list[str] | None = None) -> DataFrame:
    """Stored grain rows; with ``periods`` only those folders are listed."""
    if periods is None:
        rows = spark.read.parquet(path)
    else:
        folders = [f"{path}/period={p}" for p in periods if path_exists(spark, f"{path}/period={p}")]
        if not folders:
            return spark.createDataFrame([], PULSE_GRAIN)
        rows = spark.read.option("basePath", path).parquet(*folders)
    return rows.drop("period", "run", "batch_id")


class Intake(StreamingQueryListener):
    """Counts what every query has taken in since the listener was added.

    ``recentProgress`` forgets after a hundred batches; this does not.
    """

    def __init__(self) -> None:
        self.messages: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.messages.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        key = str(progress.id)
        self.messages[key] = self.messages.get(key, 0) + int(progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def stream_health(query: StreamingQuery, intake: Intake, now: dt.datetime | None = None) -> dict:
    """Whether a query runs, what it has taken in, and the age of its last batch in seconds."""
    last = query.lastProgress
    at = None if last is None else dt.datetime.fromisoformat(last["timestamp"].replace("Z", "+00:00"))
    now = now or dt.datetime.now(dt.timezone.utc)
    return {
        "active": query.isActive,
        "messages": intake.messages.get(str(query.id), 0),
        "last_batch_at": None if at is None else at.isoformat(),
        "lag_seconds": None if at is None else max(0.0, (now - at).total_seconds()),
    }
