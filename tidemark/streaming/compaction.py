"""Closed periods of the pulse table folded into one set of files each.

A period's folder gains a folder per stream batch. ``fold_period`` adds them up
into ``_folded/period=…/fold=…`` and then puts a marker beside it that names
the batches inside. Readers go by the marker: it appears in one rename, so a
reader sees the batches or their fold, never both. A batch that is replayed
after the fold overwrites its own folder, which the marker still names, and a
late batch is not named and counts on top until the next fold.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.pulse import GRAIN
from tidemark.schemas import PULSE_GRAIN
from tidemark.sources.paths import child_names, delete_path, path_exists
from tidemark.streaming.sinks import recent_periods

def _folded(path: str, period: str) -> str:
    return f"{path}/_folded/period={period}"


def _markers(spark: SparkSession, path: str, period: str) -> list[str]:
    """The period's markers, oldest first; the last one counts."""
    return [n for n in child_names(spark, _folded(path, period)) if n.startswith("marker-")]


def _read_marker(spark: SparkSession, path: str, period: str) -> tuple[str | None, list[str]]:
    """(the fold that counts, the batches inside it)."""
    markers = _markers(spark, path, period)
    if not markers:
        return None, []
    text = spark.read.text(f"{_folded(path, period)}/{markers[-1]}", wholetext=True).first().value
    fold, *batches = text.split("\n")
    return fold, batches


def _write_marker(spark: SparkSession, path: str, period: str, lines: list[str]) -> None:
    """Written beside and renamed to the next number, so that a marker is whole or absent."""
    folder, old = _folded(path, period), _markers(spark, path, period)
    number = int(old[-1].partition("-")[2]) + 1 if old else 1
    target, fresh = f"{folder}/marker-{number:08d}", f"{folder}/new-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(target).getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(hadoop(fresh), True)
    out.write(bytearray("\n".join(lines).encode()))
    out.close()
    if not fs.rename(hadoop(fresh), hadoop(target)):
        raise OSError(f"could not put {target} in place")


def batches_of(spark: SparkSession, path: str, period: str) -> list[str]:
    """Folders of a period's batches, as ``run=…/batch_id=…``."""
    folder = f"{path}/period={period}"
    return [f"{run}/{b}" for run in child_names(spark, folder) for b in child_names(spark, f"{folder}/{run}")]


def stored_periods(spark: SparkSession, path: str) -> list[str]:
    """Periods of the table, oldest first, from folder names alone."""
    names = {*child_names(spark, path), *child_names(spark, f"{path}/_folded")}
    return sorted(n.partition("=")[2] for n in names if n.startswith("period="))


def files_of(spark: SparkSession, path: str, period: str) -> list[str]:
    """The folders that hold a period's rows, each row in one of them."""
    fold, inside = _read_marker(spark, path, period)
    open_batches = [b for b in batches_of(spark, path, period) if b not in set(inside)]
    return ([] if fold is None else [f"{_folded(path, period)}/{fold}"]) + [
        f"{path}/period={period}/{b}" for b in open_batches
    ]


def read_folded_grain(spark: SparkSession, path: str, periods: list[str] | None = None) -> DataFrame:
    """Grain rows of some or all periods, folded or not; only their folders are listed."""
    chosen = stored_periods(spark, path) if periods is None else periods
    folders = [f for period in chosen for f in files_of(spark, path, period)]
    if not folders:
        return spark.createDataFrame([], PULSE_GRAIN)
    return spark.read.schema(PULSE_GRAIN).parquet(*folders)


def fold_period(spark: SparkSession, path: str, period: str, clean: bool = False) -> int:
    """Fold a period's batches into one folder; returns how many batches it now holds.

    Folding again takes in what came late. ``clean`` deletes what is folded: do
    so for periods that no reader started before the fold still reads, and no
    stream will replay.
    """
    folders = files_of(spark, path, period)
    old, inside = _read_marker(spark, path, period)
    fresh = [b for b in batches_of(spark, path, period) if b not in set(inside)]
    if fresh:
        fold = f"fold={uuid.uuid4().hex}"
        rows = spark.read.schema(PULSE_GRAIN).parquet(*folders)
        summed = rows.groupBy(*GRAIN).agg(F.sum("n").alias("n"))
        # the coming readers cut by minute
        summed.repartitionByRange("minute").sortWithinPartitions("minute").write.parquet(
            f"{_folded(path, period)}/{fold}"
        )
        inside = [*inside, *fresh]
        _write_marker(spark, path, period, [fold, *inside])
    if clean:
        now, _ = _read_marker(spark, path, period)
        counted = {now, *_markers(spark, path, period)[-1:]}
        for name in child_names(spark, _folded(path, period)):
            if name not in counted:
                delete_path(spark, f"{_folded(path, period)}/{name}")
        for batch in inside:
            delete_path(spark, f"{path}/period={period}/{batch}")
    return len(inside)


def newest_minute(spark: SparkSession, path: str) -> dt.datetime | None:
    """The newest minute of the table, read from its newest period only."""
    for period in reversed(stored_periods(spark, path)):
        newest = read_folded_grain(spark, path, [period]).agg(F.max("minute")).first()[0]
        if newest is not None:
            return newest
    return None


def recent_grain(
    spark: SparkSession, path: str, minutes: int, now: dt.datetime | None = None, folder: str = "hour"
) -> tuple[DataFrame, dt.datetime | None]:
    """(rows of the folders that can hold the last ``minutes`` minutes, the running minute)."""
    now = now or newest_minute(spark, path)
    if now is None:
        return spark.createDataFrame([], PULSE_GRAIN), None
    return read_folded_grain(spark, path, recent_periods(now, minutes, folder)), now
