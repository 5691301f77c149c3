"""Row counts of table folders, taken while they are written and read by the gates.

A write of known days observes its rows on their way to the files: one count
per day and condition, no second scan. The counts are stored per day beside
the table, and written after it: a day without a ledger row is a day whose
write did not finish.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import utc_now
from tidemark.operators.quality import EmptyLayerError
from tidemark.sources.paths import delete_path, path_exists

LEDGER = "day string, name string, rows bigint, written_at timestamp_ntz"
ALL = "rows"


def _folder(table_path: str) -> str:
    return f"{table_path}/_ledger"


def write_counted(
    rows: DataFrame,
    write: Callable[[DataFrame], None],
    table_path: str,
    days: list[str],
    day: Column,
    counts: Mapping[str, Column] | None = None,
) -> None:
    """``write`` the rows of ``days`` and store how many each day has, in all and per condition.

    ``day`` is a row's day as yyyy-MM-dd text. The days to write are known
    (from folder names or the calendar), so they are columns of one observation.
    """
    spark = rows.sparkSession
    wanted = {ALL: F.lit(True), **(counts or {})}
    names = {f"{name}|{d}": (name, d) for d in days for name in wanted}
    seen = Observation()
    metrics = [F.count_if((day == d) & wanted[name]).alias(key) for key, (name, d) in names.items()]
    for d in days:  # from here on the old counts are not those of the files
        delete_path(spark, f"{_folder(table_path)}/day={d}")
    write(rows.where(day.isin(days)).observe(seen, *metrics))
    got = seen.get
    stored = spark.createDataFrame(
        [(d, name, got[key]) for key, (name, d) in names.items()], "day string, name string, rows bigint"
    )
    (
        stored.withColumn("written_at", utc_now())
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(_folder(table_path))
    )


def read_ledger(spark: SparkSession, table_path: str) -> DataFrame:
    """(day, name, rows, written_at) of every finished day."""
    schema = T.StructType.fromDDL(LEDGER)
    if not path_exists(spark, _folder(table_path)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_folder(table_path))


def ledger_report(spark: SparkSession, table_path: str) -> DataFrame:
    """A row per day with a column per count."""
    return read_ledger(spark, table_path).groupBy("day").pivot("name").agg(F.first("rows"))


def require_rows(spark: SparkSession, table_path: str, day: str, name: str = ALL) -> int:
    """The stored count of a day; raises when it is 0 or the day's write did not finish."""
    row = read_ledger(spark, table_path).where((F.col("day") == day) & (F.col("name") == name)).first()
    if row is None or row["rows"] == 0:
        raise EmptyLayerError(f"{table_path} has no counted rows for {day} ({name})")
    return row["rows"]
