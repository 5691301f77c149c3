"""What a stream has taken in, written with each batch: it outlives the driver.

Every batch leaves a row keyed by (query id, batch id) beside its output. The
query's id is kept in its checkpoint, a replayed batch replaces its own row,
so the sums are right after any number of restarts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import utc_now
from tidemark.sources.paths import path_exists

PROGRESS = "query_id string, batch_id bigint, messages bigint, written_at timestamp_ntz"

Store = Callable[[DataFrame, int], None]


def with_progress(store: Store, path: str) -> Store:
    """``store`` that also keeps the number of rows of each batch, counted while they are stored."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = Observation()
        store(batch.observe(seen, F.count(F.lit(1)).alias("messages")), batch_id)
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        row = spark.range(1).select(
            F.lit(seen.get["messages"]).cast("bigint").alias("messages"),
            utc_now().alias("written_at"),
            F.lit(query_id).alias("query_id"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
        )
        (
            row.coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("query_id", "batch_id")
            .parquet(path)
        )

    return run


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """A row for every stored batch of every query."""
    schema = T.StructType.fromDDL(PROGRESS)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def stored_health(spark: SparkSession, path: str, now: dt.datetime | None = None) -> DataFrame:
    """Messages and batches of each query since its checkpoint began, and the age of its last batch."""
    clock = utc_now() if now is None else F.lit(now.isoformat()).cast("timestamp_ntz")
    rows = read_progress(spark, path).groupBy("query_id").agg(
        F.sum("messages").alias("messages"),
        F.count(F.lit(1)).alias("batches"),
        F.max("batch_id").alias("last_batch"),
        F.max("written_at").alias("last_batch_at"),
    )
    age = F.unix_micros(clock.cast("timestamp")) - F.unix_micros(F.col("last_batch_at").cast("timestamp"))
    return rows.withColumn("lag_seconds", F.greatest(F.lit(0.0), age / 1_000_000))
