"""Duplicate deliveries sorted out while they stream in, live before archive.

State holds, per (day, id), how good the best delivery so far was. Each
delivery gets a verdict: ``kept`` when nothing as good has come before,
``duplicate`` when something has, ``late`` when its day's state may be gone
(its time lies behind the watermark and there is no state). All verdicts are
stored, so nothing is lost: the deliveries that count are the best of the kept
and late ones, of which a day has hardly more than ids.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from tidemark.functions.scalars import utc_timestamp
from tidemark.operators.events import LIVE, dedup_live_first
from tidemark.schemas import DAY_PARTS
from tidemark.sources.paths import child_names, path_exists

VERDICTS = ("kept", "duplicate", "late")
# how long the state of an id without new deliveries is held (wall clock)
HELD_MS = 3 * 24 * 3600 * 1000

_KEY = [*DAY_PARTS, "id"]
_RANKED = "_event_time timestamp, _not_live int, _arrived bigint, _tie bigint"
_ORDER = ["_not_live", "_arrived", "_tie"]


def ranked(deliveries: DataFrame) -> DataFrame:
    """Add the order of ``dedup_live_first`` as numbers, and the event time."""
    arrived = F.unix_micros(utc_timestamp(F.col("ingested_at")).cast("timestamp"))
    at = F.coalesce(utc_timestamp(F.col("created_at")), utc_timestamp(F.col("ingested_at")))
    return deliveries.where(F.col("id").isNotNull()).withColumns(
        {
            "_event_time": F.coalesce(at.cast("timestamp"), F.timestamp_seconds(F.lit(0))),
            "_not_live": F.when(F.col("source") == LIVE, 0).otherwise(1),
            "_arrived": F.coalesce(arrived, F.lit((1 << 63) - 1)),
            "_tie": F.xxhash64("created_at", "type", "repo_id", "repo_name", "actor_id", "payload"),
        }
    )


def _latest(spark: SparkSession, folder: str, batch_id: int) -> DataFrame | None:
    """The rows a batch before ``batch_id`` left below ``folder``; None before the first."""
    done = [int(n.split("=", 1)[1]) for n in child_names(spark, folder) if n.startswith("batch_id=")]
    done = [b for b in done if b < batch_id]
    return spark.read.parquet(f"{folder}/batch_id={max(done)}") if done else None


def judge_batch(batch: DataFrame, batch_id: int, state_dir: str, delay: str) -> tuple[DataFrame, DataFrame]:
    """The verdicts on the deliveries of one micro-batch, and the state after it.

    The state is the best order per (day, id) with the wall clock of its last
    delivery, and the largest event time so far; both are stored per batch, so
    a replayed batch reads what the batch before it left.
    """
    spark = batch.sparkSession
    now = int(time.time() * 1000)
    rows = ranked(batch)
    clock = _latest(spark, f"{state_dir}/clock", batch_id)
    seen = clock.first()["max_event"] if clock is not None else None
    # as a stream's watermark: the latest event time of the earlier batches less the delay
    watermark = F.lit(seen).cast("timestamp") - F.expr(f"INTERVAL {delay}") if seen is not None else None
    order = F.struct(*[F.col(c).alias(n) for c, n in zip(_ORDER, "nat")])
    best = _latest(spark, f"{state_dir}/best", batch_id)
    if best is None:
        best = rows.select(*_KEY, order.alias("_best"), F.lit(now).alias("_touched")).limit(0)
    best = best.where(F.col("_touched") >= now - HELD_MS)  # held no longer without new deliveries
    key = Window.partitionBy(*_KEY)
    judged_rows = (
        rows.withColumns(
            {
                "_first": F.row_number().over(key.orderBy(*_ORDER)) == 1,
                "_latest": F.max("_event_time").over(key),
                "_order": order,
            }
        )
        .join(best.select(*_KEY, "_best"), _KEY, "left")
    )
    late = F.col("_best").isNull() & (F.col("_latest") < watermark) if watermark is not None else F.lit(False)
    better = F.col("_first") & (F.col("_best").isNull() | (F.col("_order") < F.col("_best")))
    verdict = F.when(late, "late").when(better, "kept").otherwise("duplicate")
    judged_rows = judged_rows.withColumn("verdict", verdict)
    after = (
        judged_rows.where(F.col("_first") & (F.col("verdict") != "late"))
        .select(*_KEY, F.least("_order", F.coalesce("_best", "_order")).alias("_best"), F.lit(now).alias("_touched"))
        .unionByName(best.join(rows.select(*_KEY).distinct(), _KEY, "left_anti"))
    )
    out = judged_rows.select(*batch.columns, "verdict")
    return out, after


def dedup_sink(
    deliveries: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, delay: str = "2 days"
) -> StreamingQuery:
    """Store every delivery below its verdict; a replayed batch replaces its own folders."""
    state_dir = f"{checkpoint}/dedup_state"

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch = batch.persist()
        out, after = judge_batch(batch, batch_id, state_dir, delay)
        (
            out.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id).cast("bigint")})
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("verdict", "run", "batch_id")
            .parquet(path)
        )
        after.write.mode("overwrite").parquet(f"{state_dir}/best/batch_id={batch_id}")
        clock = _latest(spark, f"{state_dir}/clock", batch_id)
        event_times = ranked(batch).select(F.col("_event_time").alias("max_event"))
        if clock is not None:
            event_times = event_times.unionByName(clock)
        event_times.agg(F.max("max_event").alias("max_event")).write.mode("overwrite").parquet(
            f"{state_dir}/clock/batch_id={batch_id}"
        )
        batch.unpersist()

    return (
        deliveries.writeStream.foreachBatch(store)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "60 seconds"}))
        .start()
    )


def read_verdict(spark: SparkSession, path: str, verdict: str) -> DataFrame | None:
    """Deliveries stored below a verdict; None when it was never given."""
    folder = f"{path}/verdict={verdict}"
    if not path_exists(spark, folder):
        return None
    return spark.read.option("basePath", folder).parquet(folder).drop("run", "batch_id")


def read_deduplicated(spark: SparkSession, path: str) -> DataFrame:
    """One delivery per (day, id): the best of the kept and the late ones.

    A kept delivery is superseded when a better one came later.
    """
    found = [read_verdict(spark, path, v) for v in ("kept", "late")]
    found = [rows for rows in found if rows is not None]
    both = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return dedup_live_first(both)
