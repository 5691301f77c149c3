"""Streaming sources: a Kafka topic, or JSON files with the same records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import CORRUPT, LIVE_EVENT


def decode(records: DataFrame) -> DataFrame:
    """Records with a ``value`` to live events; the text of an unreadable one is in CORRUPT."""
    schema = T.StructType([*LIVE_EVENT.fields, T.StructField(CORRUPT, T.StringType())])
    text = F.col("value").cast("string")
    event = F.from_json(text, schema, {"columnNameOfCorruptRecord": CORRUPT})
    bad = F.col("event").isNull() | F.col(f"event.{CORRUPT}").isNotNull()
    return (
        records.select(text.alias("text"), event.alias("event"))
        .where(F.col("text").isNotNull())
        .select(
            *[F.when(~bad, F.col(f"event.{f.name}")).alias(f.name) for f in LIVE_EVENT.fields],
            F.when(bad, F.col("text")).alias(CORRUPT),
        )
    )


def readable(events: DataFrame) -> DataFrame:
    """Events without those that could not be read."""
    if CORRUPT not in events.columns:
        return events
    return events.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejects(events: DataFrame) -> DataFrame:
    """The texts that could not be read."""
    return events.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))


def topic_source(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    batch_records: int = 500,
    batch_seconds: int = 60,
) -> DataFrame:
    """Events of a topic; a batch starts at ``batch_records`` or ``batch_seconds``.

    Needs the Kafka connector on the class path. Start raw landing at
    'earliest' and a pulse without history at 'latest'.
    """
    return decode(
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("minOffsetsPerTrigger", batch_records)
        .option("maxTriggerDelay", f"{batch_seconds}s")
        .load()
    )


def file_source(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Events of JSON-lines files dropped into a folder."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return decode(reader.text(path))


def stamp_and_key(events: DataFrame) -> DataFrame:
    """Records for a keyed topic: arrival time stamped, repository id as key.

    One key per repository keeps each repository's events in order.
    """
    stamped = events.withColumn(
        "_ingested_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    )
    return stamped.select(
        F.col("repo.id").cast("string").alias("key"), F.to_json(F.struct("*")).alias("value")
    )


def topic_sink(records: DataFrame, servers: str, checkpoint: str, topic: str):
    """Publish keyed records (needs the Kafka connector)."""
    return (
        records.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
