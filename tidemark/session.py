"""Session settings the jobs rely on, and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator assumes (idempotent)."""
    settings = {
        # every timestamp in the tables is a UTC wall clock (TIMESTAMP_NTZ)
        "spark.sql.session.timeZone": "UTC",
        # keep month=04 a string instead of the integer 4
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "snappy",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int, most: int | None = None) -> int:
    """Start shuffles with enough partitions for ``input_bytes``.

    AQE can only merge partitions, so the initial number has to be right for
    the largest shuffle of the job; small ones are coalesced afterwards.
    ``most`` bounds them where a cluster's bookkeeping asks for it.
    """
    wanted = max(spark.sparkContext.defaultParallelism, -(-input_bytes // TARGET_PARTITION_BYTES))
    wanted = wanted if most is None else min(wanted, most)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return wanted


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below ``path`` according to its file system (0 when absent)."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(hadoop_path).getLength() if fs.exists(hadoop_path) else 0


def shared_dir(spark: SparkSession) -> str:
    """Folder for staged tables: ``spark.checkpoint.dir`` of the session.

    There is no default: a machine-local folder would be lost with its executor.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    named = named or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def new_stage_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
