"""The document table in buckets of its key, so that a merge never moves the stored rows.

A date folder is the unit of a nightly update. Updates that hit any date go
into this form: the rows lie in a fixed number of buckets of (date,
repo_name), and a merge shuffles the updates alone to where the stored rows
lie. Every merge writes the next version of the table, in the same buckets,
and then takes the old one's name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from tidemark.operators.documents import KEY, upsert_docs
from tidemark.schemas import DOCUMENT
from tidemark.session import TARGET_PARTITION_BYTES

NEXT = "__next"


def buckets_for(total_bytes: int, least: int = 8) -> int:
    """Buckets of about the size of a partition, so that a bucket is one task's work."""
    return max(least, -(-total_bytes // TARGET_PARTITION_BYTES))


def _write(documents: DataFrame, table: str, buckets: int) -> None:
    (
        documents.select(*DOCUMENT.fieldNames())
        .write.format("parquet")
        .mode("overwrite")
        .bucketBy(buckets, *KEY)
        .sortBy(*KEY)
        .saveAsTable(table)
    )


def create_document_buckets(documents: DataFrame, table: str, buckets: int) -> None:
    """Store documents as a table of ``buckets`` buckets, one file each. Keys must not be NULL."""
    _write(documents.dropna(subset=KEY).repartition(buckets, *KEY), table, buckets)


def read_document_buckets(spark: SparkSession, table: str) -> DataFrame:
    """The stored documents; finishes a merge that broke off between its two renames."""
    if not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table}{NEXT} RENAME TO {table}")
    return spark.table(table)


def merged_documents(spark: SparkSession, table: str, updates: DataFrame, seq: Column | None = None) -> DataFrame:
    """The stored documents with ``updates`` merged in; only the updates are shuffled."""
    base = read_document_buckets(spark, table)
    return upsert_docs(base, updates.dropna(subset=KEY), seq, null_keys=False)


def merge_document_buckets(
    spark: SparkSession, table: str, updates: DataFrame, buckets: int, seq: Column | None = None
) -> None:
    """Merge ``updates`` into the table. The rows come out in buckets and are written where they are."""
    _write(merged_documents(spark, table, updates, seq), f"{table}{NEXT}", buckets)
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {table}{NEXT} RENAME TO {table}")
