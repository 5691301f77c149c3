"""Idempotent registration of the lake's folders as tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemark.schemas import BRONZE_EVENT, GOLD, GOLD_PARTS, HOUR_PARTS, LIVE_EVENT, SILVER
from tidemark.sources.paths import path_exists


def _columns(schema: T.StructType, parts: list[str]) -> str:
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
    return ", ".join(columns + [f"`{p}` string" for p in parts])


def table_definitions(root: str) -> dict[str, tuple[str, str]]:
    """(folder, definition) of every table."""
    tables = {
        "bronze_archive": ("json", BRONZE_EVENT, HOUR_PARTS, f"{root}/bronze/archive"),
        "bronze_live": ("json", LIVE_EVENT, HOUR_PARTS, f"{root}/bronze/live"),
        "silver_events": ("parquet", SILVER, HOUR_PARTS, f"{root}/silver/events"),
    }
    for name, schema in GOLD.items():
        tables[f"gold_{name}"] = ("parquet", schema, GOLD_PARTS[name], f"{root}/gold/{name}")
    return {
        name: (
            location,
            f"({_columns(schema, parts)}) USING {kind} "
            f"PARTITIONED BY ({', '.join(parts)}) LOCATION '{location}'",
        )
        for name, (kind, schema, parts, location) in tables.items()
    }


def create_tables(spark: SparkSession, root: str, database: str = "tidemark") -> list[str]:
    """Create whatever is missing, then register the partitions on disk.

    Run it again after new partitions were written.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    created = []
    for name, (folder, body) in table_definitions(root).items():
        table = f"{database}.{name}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} {body}")
        if path_exists(spark, folder):
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        created.append(table)
    return created
