"""Run the registered queries next to their SQL: python -m checks.compare [dir] [name ...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.job_oracles import JOB_ORACLES
from checks.jobs import QUERIES
from checks.oracles import ORACLES as PLAIN_ORACLES

ORACLES = PLAIN_ORACLES | JOB_ORACLES
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


KINDS = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def canonical(columns: list[str], rows: list) -> tuple[list[str], list[str]]:
    """Column names in order, and the rows as sorted text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([row[i] for i in order]) for row in rows)


def differences(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    """None when the query and its SQL agree, else the first difference."""
    result = QUERIES[name](spark, sf_dir)
    mine = canonical(result.columns, [tuple(r) for r in result.collect()])
    wanted = con.sql(ORACLES[name])
    kinds = dict(zip(wanted.columns, map(str, wanted.types)))
    theirs = canonical(wanted.columns, wanted.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    other = {c: (k, kinds[c]) for c, k in result.dtypes if KINDS.get(k) != kinds[c]}
    if other:
        return f"types {other}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} != {len(theirs[1])}"
    for ours, expected in zip(mine[1], theirs[1]):
        if ours != expected:
            return f"\n  spark  {ours[:600]}\n  duckdb {expected[:600]}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            if name in ORACLES:
                found = differences(spark, con, sf_dir, name)
                verdict = "ok" if found is None else f"DIFFERENT {found}"
            else:
                verdict = f"rows {QUERIES[name](spark, sf_dir).count()}"
        except Exception as error:  # noqa: BLE001
            verdict = f"FAILED {str(error)[:900]}"
        failed += verdict.startswith(("DIFFERENT", "FAILED"))
        print(f"{name:26s} {time.time() - start:6.2f}s {verdict}", flush=True)
    return failed


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(main(str(Path(folder)), sys.argv[2:]))
