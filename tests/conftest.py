from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.schemas import BRONZE_EVENT, HOUR_PARTS, LIVE_EVENT  # noqa: E402
from tidemark.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(base / "shared"))
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


def event(
    id="1",
    type="PushEvent",
    actor=7,
    repo=1,
    name="org/one",
    payload=None,
    created="2024-01-15T10:00:00Z",
    **more,
) -> dict:
    """One bronze event as it stands in a file."""
    row = {
        "id": id,
        "type": type,
        "actor": {"id": actor, "login": f"user-{actor}"},
        "repo": {"id": repo, "name": name},
        "payload": payload if payload is not None else {},
        "public": True,
        "created_at": created,
    }
    return row | more


def write_lines(path, rows) -> None:
    """JSON lines; a str is written as it is."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    text = "\n".join(r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in rows)
    path.write_text(text + "\n", encoding="utf-8")


def bronze_frame(spark, rows, live=False, day="2024-01-15", hour="10"):
    """Bronze rows of one hour as a DataFrame (payload as JSON text)."""
    schema = LIVE_EVENT if live else BRONZE_EVENT
    names = schema.fieldNames()
    year, month, dom = day.split("-")
    data = []
    for row in rows:
        values = {n: row.get(n) for n in names}
        if not isinstance(values["payload"], (str, type(None))):
            values["payload"] = json.dumps(values["payload"])
        for struct in ("actor", "repo", "org"):
            if values[struct] is not None:
                kind = schema[struct].dataType
                values[struct] = tuple(values[struct].get(f) for f in kind.fieldNames())
        parts = {"year": row.get("_y", year), "month": row.get("_m", month), "day": row.get("_d", dom)}
        data.append(tuple(values[n] for n in names) + (*parts.values(), row.get("_h", hour)))
    full = schema.simpleString()[7:-1] + "," + ",".join(f"{p}:string" for p in HOUR_PARTS)
    frame = spark.createDataFrame(data, f"struct<{full}>")
    return frame.withColumnRenamed("_ingested_at", "ingested_at") if live else frame


def rows_of(frame, *columns):
    """Rows as a sorted list of tuples."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=repr)
