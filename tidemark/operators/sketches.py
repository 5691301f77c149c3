"""Distinct repositories and actors of long windows, from sketches that merge.

The exact grain holds a row per name and minute; a month of it is long. A
sketch row per minute and type stands for all its names, so a month's window
reads minutes and types only. Sketches of any minutes unite to the sketch of
their union: one table serves every window.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.pulse import in_window

# registers of a sketch are 2 ** LOG_K; its estimate is within BOUND of the truth
# (three standard errors of 1.04 / sqrt(2 ** LOG_K), and one name for small counts)
LOG_K = 12
BOUND = 3 * 1.04 / 2 ** (LOG_K / 2)


def pulse_sketches(grain: DataFrame, log_k: int = LOG_K) -> DataFrame:
    """(minute, type, n, repos, actors): counts and sketches of the names; combined map-side."""
    return grain.groupBy("minute", "type").agg(
        F.sum("n").alias("n"),
        F.hll_sketch_agg("repo_name", F.lit(log_k)).alias("repos"),
        F.hll_sketch_agg("actor_id", F.lit(log_k)).alias("actors"),
    )


def united(sketches: DataFrame, *by) -> DataFrame:
    """Events and estimated distincts of each group of sketch rows."""
    def estimate(name: str):
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(name)), F.lit(0)).alias(f"unique_{name}")

    return sketches.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("events"), estimate("repos"), estimate("actors")
    )


def pulse_totals_sketched(
    sketches: DataFrame, now: dt.datetime | None = None, minutes: int = 30 * 24 * 60
) -> DataFrame:
    """Events and estimated distinct repositories and actors of a window."""
    return united(in_window(sketches, now, minutes))


def within_bound(estimate, exact, bound: float = BOUND):
    """Whether an estimate lies within the stated bound."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), F.lit(bound) * exact)
