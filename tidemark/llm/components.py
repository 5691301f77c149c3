"""Connected components by alternating stars.

Every edge is kept as (larger, smaller). A large star links a node's larger
neighbours to the smallest node it knows, a small star its smaller ones; the
rounds end when nothing changes, after a number that grows with the logarithm
of the longest path. Minima are grouped before they are shuffled, so a hub
with a third of all edges costs no more than its share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import drop, stage


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One star round over edges (a, b) with a > b."""
    around = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    if large:
        around = around.unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    least = around.groupBy("node").agg(F.min("other").alias("low"))
    least = least.select("node", F.least("node", "low").alias("low"))
    linked = around.join(least, "node")
    if large:
        linked = linked.where("other > node").select(F.col("other").alias("a"), F.col("low").alias("b"))
    else:
        linked = linked.select(F.col("other").alias("a"), F.col("low").alias("b")).unionByName(
            least.select(F.col("node").alias("a"), F.col("low").alias("b"))
        )
    return linked.where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected edges (a, b); the smallest node names it."""
    spark = edges.sparkSession
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now, path = stage(edges.where("a != b").select(a, b).distinct(), "edges")
    size = state(now)
    while True:
        after, written = stage(star(star(now, large=True), large=False), "edges")
        drop(spark, path)
        now, path = after, written
        reached = state(now)
        if reached == size:
            break
        size = reached
    members = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionByName(roots)


def state(edges: DataFrame) -> tuple:
    """Count and a checksum: equal when the edges are."""
    return tuple(
        edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )
