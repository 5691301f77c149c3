"""Nearest neighbours by inner product through a permutation index.

Pivots are vectors of a bounded sample that lie far apart. A vector is
represented by its pivots in order of nearness, cut after ``posted`` pivots;
each block of vectors keeps one inverted file per pivot that lists the vectors
which hold it and the pivot's place in their order. A query reads the files of
its ``probed`` nearest pivots, sums the footrule distance (difference of
places, ``posted`` where a pivot is absent), and the nearest ``share`` of the
block, ``least`` vectors at least, is ranked again by the exact inner product.

Nearness to a pivot is cosine after each vector got one more component that
brings all to the same length, so that an order of pivots tells inner products
and not angles alone. It is zero for vectors of one length.

Work is dealt as (block of vectors, part of the queries): both have a bounded
number of rows, so a task holds one block and one part. Every vector is in the
index. Equal vectors are one node, which keeps its ``neighbours + 1`` smallest
ids: no other copy can be among the nearest of any query, so nothing is lost
and a vector with a third of all rows is one row.

Defined results: vectors that are null, zero, or hold a null or a component
that is not finite take no part, neither do rows without an id, nor vectors
of another length than the commonest one (the longest of the commonest). Rows
repeated with the same id and vector count once; a query's own id is never
its neighbour. Without queries or candidates the result is empty. Only vec_id
and embedding are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import drop, stage

PERMUTED = "block int, node bigint, vector array<double>, places binary"
FILES = "block int, pivot int, members binary, places binary"
FOUND = "query_node bigint, node bigint, score double"
VECTORS = -1  # the row of a block that holds its node ids and vectors


def points(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part, each once."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    ).where(
        "vec_id is not null and vector is not null"
        " and forall(vector, x -> x is not null and abs(x) < double('infinity'))"
        " and exists(vector, x -> x != 0)"
    )
    commonest = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("vector") == (commonest["n"] if commonest else 0)).distinct()


def nodes_of(rows: DataFrame, keep: int) -> DataFrame:
    """(node, vector, ids): different vectors with their ``keep`` smallest ids."""
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    least = rows.withColumn("place", place).where(F.col("place") <= keep)
    grouped = least.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return grouped.select(F.monotonically_increasing_id().alias("node"), "vector", "ids")


def lifted(matrix: np.ndarray, length: float) -> np.ndarray:
    """Vectors with one more component that gives all the same length."""
    rest = np.maximum(length * length - (matrix * matrix).sum(1), 0)
    return np.hstack([matrix, np.sqrt(rest)[:, None]])


def chosen_pivots(nodes: DataFrame, pivots: int, sample: int, length: float) -> np.ndarray:
    """Vectors of a sample of at most ``sample`` nodes, each far from those before it."""
    rows = nodes.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(sample).collect()
    pool = lifted(np.array([r.vector for r in rows]), length)
    taken = [0]
    nearest = pool @ pool[0]
    while len(taken) < min(pivots, len(pool)):
        taken.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, pool @ pool[taken[-1]])
        nearest[taken] = np.inf
    return pool[taken]


def orders(near: np.ndarray, upto: int) -> np.ndarray:
    """For each row the columns of its ``upto`` largest values, largest first."""
    return np.argsort(-near, axis=1, kind="stable")[:, :upto]


def matrix_of(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def permuted(pivots: np.ndarray, upto: int, length: float | None):
    """Rows (block, node, vector) to PERMUTED; ``places`` holds the pivots in order."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = matrix_of(batch.column("vector"))
            # a query has no length of its own: its order is that of inner products
            full = lifted(rows, length) if length is not None else np.hstack([rows, np.zeros((len(rows), 1))])
            order = orders(full @ pivots.T, upto).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("block", "node", "vector")), pa.array([o.tobytes() for o in order])],
                ["block", "node", "vector", "places"],
            )

    return run


def inverted(block: pa.Table) -> pa.Table:
    """One block of PERMUTED rows to its inverted files, and a row with its vectors."""
    node = block.column("node").to_numpy()
    turn = np.argsort(node)
    order = np.array([np.frombuffer(p.as_py(), np.uint16) for p in block.column("places")])[turn]
    rows = matrix_of(block.column("vector"))[turn]
    pivot, member = order.ravel(), np.repeat(np.arange(len(order), dtype=np.int32), order.shape[1])
    place = np.tile(np.arange(order.shape[1], dtype=np.uint16), len(order))
    by = np.argsort(pivot, kind="stable")
    pivot, member, place = pivot[by], member[by], place[by]
    names, first = np.unique(pivot, return_index=True)
    bounds = np.append(first, len(pivot))
    number = block.column("block")[0].as_py()
    files = [(number, VECTORS, node[turn].tobytes(), rows.tobytes())]
    for i, name in enumerate(names):
        part = slice(bounds[i], bounds[i + 1])
        files.append((number, int(name), member[part].tobytes(), place[part].tobytes()))
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.Table.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*files), kinds)], ["block", "pivot", "members", "places"]
    )


def finder(posted: int, share: float, least: int, keep: int):
    """(files of a block, part of the queries) to the ``keep`` nearest of each query."""

    def run(files: pa.Table, queries: pa.Table) -> pa.Table:
        out = [], [], []
        if files.num_rows and queries.num_rows:
            lists = {}
            for pivot, members, places in zip(*(files.column(c).to_pylist() for c in ("pivot", "members", "places"))):
                if pivot == VECTORS:
                    node = np.frombuffer(members, np.int64)
                    rows = np.frombuffer(places, np.float64).reshape(len(node), -1)
                else:
                    lists[pivot] = np.frombuffer(members, np.int32), np.frombuffer(places, np.uint16).astype(np.int32)
            again = min(len(node), max(least, keep, int(np.ceil(share * len(node)))))
            asked = matrix_of(queries.column("vector"))
            footrule = np.empty(len(node), np.int32)
            for at, places in enumerate(queries.column("places").to_pylist()):
                probed = np.frombuffer(places, np.uint16)
                footrule[:] = posted * len(probed)
                for j, pivot in enumerate(probed.tolist()):
                    if pivot in lists:
                        members, place = lists[pivot]
                        footrule[members] += np.abs(place - j) - posted
                near = np.argpartition(footrule, again - 1)[:again] if again < len(node) else np.arange(len(node))
                score = (rows[near] * asked[at]).sum(1)
                # ties at the last place stay; the ranking that follows decides them
                cut = np.partition(score, -keep)[-keep] if len(score) > keep else -np.inf
                best = near[score >= cut]
                out[0].append(np.full(len(best), queries.column("node")[at].as_py(), np.int64))
                out[1].append(node[best])
                out[2].append(score[score >= cut])
        parts = [np.concatenate(o) if o else np.zeros(0, t) for o, t in zip(out, (np.int64, np.int64, np.float64))]
        return pa.Table.from_arrays([pa.array(p) for p in parts], ["query_node", "node", "score"])

    return run


def search(
    vectors: DataFrame,
    asked: str = "vec_id % 20 = 0",
    neighbours: int = 20,
    pivots: int = 192,
    posted: int = 96,
    probed: int = 48,
    share: float = 0.12,
    least: int = 256,
    sample: int = 2048,
    block_rows: int = 8192,
    query_rows: int = 512,
) -> DataFrame:
    """query_id, rank, vec_id, score of the nearest found of each row that ``asked`` holds for."""
    spark = vectors.sparkSession
    keep = neighbours + 1
    rows = points(vectors)
    nodes, nodes_at = stage(nodes_of(rows, keep), "nodes")
    square = F.expr("aggregate(vector, 0D, (s, x) -> s + x * x)")
    size = nodes.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.max(square)).alias("length")).first()
    if not size.n:
        drop(spark, nodes_at)
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    table = chosen_pivots(nodes, pivots, sample, size.length)
    posted, probed = min(posted, len(table)), min(probed, len(table))

    n_blocks = -(-size.n // block_rows)
    block = F.pmod(F.xxhash64("node"), F.lit(n_blocks)).cast("int").alias("block")
    held = nodes.select(block, "node", "vector").mapInArrow(permuted(table, posted, size.length), PERMUTED)
    index, index_at = stage(held.groupBy("block").applyInArrow(inverted, FILES), "inverted")

    queries, queries_at = stage(
        rows.where(asked).join(nodes.select("node", "vector"), "vector").select(F.col("vec_id").alias("query_id"), "node"),
        "queries",
    )
    asking = queries.select("node").distinct().join(nodes.select("node", "vector"), "node")
    parts = max(1, -(-queries.count() // query_rows))
    part = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(parts)).cast("int").alias("part")
    asking = asking.select(F.lit(0).alias("block"), "node", "vector").mapInArrow(permuted(table, probed, None), PERMUTED)
    asking = asking.select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), part, "node", "vector", "places")
    files = index.select("block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "pivot", "members", "places")
    found = (
        files.groupBy("block", "part")
        .cogroup(asking.groupBy("block", "part"))
        .applyInArrow(finder(posted, share, least, keep), FOUND)
    )

    # the nearest nodes of each query node; a tie goes to the node with the smallest id
    ids = nodes.select("node", "ids")
    first = found.join(nodes.select("node", F.col("ids")[0].alias("first")), "node")
    order = Window.partitionBy("query_node").orderBy(F.desc("score"), "first", "node")
    near = first.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)
    near = near.select("query_node", "node", "score").join(ids, "node")
    near = near.select("query_node", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query_node").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= 2 * keep)
    lists = near.groupBy("query_node").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("near"))
    others = F.expr(f"slice(filter(near, x -> x.vec_id != query_id), 1, {neighbours})")
    done = queries.join(lists, queries["node"] == lists["query_node"]).select("query_id", F.posexplode(others))
    result, _ = stage(
        done.select(
            "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.vec_id"), F.col("col.score")
        ),
        "nearest",
    )
    drop(spark, nodes_at, index_at, queries_at)
    return result
