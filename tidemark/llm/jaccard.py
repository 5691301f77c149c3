"""Set-similarity join on word shingles by token-combination prefixes.

A text is the set of its distinct 5-word shingles. Two texts link when
100 * intersection >= 75 * union, so a text of n shingles lacks at most
t = n - ceil(0.75 n) of them in a linked one. Shingles have one global order:
rare ones first, then frequent ones, by hash inside. A prefix is long enough
when no t missing shingles can spoil it: rare shingles are a class that is
indexed one by one; frequent ones fall into small classes that are indexed by
pairs, where c shingles survive c - 1 losses, so the prefix is extended until
the classes together survive t losses. Any two linked texts then share a rare
shingle or a pair of one frequent class in their prefixes. Where there are
rare shingles enough, the prefix is extended by some more, and linked texts
share as many as it has beyond t: a pair that shares fewer is not verified.

Which shingles are frequent is read from a table of counts over all texts,
hashed to ``width`` counters; a collision can only move a shingle to the
frequent classes, which costs time, not links. The number of frequent classes
follows the power of two below the smaller text of a pair, and a text whose
partners may lie on either side of one is indexed for both.

Equal sets are one node. Inside a key, nodes are first verified against the
key's smallest node, and components are formed; then every pair of nodes that
shares a key but no component is verified too, filtered by size and by a
parity bitmap whose differing bits are a lower bound of the sets' difference.
So all links between components are found, and nothing is paired that is
already connected.

Defined results: a text of fewer than five words is one shingle, its whole
sequence; without words (null, empty) there is no shingle, and no link; rows
without a doc_id link with nothing and have no component; repeated rows each
give a row; without documents the result is empty.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import (
    GRAM_BASE,
    SPACED,
    Texts,
    Words,
    bit_table,
    blocks,
    drop,
    keyed,
    mixed,
    passing,
    stage,
    without,
)
from tidemark.llm.components import components

SHINGLE = 5
# for texts whose prefix reaches into the frequent classes
ANY = 2**31 - 1
LANES = 4  # of 64 parity bits


@dataclasses.dataclass(frozen=True)
class Join:
    """percent: least similarity; width: counters of the frequency table (4 bytes each);
    class_size: shingles of a text in one frequent class, about; extend: a prefix has up to
    1 / extend of a text's shingles more than it needs."""

    percent: int = 75
    width: int = 1 << 18
    class_size: int = 8
    extend: int = 8


class Sets:
    """Distinct shingles of each row of a block, in the global order; words per row."""

    def __init__(self, texts: Texts, frequent=None):
        words = Words(texts, SPACED)
        hashes, first = words.grams(SHINGLE)
        rows = words.rows()[first]
        self.words = counts = np.diff(words.first)
        short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
        if len(short):
            whole = np.zeros(len(short), np.uint64)
            for j in range(SHINGLE - 1):  # their words in turn, 0 past the last
                at = words.first[short] + j
                there = j < counts[short]
                whole = whole * GRAM_BASE + np.where(there, words.hash[np.where(there, at, 0)], np.uint64(0))
            hashes = np.concatenate([hashes, mixed(whole + counts[short].astype(np.uint64))])
            rows = np.concatenate([rows, short])
        # the top bit of the sort key is the class
        key = hashes >> np.uint64(1)
        if frequent is not None:
            key |= frequent[(hashes & np.uint64(len(frequent) - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(63)
        order = np.lexsort((key, rows))
        rows, key, hashes = rows[order], key[order], hashes[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (key[1:] != key[:-1])
        self.rows, self.hash = rows[new], hashes[new]
        self.often = (key[new] >> np.uint64(63)).astype(bool)
        self.first = np.searchsorted(self.rows, np.arange(len(texts) + 1))

    def sizes(self) -> np.ndarray:
        return np.diff(self.first)

    def totals(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
        return total[self.first[1:]] - total[self.first[:-1]]

    def nodes(self) -> np.ndarray:
        """A hash of each set."""
        return mixed(self.totals(mixed(self.hash ^ np.uint64(0xA24BAED4963EE407))) + self.sizes().astype(np.uint64))

    def parities(self) -> list[np.ndarray]:
        """Bits that an odd number of the row's shingles hash to, ``LANES`` words."""
        bit = np.uint64(1) << ((self.hash >> np.uint64(8)) & np.uint64(63))
        lane = (self.hash >> np.uint64(14)) & np.uint64(LANES - 1)
        out = []
        for i in range(LANES):
            run = np.concatenate([np.zeros(1, np.uint64), np.bitwise_xor.accumulate(np.where(lane == i, bit, np.uint64(0)))])
            out.append((run[self.first[1:]] ^ run[self.first[:-1]]).view(np.int64))
        return out


MEASURED = "doc_id bigint, text_hash bigint, n_shingles bigint, node bigint, " + ", ".join(
    f"b{i} bigint" for i in range(LANES)
) + ", counts binary"


def measured(rows: DataFrame, join: Join) -> DataFrame:
    """Size, node and parity bits of each row; a task's last row holds its counters."""

    def run(batches):
        counters = np.zeros(join.width, np.int64)
        schema = None
        for batch in batches:
            sizes, nodes, lanes = [], [], [[] for _ in range(LANES)]
            for _, texts in blocks(batch.column("text")):
                sets = Sets(texts)
                sizes.append(sets.sizes())
                nodes.append(sets.nodes().view(np.int64))
                for lane, bits in zip(lanes, sets.parities()):
                    lane.append(bits)
                place = (sets.hash & np.uint64(join.width - 1)).astype(np.int64)
                counters += np.bincount(place, minlength=join.width)
            columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (sizes, nodes, *lanes)]
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    *[pa.array(c, pa.int64()) for c in columns],
                    pa.nulls(batch.num_rows, pa.binary()),
                ],
                ["doc_id", "text_hash", "n_shingles", "node", *(f"b{i}" for i in range(LANES)), "counts"],
            )
            schema = out.schema
            yield out
        if schema is not None:
            last = dict.fromkeys(schema.names) | {"counts": counters.tobytes()}
            yield pa.RecordBatch.from_pylist([last], schema=schema)

    return rows.mapInArrow(run, MEASURED)


def frequent(counts: DataFrame, join: Join) -> np.ndarray:
    """Which counters stand out of the mean, from every task's counters."""

    def run(batches):
        total = np.zeros(join.width, np.int64)
        for batch in batches:
            for value in batch.column("counts"):
                total += np.frombuffer(value.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["counts"])

    total = np.zeros(join.width, np.int64)
    for r in counts.select("counts").repartition(8).mapInArrow(run, "counts binary").toLocalIterator():
        total += np.frombuffer(r.counts, np.int64)  # eight rows of ``width`` counters
    mean = total.mean()
    return total > mean + 6 * np.sqrt(mean) + 32


def most_missing(n: int, percent: int) -> int:
    """Shingles of n that a linked text may lack."""
    return n - -(-n * percent // 100)


def pair_keys(often: np.ndarray, need: int, classes: int, level: int) -> np.ndarray:
    """Keys of all pairs inside the classes of the shortest prefix that survives need - 1 losses."""
    at = (mixed(often) % np.uint64(classes)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    grouped = at[order]
    starts = np.flatnonzero(np.append(True, grouped[1:] != grouped[:-1]))
    rank = np.empty(len(often), np.int64)  # of each shingle inside its class, in prefix order
    rank[order] = np.arange(len(often)) - np.repeat(starts, np.diff(np.append(starts, len(often))))
    survived = np.cumsum(rank > 0)
    if not len(survived) or survived[-1] < need:
        raise AssertionError("a set survives its own losses")  # see most_missing()
    upto = int(np.searchsorted(survived, need)) + 1
    out = []
    for c in np.unique(at[:upto]):
        members = often[:upto][at[:upto] == c]
        i, j = np.triu_indices(len(members), 1)
        out.append(mixed(members[i] * np.uint64(0x9E3779B97F4A7C15) + members[j] + np.uint64(level)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def prefix_keys(sets: Sets, join: Join) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, whether it is a pair of frequent shingles) of the prefixes of a block,
    and by row how many keys a linked text shares at least (ANY: one, of either kind)."""
    sizes = sets.sizes()
    need = sizes - -(-sizes * join.percent // 100) + 1  # losses to survive, and one
    rare = np.bincount(sets.rows, ~sets.often, len(sizes)).astype(np.int64)
    upto = np.minimum(need + sizes // join.extend, rare)
    least = np.where(rare >= need, upto - need + 1, ANY)
    rank = np.arange(len(sets.rows)) - sets.first[sets.rows]
    single = ~sets.often & (rank < upto[sets.rows]) & (sizes[sets.rows] > 1)
    keys, rows, paired = [sets.hash[single]], [sets.rows[single]], [np.zeros(single.sum(), bool)]
    for row in np.flatnonzero((rare < need) & (sizes > 1)):
        n = int(sizes[row])
        often = sets.hash[sets.first[row] + rare[row] : sets.first[row + 1]]
        level = n.bit_length() - 1
        # partners of at least percent * n shingles may lie below the power of two
        levels = [level] + [level - 1] * (-(-n * join.percent // 100) < 1 << level)
        for one in levels:
            found = pair_keys(often, int(need[row] - rare[row]), max(1, (1 << one) // join.class_size), one)
            keys.append(found)
            rows.append(np.full(len(found), row))
            paired.append(np.ones(len(found), bool))
    return np.concatenate(keys), np.concatenate(rows), np.concatenate(paired), least


KEYS = "key bigint, node bigint, paired boolean, least int"


def indexed(rows: DataFrame, table, join: Join) -> DataFrame:
    """(key, node, paired, least) of every text's prefix, copies in a block once."""

    def run(batches):
        often = table.value
        for batch in batches:
            for _, texts in blocks(batch.column("text")):
                sets = Sets(texts, often)
                keys, row, paired, least = prefix_keys(sets, join)
                nodes = sets.nodes()
                first = np.unique(nodes, return_index=True)[1]
                once = np.isin(row, first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[once].view(np.int64), pa.int64()),
                        pa.array(nodes[row[once]].view(np.int64), pa.int64()),
                        pa.array(paired[once], pa.bool_()),
                        pa.array(least[row[once]], pa.int32()),
                    ],
                    ["key", "node", "paired", "least"],
                )

    return rows.mapInArrow(run, KEYS)


def shared_keys(keys: DataFrame) -> DataFrame:
    """(key, node, least, leader) of the keys that two nodes or more share; leader is the smallest."""
    # few texts share a rare shingle: one shuffle and a window
    of = Window.partitionBy("key")
    rare = (
        keys.where("not paired")
        .select(
            "key", "node", "least", F.min("node").over(of).alias("leader"), F.max("node").over(of).alias("last")
        )
        .where("leader != last")
        .select("key", "node", "least", "leader")
        .distinct()
    )
    # any number may share a frequent pair: grouped before the shuffle, joined where skew is split
    often = keys.where("paired").select("key", "node", "least")
    leaders = often.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last"))
    often = often.distinct().join(leaders.where("leader != last").select("key", "leader"), "key")
    return rare.unionByName(often)


BITS = [f"b{i}" for i in range(LANES)]


def side(classes: DataFrame, name: str) -> DataFrame:
    """The nodes as ``name`` with their size and parity bits."""
    return classes.select(F.col("node").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("n", *BITS)])


def allowed(percent: int) -> Column:
    """Whether sizes and parity bits of a and b allow a link."""
    differ = F.lit(0)
    for bits in BITS:
        differ = differ + F.bit_count(F.col(f"a_{bits}").bitwiseXOR(F.col(f"b_{bits}")))
    both = F.col("a_n") + F.col("b_n")
    # |difference| = both - 2 |intersection|, and |intersection| >= percent / (100 + percent) * both
    return (differ * (100 + percent) <= both * (100 - percent)) & (
        F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent
    )


def plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and parity bits allow a link."""
    both = pairs.join(side(classes, "a"), "a").join(side(classes, "b"), "b")
    return both.where(allowed(percent)).select("a", "b")


def sets_of(rows: DataFrame, table) -> DataFrame:
    """(node, set) of the texts whose node passes the table; sorted 8-byte hashes."""

    def run(batches):
        bits = table.value
        for batch in batches:
            nodes, found = [], []
            seen = set()
            for _, texts in blocks(batch.column("text")):
                sets = Sets(texts)
                all_nodes = sets.nodes()
                for row in np.flatnonzero(passing(all_nodes, bits) & (sets.sizes() > 0)):
                    node = int(all_nodes[row].view(np.int64))
                    if node not in seen:
                        seen.add(node)
                        nodes.append(node)
                        found.append(np.sort(sets.hash[sets.first[row] : sets.first[row + 1]]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(found, pa.binary())], ["node", "set"]
            )

    # the pairs are joined with one copy of each set
    return rows.mapInArrow(run, "node bigint, set binary").groupBy("node").agg(F.first("set").alias("set"))


def verified(rows: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets, as a stage."""
    spark = rows.sparkSession
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    table = spark.sparkContext.broadcast(bit_table(wanted, "node"))
    sets, at = stage(sets_of(rows, table), "sets")

    def run(batches):
        for batch in batches:
            keep = []
            for one, other in zip(batch.column("a_set"), batch.column("b_set")):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (one, other))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("node").alias("a"), F.col("set").alias("a_set"))
    other = sets.select(F.col("node").alias("b"), F.col("set").alias("b_set"))
    joined = pairs.join(one, "a").join(other, "b").select("a", "b", "a_set", "b_set")
    links, _ = stage(joined.mapInArrow(run, "a bigint, b bigint"), "links")
    drop(spark, at)
    return links


def led(shared: DataFrame) -> DataFrame:
    """(key, node, least, leader): each key is led by its node that meets most others.

    In a group of near copies that is the text they derive from: the copies are
    alike through it, and hardly ever through an arbitrary member.
    """
    sizes = shared.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    weights = shared.select("key", "node").join(sizes, "key").groupBy("node").agg(F.sum("size").alias("weight"))
    weighed = shared.join(weights, "node")
    leaders = weighed.groupBy("key").agg(F.max(F.struct("weight", "node")).getField("node").alias("leader"))
    return shared.select("key", "node", "least").join(leaders, "key")


def connected(rows: DataFrame, classes: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """(node, component) of the nodes that link, from the candidates (key, node, leader).

    ``rows`` holds the texts, ``classes`` each node's size and parity bits.
    """
    # first the leaders of keys, where they share many; whatever is still apart comes next
    near = led(shared).where("node != leader").groupBy(F.col("leader").alias("a"), F.col("node").alias("b"))
    near = near.agg(F.count(F.lit(1)).alias("keys"), F.min("least").alias("least"))
    near = near.where((F.col("least") == ANY) | (F.col("keys") * 2 >= F.col("least"))).select("a", "b")
    near, _ = stage(plausible(near, classes, percent), "pairs")
    edges = verified(rows, near, percent)
    grouped, _ = stage(components(edges), "components")
    known = shared.select("key", "node", "least").join(grouped, "node", "left")
    known = known.select("key", "node", "least", F.coalesce("component", "node").alias("component"))
    known = known.join(classes.select("node", "n", *BITS), "node")
    apart = (
        known.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low != high")
        .select("key")
    )
    known, known_at = stage(known.join(apart, "key", "left_semi"), "apart")
    left, right = (
        known.select(
            "key",
            F.col("node").alias(name),
            *[F.col(c).alias(f"{name}_{c}") for c in ("component", "least", "n", *BITS)],
        )
        for name in ("a", "b")
    )
    # a condition of the join: nothing else is made into a row
    met = left.join(right, "key").where(F.expr("a < b and a_component != b_component") & allowed(percent))
    # every key that two nodes of different components share is still here, so all are counted
    rest = met.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("keys"), F.min(F.least("a_least", "b_least")).alias("least")
    )
    rest = rest.where((F.col("least") == ANY) | (F.col("keys") >= F.col("least"))).select("a", "b")
    rest = rest.join(
        near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"
    )
    rest, _ = stage(rest, "pairs")
    drop(rows.sparkSession, known_at)
    if rest.isEmpty():
        return grouped
    more = verified(rows, rest, percent)
    if more.isEmpty():
        return grouped
    return stage(components(edges.unionByName(more)), "components")[0]


def similar(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """doc_id, n_shingles, component_id, text_hash of each document."""
    spark = docs.sparkSession
    rows = keyed(docs)
    met, met_at = stage(measured(rows, join), "measured")
    often = spark.sparkContext.broadcast(frequent(met.where("counts is not null"), join))
    met = met.where("counts is null").drop("counts")
    classes, _ = stage(
        met.where("n_shingles > 0 and doc_id is not null")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("least"),
            F.first("n_shingles").alias("n"),
            *[F.first(f"b{i}").alias(f"b{i}") for i in range(LANES)],
        ),
        "classes",
    )
    placed = rows.where("doc_id is not null")
    shared, shared_at = stage(shared_keys(indexed(placed, often, join)), "shared")

    grouped = connected(placed, classes, shared, join.percent)
    drop(spark, shared_at)
    # the smallest doc_id of each component
    labelled = classes.select("node", "least").join(grouped, "node", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "node"))
    names = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    labelled = labelled.select("node", "component").join(names, "component").select("node", "component_id")
    return met.join(labelled, "node", "left").select(
        "doc_id",
        "n_shingles",
        F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id"))
        .otherwise(F.col("doc_id"))
        .alias("component_id"),
        "text_hash",
    )


def one_of_each(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """The documents without those that have a smaller doc_id in their component.

    Rows that repeat a doc_id and its text stay once.
    """
    gone = similar(docs, join).where("component_id != doc_id").select("doc_id", "text_hash")
    kept = without(docs, gone)
    seen = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if seen.where("n > 1").isEmpty():
        return kept
    named = kept.where("doc_id is not null").dropDuplicates(["doc_id", "text"])
    return named.unionByName(kept.where("doc_id is null"))
