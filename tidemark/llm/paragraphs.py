"""Paragraph dedup by MinHash banding, verified and clustered.

A paragraph is a line of a text, or a run of lines: consecutive lines that
have words, fewer than ``wrapped_words`` each, joined to one paragraph if they
have as many together, so a passage is met in whatever way it is wrapped.
Lines of ``least_words`` words or more (a whole shingle) and all runs are
compared as sets of 5-word shingles. Each set gets ``bands * rows`` minima of
random linear hashes; sets that agree in a whole band collide. Rows and bands
are chosen from the least similarity so that a pair just at it collides with
probability ``recall``; more similar pairs collide more often. Colliding
paragraphs are joined and verified by exact Jaccard similarity, links are
closed to clusters by connected components, and of each cluster all but the
first paragraph (smallest doc_id, then position) are removed, a run with all
its lines. A paragraph is never a copy of one that it overlaps.

Equal sets are one node and a key's members are verified against its smallest
first, so a passage that a third of all documents share is not paired out.

Defined results: null or empty texts have no paragraph; paragraphs below
``least_words`` stay; rows without a doc_id are compared with nothing and
stay whole; repeated rows are documents of their own, of which the first in
the table's order keeps the passage; without documents the result is empty.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import blocks, drop, mixed, stage
from tidemark.llm.jaccard import KEYS, LANES, Sets, connected, shared_keys


@dataclasses.dataclass(frozen=True)
class Banding:
    percent: int = 75
    recall: float = 0.9995
    most_hashes: int = 64
    least_words: int = 5
    wrapped_words: int = 25
    seed: int = 11

    def shape(self) -> tuple[int, int]:
        """(bands, rows): the most rows for which the recall is reached."""
        s, best = self.percent / 100, None
        for rows in range(1, 16):
            hit = s**rows
            bands = max(1, int(np.ceil(np.log(1 - self.recall) / np.log(1 - hit)))) if hit < 1 else 1
            if bands * rows <= self.most_hashes:
                best = bands, rows
        if best is None:
            raise ValueError("most_hashes is too small for the recall")
        return best


def cut(text: str | None, banding: Banding) -> tuple[int, list[tuple[int, int, str]]]:
    """The number of lines, and (first line, lines, text) of the paragraphs to compare."""
    if not text:
        return 0, []
    lines = text.split("\n")
    words = [len(line.encode().split()) for line in lines]  # bytes split at ASCII white space only
    out = [(i, 1, line) for i, line in enumerate(lines) if words[i] >= banding.least_words]
    first = 0
    for i in range(len(lines) + 1):
        if i < len(lines) and 0 < words[i] < banding.wrapped_words:
            continue
        if i - first > 1 and sum(words[first:i]) >= banding.wrapped_words:
            out.append((first, i - first, " ".join(lines[first:i])))
        first = i + 1
    return len(lines), out


def paragraphs(docs: DataFrame, banding: Banding) -> DataFrame:
    """(text) of every paragraph of every document that is compared."""

    def run(batches):
        for batch in batches:
            for value in batch.column("text"):
                texts = [t for _, _, t in cut(value.as_py(), banding)[1]]
                if texts:
                    yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "text string")


PARAGRAPH = pa.struct(
    [("part", pa.int32()), ("lines", pa.int32()), ("n", pa.int64()), ("node", pa.int64())] + [(f"b{i}", pa.int64()) for i in range(LANES)]
)
MEASURED = "doc_id bigint, n_paragraphs bigint, long array<struct<part:int,lines:int,n:bigint,node:bigint," + (
    ",".join(f"b{i}:bigint" for i in range(LANES)) + ">>"
)


def measured(docs: DataFrame, banding: Banding) -> DataFrame:
    """Of each document its number of lines, and size, node and parity bits of its paragraphs."""

    def run(batches):
        for batch in batches:
            counts, found, units = [], [], []
            for doc, value in enumerate(batch.column("text")):
                n, own = cut(value.as_py(), banding)
                counts.append(n)
                found.append([])
                units += [(doc, *unit) for unit in own]
            for base, texts in blocks(pa.array([u[3] for u in units], pa.string())):
                sets = Sets(texts)
                sizes, nodes, lanes = sets.sizes(), sets.nodes().view(np.int64), sets.parities()
                for i in range(len(texts)):
                    doc, part, lines, _ = units[base + i]
                    row = {"part": part, "lines": lines, "n": int(sizes[i]), "node": int(nodes[i])}
                    found[doc].append(row | {f"b{k}": int(lane[i]) for k, lane in enumerate(lanes)})
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, pa.list_(PARAGRAPH))],
                ["doc_id", "n_paragraphs", "long"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, MEASURED)


def minima(sets: Sets, rows: np.ndarray, banding: Banding) -> np.ndarray:
    """The minima of each hash (rows of the result) over the given sets (its columns)."""
    bands, per = banding.shape()
    rng = np.random.default_rng(banding.seed)
    factors = rng.integers(0, 2**63, bands * per, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 2**63, bands * per, dtype=np.uint64)
    inside = np.isin(sets.rows, rows)
    hashes = sets.hash[inside]
    starts = np.searchsorted(sets.rows[inside], rows)
    return np.stack([np.minimum.reduceat(hashes * f + s, starts) for f, s in zip(factors, shifts)])


def band_keys(texts: DataFrame, banding: Banding) -> DataFrame:
    """(key, node, paired, least) of every paragraph's bands, once per task and node."""
    bands, per = banding.shape()

    def run(batches):
        seen = set()
        for batch in batches:
            for _, block in blocks(batch.column("text")):
                sets = Sets(block)
                nodes = sets.nodes().view(np.int64)
                new = []
                for row in np.flatnonzero(sets.words >= banding.least_words).tolist():
                    if (node := int(nodes[row])) not in seen:
                        seen.add(node)
                        new.append(row)
                if not new:
                    continue
                rows = np.array(new)
                low = minima(sets, rows, banding)
                keys = []
                for band in range(bands):
                    key = np.full(len(rows), np.uint64(band + 1))
                    for i in range(per):
                        key = mixed(key ^ low[band * per + i]) + np.uint64(i)
                    keys.append(key)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(keys).view(np.int64), pa.int64()),
                        pa.array(np.tile(nodes[rows], bands), pa.int64()),
                        pa.array(np.ones(len(rows) * bands, bool), pa.bool_()),
                        pa.array(np.ones(len(rows) * bands, np.int32), pa.int32()),
                    ],
                    ["key", "node", "paired", "least"],
                )

    return texts.select("text").mapInArrow(run, KEYS)


def clustered(docs: DataFrame, banding: Banding = Banding()):
    """((row, doc_id, n_paragraphs, long), (row, part, lines, gone, kept_by) of clustered paragraphs)."""
    spark = docs.sparkSession
    rows, _ = stage(
        measured(docs, banding).withColumn("row", F.monotonically_increasing_id()), "paragraphs"
    )
    long = rows.where("doc_id is not null").select("row", "doc_id", F.explode("long").alias("p")).select("row", "doc_id", "p.*")
    classes = long.groupBy("node").agg(
        F.first("n").alias("n"), *[F.first(f"b{i}").alias(f"b{i}") for i in range(LANES)]
    )
    classes, _ = stage(classes, "classes")
    lines = paragraphs(docs.where("doc_id is not null"), banding)
    shared, at = stage(shared_keys(band_keys(lines, banding)), "shared")
    grouped = connected(lines, classes, shared, banding.percent)
    drop(spark, at)
    placed = long.select("row", "doc_id", "part", "lines", "node").join(grouped, "node", "left")
    placed = placed.select("row", "doc_id", "part", "lines", F.coalesce("component", "node").alias("component"))
    heads = placed.groupBy("component").agg(
        F.min(F.struct("doc_id", "row", "part", "lines")).alias("head"),
        F.max(F.struct("doc_id", "row", "part", "lines")).alias("last"),
    )
    # paragraphs are sorted by their first line: if the last one overlaps the head, all do
    heads = heads.where(
        (F.col("last.row") != F.col("head.row")) | (F.col("last.part") >= F.col("head.part") + F.col("head.lines"))
    ).select("component", "head")
    met = placed.join(heads, "component").select(
        "row",
        "part",
        "lines",
        ((F.col("row") != F.col("head.row")) | (F.col("part") >= F.col("head.part") + F.col("head.lines"))).alias("gone"),
        F.col("head.doc_id").alias("kept_by"),
    )
    return rows, met


def deduplicated(docs: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """doc_id, n_paragraphs, n_long, n_repeated, n_removed, kept_by of each document.

    ``n_repeated`` counts lines in clusters, by themselves or in a run, ``n_removed``
    those of them that go; ``n_long`` counts lines that are compared by themselves; ``kept_by`` lists the documents that keep their clusters' first
    paragraph, the document itself included where it does; ``removed`` lists
    the positions of the lines that go.
    """
    rows, met = clustered(docs, banding)
    line = F.explode(F.sequence("part", F.expr("part + lines - 1"))).alias("part")
    lines = met.select("row", line, "gone").groupBy("row", "part").agg(F.max("gone").alias("gone"))
    found = lines.groupBy("row").agg(
        F.count(F.lit(1)).alias("n_repeated"),
        F.count_if("gone").alias("n_removed"),
        F.sort_array(F.collect_list(F.when(F.col("gone"), F.col("part")))).alias("removed"),
    )
    keepers = met.groupBy("row").agg(F.sort_array(F.collect_set("kept_by")).alias("kept_by"))
    found = found.join(keepers, "row")
    zero = F.lit(0).cast("long")
    return rows.join(found, "row", "left").select(
        "doc_id",
        "n_paragraphs",
        F.size(F.filter("long", lambda p: p["lines"] == 1)).cast("long").alias("n_long"),
        F.coalesce("n_repeated", zero).alias("n_repeated"),
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("kept_by", F.array().cast("array<bigint>")).alias("kept_by"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )


def without_lines(text, removed):
    """Column: the text without the lines at the given positions."""
    return F.array_join(
        F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains(removed, i.cast("int"))), "\n"
    )
