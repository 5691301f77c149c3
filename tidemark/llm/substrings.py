"""Exact substring dedup over sampled suffixes, ordered by deep-shallow sorting.

Every byte that a ``length``-byte string covers which also starts elsewhere is
removed. Sorting all suffixes would move ``length`` bytes per byte of text, so
suffixes are sampled by content: of every ``length``-byte string the place of
its smallest ``GRAM``-byte hash is an anchor. Equal strings have their anchor
at the same offset, so two occurrences always meet at an anchor.

1. Anchor hashes are counted; those that occur once cannot matter.
2. The other anchors are collected with what stands before (up to
   ``length - GRAM`` bytes) and from them on (``length`` bytes), grouped by
   hash, and ordered by deep-shallow suffix sorting on both sides; an anchor's
   extents with any other of its group that reach ``length`` bytes together
   are removed (``suffixes.extents``).
3. Groups of more than ``most_members`` anchors (a passage that a third of all
   documents share) are not sorted in one task: the ``length``-byte strings of
   their members are counted by digest over all tasks, and each task marks the
   strings that occur twice.

Texts that equal another whole text are removed whole and enter once per task.

Defined results: a null or empty text has nothing to remove; texts shorter
than ``length`` stay; repeated rows are copies of each other like any other
equal texts; rows without a doc_id take part and each give a row; without
documents the result is empty.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import GRAM_BASE, Texts, bit_table, blocks, drop, mixed, passing, stage
from tidemark.llm.suffixes import extents

GRAM = 96
BLOCK = 1 << 18
#: digests of repeated strings that tasks may hold in memory (16 bytes each)
MOST_HELD = 1 << 22


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each place on, by doubling."""
    at = {1: mixed(data.astype(np.uint64) + np.uint64(1))}
    size, base = 1, int(GRAM_BASE)
    while size < 64:
        one = at[size]
        at[2 * size] = one[:-size] * np.uint64(base) + one[size:] if len(one) > size else one[:0]
        if size != 32:
            del at[size]
        size, base = 2 * size, base * base % 2**64
    # 64 + 32
    wide, narrow = at[64], at[32]
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mixed(wide[:n] * np.uint64(0x8CB92BA72F3D8DD7) + narrow[64 : 64 + n])


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum, np.maximum) over every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        values = pick(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(texts: Texts, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place in the block, row) of the anchors of a block."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    width = length - GRAM + 1
    if len(texts.data) < length:
        return none
    hashes = gram_hashes(texts.data)
    least = sliding(hashes, width, np.minimum)
    # strings that start here stay inside one row
    starts = np.arange(len(least))
    row = np.searchsorted(texts.bounds, starts, "right") - 1
    least = np.where(starts + length <= texts.bounds[row + 1], least, np.uint64(0))
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    # the smallest of some string that holds it
    chosen = np.flatnonzero(sliding(padded, width, np.maximum) == hashes)
    chosen = chosen[hashes[chosen] > 0]
    return hashes[chosen], chosen, np.searchsorted(texts.bounds, chosen, "right") - 1


def text_rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def measured(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, n_bytes, sha (of the text) per document."""

    def run(batches):
        for batch in batches:
            sizes, shas = [], []
            for _, texts in blocks(batch.column("text")):
                view = memoryview(texts.data)
                for a, b in zip(texts.bounds.tolist(), texts.bounds[1:].tolist()):
                    sizes.append(b - a)
                    shas.append(hashlib.sha256(view[a:b]).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(shas, pa.binary())],
                ["doc_id", "n_bytes", "sha"],
            )

    return text_rows(docs).mapInArrow(run, "doc_id bigint, n_bytes bigint, sha binary")


def anchor_hashes(docs: DataFrame, length: int) -> DataFrame:
    """(hash, n): anchors by hash, summed per batch."""

    def run(batches):
        for batch in batches:
            found = [anchors(texts, length)[0] for _, texts in blocks(batch.column("text"), BLOCK)]
            hashes, counts = np.unique(np.concatenate(found), return_counts=True) if found else ([], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.asarray(hashes, np.uint64).view(np.int64), pa.int64()), pa.array(counts, pa.int32())],
                ["hash", "n"],
            )

    return text_rows(docs).select("text").mapInArrow(run, "hash bigint, n int")


def contexts(docs: DataFrame, table, length: int) -> DataFrame:
    """(hash, sha, at, before, bytes) of the anchors whose hash passes the table.

    ``bytes`` stands around the anchor at byte ``at`` of the text, ``before``
    of them before it. A text that was met in this task is not met again.
    """

    def run(batches):
        bits = table.value
        seen = set()
        for batch in batches:
            for _, texts in blocks(batch.column("text"), BLOCK):
                hashes, places, rows = anchors(texts, length)
                there = passing(hashes, bits)
                hashes, places, rows = hashes[there], places[there], rows[there]
                data = texts.data.tobytes()
                sha = {}
                for row in np.unique(rows).tolist():
                    digest = hashlib.sha256(data[texts.bounds[row] : texts.bounds[row + 1]]).digest()
                    if digest not in seen:
                        seen.add(digest)
                        sha[row] = digest
                low = np.maximum(places - (length - GRAM), texts.bounds[rows])
                high = np.minimum(places + length, texts.bounds[rows + 1])
                out = [
                    (h, sha[r], p - t, p - a, data[a:b])
                    for h, r, p, a, b, t in zip(
                        hashes.view(np.int64).tolist(),
                        rows.tolist(),
                        places.tolist(),
                        low.tolist(),
                        high.tolist(),
                        texts.bounds[rows].tolist(),
                    )
                    if r in sha
                ]
                columns = list(zip(*out)) or [()] * 5
                kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], ["hash", "sha", "at", "before", "bytes"]
                )

    return text_rows(docs).select("text").mapInArrow(run, CONTEXTS)


CONTEXTS = "hash bigint, sha binary, at bigint, before int, bytes binary"
SPANS = "sha binary, start bigint, end bigint"


def span_batch(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out)) or [()] * 3
    kinds = [pa.binary(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["sha", "start", "end"]
    )


def group_spans(group: list[tuple], length: int) -> list[tuple]:
    """Spans (sha, start, end) of one hash's anchors (sha, at, before, bytes)."""
    places: dict[tuple[bytes, int], set] = {}
    for sha, at, before, data in group:
        places.setdefault((data, before), set()).add((sha, at))
    if sum(map(len, places.values())) < 2:
        return []
    forms = list(places)
    left = [data[:before][::-1] for data, before in forms]
    right = [data[before:] for data, before in forms]
    reach = extents(left, right, length, 0) if len(forms) > 1 else [(0, 0)]
    out = []
    for (data, before), (back, ahead) in zip(forms, reach):
        met = places[data, before]
        if len(met) > 1 and len(data) >= length:
            back, ahead = before, len(data) - before
        if back + ahead:
            out += [(sha, at - back, at + ahead) for sha, at in met]
    return out


def sorted_spans(length: int):
    """Context rows in hash order to spans, one group in memory at a time."""

    def run(batches):
        key, group, out = None, [], []
        for batch in batches:
            for h, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if h != key:
                    out += group_spans(group, length)
                    key, group = h, []
                group.append(row)
            if len(out) > 10_000:
                yield span_batch(out)
                out = []
        out += group_spans(group, length)
        yield span_batch(out)

    return run


def strings_of(batch: pa.RecordBatch, length: int):
    """(sha, start in the text, string) of every string around each row's anchor."""
    for _, sha, at, before, data in zip(*(c.to_pylist() for c in batch.columns)):
        for a in range(max(0, len(data) - length + 1)):
            yield sha, at - before + a, data[a : a + length]


def short_digest(string: bytes) -> bytes:
    return hashlib.blake2b(string, digest_size=16).digest()


def hot_spans(hot: DataFrame, length: int) -> DataFrame:
    """Spans of the anchors of very large groups, by counting their strings."""
    spark = hot.sparkSession

    def count(batches):
        for batch in batches:
            # a string's places, so that one place met twice is one
            seen: dict[bytes, set] = {}
            for sha, start, string in strings_of(batch, length):
                places = seen.setdefault(short_digest(string), set())
                if len(places) < 2:
                    places.add((sha, start))
            rows = [(d, *min(p), len(p)) for d, p in seen.items()]
            columns = list(zip(*rows)) or [()] * 4
            kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["digest", "sha", "start", "n"]
            )

    counted = hot.mapInArrow(count, "digest binary, sha binary, start bigint, n int")
    place = F.struct("sha", "start")
    twice = counted.groupBy("digest").agg(
        F.max("n").alias("n"), F.min(place).alias("low"), F.max(place).alias("high")
    )
    twice, at = stage(twice.where("n > 1 or low != high").select("digest"), "strings")
    n = twice.count()
    if n == 0:
        return spark.createDataFrame([], SPANS)
    if n <= MOST_HELD:
        held = spark.sparkContext.broadcast(frozenset(bytes(r.digest) for r in twice.toLocalIterator()))

        def mark(batches):
            known = held.value
            for batch in batches:
                out = [
                    (sha, start, start + length)
                    for sha, start, string in strings_of(batch, length)
                    if short_digest(string) in known
                ]
                yield span_batch(joined(out))

        return hot.mapInArrow(mark, SPANS)

    def spell(batches):
        for batch in batches:
            rows = [(short_digest(string), sha, start) for sha, start, string in strings_of(batch, length)]
            columns = list(zip(*rows)) or [()] * 3
            kinds = [pa.binary(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["digest", "sha", "start"]
            )

    spelled = hot.mapInArrow(spell, "digest binary, sha binary, start bigint")
    return spelled.join(twice, "digest").select("sha", "start", (F.col("start") + length).alias("end"))


def joined(spans: list[tuple]) -> list[tuple]:
    """Spans of each text, overlapping and touching ones as one."""
    out = []
    for sha, start, end in sorted(spans):
        if out and out[-1][0] == sha and start <= out[-1][2]:
            out[-1] = (sha, out[-1][1], max(end, out[-1][2]))
        else:
            out.append((sha, start, end))
    return out


def repeated_spans(docs: DataFrame, length: int = 200, most_members: int = 20_000):
    """((sha, spans), stage): the removed spans of each text that has any, by the
    SHA-256 of the text; they may overlap. Copies of a whole text count as one text."""
    if not GRAM < length:
        raise ValueError(f"length must be over {GRAM}")
    spark = docs.sparkSession
    twice = anchor_hashes(docs, length).groupBy("hash").agg(F.sum("n").alias("n")).where("n > 1").select("hash")
    twice, at_twice = stage(twice, "hashes")
    table = spark.sparkContext.broadcast(bit_table(twice, "hash"))
    around, at_around = stage(contexts(docs, table, length), "contexts")
    # what the table let pass by accident has one place only
    sizes = around.groupBy("hash").agg(F.count(F.lit(1)).alias("members"))
    hot, at_hot = stage(sizes.where(F.col("members") > most_members).select("hash"), "hot")
    large = around.join(hot, "hash", "left_semi")
    small = around.join(hot, "hash", "left_anti") if not hot.isEmpty() else around
    spans = (
        small.repartition("hash").sortWithinPartitions("hash").mapInArrow(sorted_spans(length), SPANS)
    )
    if not hot.isEmpty():
        spans = spans.unionByName(hot_spans(large.select("hash", "sha", "at", "before", "bytes"), length))

    spans, at_spans = stage(spans, "spans")
    drop(spark, at_twice, at_around, at_hot)
    found = spans.groupBy("sha").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))
    return found, at_spans


def cut(batches):
    """(sha, text, spans) to (sha, n_removed, n_spans, kept_sha256, kept)."""
    for batch in batches:
        out = []
        for sha, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
            data = text.encode()
            runs = joined([(b"", s["start"], s["end"]) for s in spans])
            kept, at = [], 0
            for _, a, b in runs:
                kept.append(data[at:a])
                at = b
            kept = b"".join([*kept, data[at:]])
            out.append((sha, len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept))
        columns = list(zip(*out)) or [()] * 5
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            ["sha", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def texts_of(docs: DataFrame, table) -> DataFrame:
    """(sha, text) of the texts whose digest passes the table, once per task."""

    def run(batches):
        bits = table.value
        seen = set()
        for batch in batches:
            shas, kept = [], []
            for i, value in enumerate(batch.column("text")):
                data = value.as_buffer()
                if data is None:
                    continue
                sha = hashlib.sha256(data).digest()
                if sha not in seen and passing(np.frombuffer(sha[:8], np.uint64), bits)[0]:
                    seen.add(sha)
                    shas.append(sha)
                    kept.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shas, pa.binary()), batch.column("text").take(pa.array(kept, pa.int64()))], ["sha", "text"]
            )

    return text_rows(docs).select("text").mapInArrow(run, "sha binary, text string")


def deduplicated(docs: DataFrame, length: int = 200, most_members: int = 20_000) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each document."""
    spark = docs.sparkSession
    rows, _ = stage(measured(docs, length), "measured")
    found, at_spans = repeated_spans(docs, length, most_members)
    found, _ = stage(found, "runs")
    drop(spark, at_spans)
    # copies of whole texts need no look at their strings
    copies = rows.where(F.col("n_bytes") >= length).groupBy("sha").agg(F.count(F.lit(1)).alias("copies"))
    copies, _ = stage(copies.where("copies > 1").select("sha", F.lit(True).alias("copy")), "copies")
    parts = found.join(copies, "sha", "left_anti")
    prefix = parts.mapInArrow(first_bytes, "head bigint")
    table = spark.sparkContext.broadcast(bit_table(prefix, "head"))
    kept = (
        texts_of(docs, table)
        .join(parts, "sha")
        .select("sha", "text", "spans")
        .mapInArrow(cut, "sha binary, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
        .drop("kept")
        .dropDuplicates(["sha"])
    )
    empty = hashlib.sha256(b"").hexdigest()
    return (
        rows.join(copies, "sha", "left")
        .join(kept, "sha", "left")
        .select(
            "doc_id",
            "n_bytes",
            F.when(F.col("copy"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(F.col("copy"), 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(F.col("copy"), empty)
            .otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha"))))
            .alias("kept_sha256"),
        )
    )


def first_bytes(batches):
    for batch in batches:
        heads = [int.from_bytes(s.as_py()[:8], "little", signed=True) for s in batch.column("sha")]
        yield pa.RecordBatch.from_arrays([pa.array(heads, pa.int64())], ["head"])
