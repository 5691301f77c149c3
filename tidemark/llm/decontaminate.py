"""Benchmark decontamination by winnowing.

Fingerprints are hashes of ``gram`` consecutive words; of each run of
``window - gram + 1`` of them the smallest is kept (the rightmost of equal
ones). Whatever ``window`` words two texts share, they keep the same
fingerprint inside it, so no shared window is missed. Test items shorter than
a window are one fingerprint each, the hash of all their words; documents are
asked for every such length that occurs.

Document fingerprints are first looked up in a bit table made of the test
fingerprints (its length follows their number up to a fixed bound). What passes is joined with the test fingerprints by hash, and
each hit is extended: the windows around it are compared word by word with the
windows of the items.

Defined results: a null or empty text has no words and no hits; an item
without words is never met; items that repeat a text are all listed, an
item_id that repeats counts once, items without an id are left out; rows that
repeat, and documents without an id, each give a row; without items nothing
is contaminated; without documents the result is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import ALPHANUMERIC, Words, bit_table, blocks, keyed, passing, stage, without

WINDOW, GRAM = 10, 5


def selected(hashes: np.ndarray, rows: np.ndarray, width: int) -> np.ndarray:
    """Winnowing: places of the smallest hash of every ``width`` neighbours of one row."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, width)
    best = views[:, 0].copy()
    place = np.zeros(n, np.int64)
    for j in range(1, width):  # rightmost of equal ones
        less = views[:, j] <= best
        best[less] = views[less, j]
        place[less] = j
    same = rows[:n] == rows[width - 1 :]
    return np.unique(place[same] + np.flatnonzero(same))


def fingerprints(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of the fingerprints kept of each row."""
    hashes, first = words.grams(gram)
    kept = selected(hashes, words.rows()[first], window - gram + 1)
    return hashes[kept], first[kept]


def sized(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of whole short items, told apart by their number of words."""
    return hashes ^ np.uint64(int(length) * 0x9E3779B97F4A7C15 % 2**64)


def joined(words: Words, data: bytes, first: int, length: int) -> str:
    """Words first .. first + length, a space between."""
    return b" ".join(
        data[s:e] for s, e in zip(words.start[first : first + length], words.end[first : first + length])
    ).decode()


def item_windows(window: int, gram: int):
    """Items to rows (item_id, length, words of a window), and its fingerprint hashes."""

    def run(batches):
        for batch in batches:
            out = []
            for row, texts in blocks(batch.column("text")):
                words = Words(texts, ALPHANUMERIC)
                data = words.low.tobytes()
                ids = batch.column("item_id")[row : row + len(texts)].to_pylist()
                hashes, firsts = fingerprints(words, window, gram)
                for i, item in enumerate(ids):
                    a, b = words.first[i], words.first[i + 1]
                    if a == b:
                        continue
                    if b - a < window:
                        whole = words_of(words, i).grams(b - a)[0]
                        out.append((item, joined(words, data, a, b - a), sized(whole, b - a).view(np.int64).tolist()))
                        continue
                    x, y = np.searchsorted(firsts, [a, b])
                    for s in range(a, b - window + 1):
                        u, v = np.searchsorted(firsts[x:y], [s, s + window - gram + 1]) + x
                        out.append((item, joined(words, data, s, window), hashes[u:v].view(np.int64).tolist()))
            columns = list(zip(*out)) or [()] * 3
            kinds = [pa.string(), pa.string(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["item_id", "words", "prints"]
            )

    return run


def words_of(words: Words, row: int) -> Words:
    """The words of one row."""
    part = object.__new__(Words)
    a, b = words.first[row], words.first[row + 1]
    part.low, part.start, part.end, part.hash = words.low, words.start[a:b], words.end[a:b], words.hash[a:b]
    part.first = np.array([0, b - a])
    return part


HITS = "doc_id bigint, text_hash bigint, n_words bigint, hits array<struct<print:bigint,start:int,words:string>>"


def document_hits(table, lengths: list[int], window: int, gram: int):
    """Documents to n_words and, for each fingerprint that passes, the windows around it."""

    def run(batches):
        bits = table.value
        for batch in batches:
            counts, hits = [], []
            for _, texts in blocks(batch.column("text")):
                words = Words(texts, ALPHANUMERIC)
                data = None
                found: list[list] = [[] for _ in range(len(texts))]
                rows = words.rows()
                hashes, firsts = fingerprints(words, window, gram)
                there = passing(hashes, bits)
                for h, at in zip(hashes[there], firsts[there]):
                    data = data if data is not None else words.low.tobytes()
                    row = rows[at]
                    low, high = words.first[row], words.first[row + 1]
                    for s in range(max(low, at + gram - window), min(at, high - window) + 1):
                        found[row].append((int(h.view(np.int64)), int(s - low), joined(words, data, s, window)))
                for length in lengths:
                    hashes, firsts = words.grams(length)
                    hashes = sized(hashes, length)
                    there = passing(hashes, bits)
                    for h, at in zip(hashes[there], firsts[there]):
                        data = data if data is not None else words.low.tobytes()
                        row = rows[at]
                        found[row].append(
                            (int(h.view(np.int64)), int(at - words.first[row]), joined(words, data, at, length))
                        )
                counts.append(np.diff(words.first))
                hits += found
            counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            kind = pa.list_(pa.struct([("print", pa.int64()), ("start", pa.int32()), ("words", pa.string())]))
            hits = [[dict(zip(("print", "start", "words"), h)) for h in row] for row in hits]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(counts, pa.int64()),
                    pa.array(hits, kind),
                ],
                ["doc_id", "text_hash", "n_words", "hits"],
            )

    return run


def found_windows(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> tuple[DataFrame, DataFrame, DataFrame, list[str]]:
    """(documents with row, windows met per row, items by window, stages to drop)."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("item_id is not null")
    wins, at_items = stage(
        items.mapInArrow(item_windows(window, gram), "item_id string, words string, prints array<bigint>"), "items"
    )
    prints = wins.select(F.explode("prints").alias("print")).distinct()
    n_words = F.size(F.split("words", " "))
    lengths = sorted(
        r[0] for r in wins.where(n_words < window).select(n_words).distinct().collect()
    )  # fewer than ``window`` of them
    table = spark.sparkContext.broadcast(bit_table(prints, "print"))
    met = keyed(docs).mapInArrow(document_hits(table, lengths, window, gram), HITS)
    met, at_docs = stage(met.withColumn("row", F.monotonically_increasing_id()), "hits")
    candidates = met.where("size(hits) > 0").select("row", F.explode("hits").alias("hit")).select("row", "hit.*")
    # fingerprints first, then the window itself, word by word
    shared = candidates.join(prints, "print", "left_semi").select("row", "start", "words").distinct()
    known = wins.select("words", "item_id").distinct()
    return met, shared.join(known.select("words").distinct(), "words", "left_semi"), known, [at_items, at_docs]


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, spans, text_hash.

    ``items`` lists the items met, sorted as strings; ``spans`` the runs of hit
    words as (first word, word after the last).
    """
    met, shared, known, _ = found_windows(docs, benchmark, window, gram)
    size = F.size(F.split("words", " "))
    spans = shared.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct(F.col("start"), (F.col("start") + size).alias("end")))).alias("w")
    )
    # runs of overlapping windows: a window starts a new run past the reach of those before it
    spans = spans.select(
        "row",
        F.expr(
            "aggregate(w, cast(array() as array<struct<start:int,end:int>>), (a, x) ->"
            " case when size(a) > 0 and x.start <= element_at(a, -1).end"
            " then concat(slice(a, 1, size(a) - 1), array(struct(element_at(a, -1).start as start,"
            " greatest(element_at(a, -1).end, x.end) as end)))"
            " else concat(a, array(struct(x.start as start, x.end as end))) end)"
        ).alias("spans"),
    ).withColumn("n_hit", F.expr("aggregate(spans, 0L, (a, x) -> a + x.end - x.start)"))
    listed = (
        shared.select("row", "words").distinct().join(known, "words").groupBy("row")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    none = F.array().cast("array<string>")
    return (
        met.select("row", "doc_id", "text_hash", "n_words")
        .join(spans, "row", "left")
        .join(listed, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
            F.coalesce("items", none).alias("items"),
            F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
            "text_hash",
        )
    )


def clean_only(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The documents without contaminated ones."""
    gone = decontaminate(docs, benchmark, window, gram).where("contaminated").select("doc_id", "text_hash")
    return without(docs, gone)
