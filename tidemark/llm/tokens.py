"""Token counts of a public tokenizer, huge texts in overlapping chunks.

A text of up to ``chunk_chars`` characters is one chunk. A longer one is cut
into chunks that overlap by ``overlap`` characters; chunks are rows of their
own, so one huge text is spread over tasks. Each chunk is encoded with offsets
and reports the stable boundaries inside its overlaps: places where a token
starts right after ASCII white space. The tokenizer's normaliser and splitter
act on each side of white space alone, so whatever stands left of such a place
cannot change the tokens right of it. Neighbours are spliced at the first
boundary that both report; where they share none, the whole text is cut again
with twice the overlap, at last as one chunk.

Chunks themselves are encoded piece by piece (pieces end at spaces and line
feeds, the same stable places), each distinct piece once per batch of rows.

Defined results: null or empty texts have no bytes and no tokens; repeated
rows and rows without a doc_id each give a row; without documents the result
is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import drop, stage

TOKENIZER = "word_bpe_49k.json"
CACHED_PIECES = 300_000

_encoders: dict[str, PieceEncoder] = {}


class PieceEncoder:
    """Tokens of pieces between white space, by the tokenizers library."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.counts: dict[str, int] = {"": 0}

    def learn(self, pieces: set[str]) -> None:
        """Encode the pieces that are not known yet."""
        if len(self.counts) > CACHED_PIECES:
            self.counts = {"": 0}
        new = [p for p in pieces if p not in self.counts]
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            encoded = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            self.counts.update(zip(part, map(len, encoded)))

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        split = [t.replace("\n", " ").split(" ") for t in texts]
        self.learn(set().union(*split))
        of = self.counts.__getitem__
        return [sum(map(of, pieces)) for pieces in split]

    def boundaries(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(first character of each piece, tokens before it), in order."""
        pieces = text.replace("\n", " ").split(" ")
        self.learn(set(pieces))
        lengths = np.array([len(p) for p in pieces], np.int64)
        tokens = np.array([self.counts[p] for p in pieces], np.int64)
        start = np.cumsum(lengths + 1) - lengths - 1
        kept = lengths > 0
        return start[kept], (np.cumsum(tokens) - tokens)[kept]


def encoder(path: str) -> PieceEncoder:
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


COUNTS = "doc_id bigint, n_bytes bigint, n_tokens bigint"
CHUNKS = (
    "row bigint, doc_id bigint, n_bytes bigint, part int, parts int, total bigint,"
    " left_at array<bigint>, left_tokens array<bigint>, right_at array<bigint>, right_tokens array<bigint>"
)


def batches_of(column: pa.Array, limit: int = 4 << 20):
    """Texts of consecutive rows, about ``limit`` characters at a time; null is empty."""
    size, texts = 0, []
    for value in column:
        text = value.as_py() or ""
        texts.append(text)
        size += len(text)
        if size >= limit:
            yield texts
            size, texts = 0, []
    if texts:
        yield texts


def count_whole(path: str):
    def run(batches):
        for batch in batches:
            counts = []
            for texts in batches_of(batch.column("text")):
                counts += encoder(path).count(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def encode_chunks(path: str):
    """Rows (row, doc_id, n_bytes, part, parts, at, own_end, text) to CHUNKS rows."""

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                coder = encoder(path)
                starts, before = coder.boundaries(r["text"])
                total = coder.count([r["text"]])[0]
                # a chunk's first piece may be the rest of a piece: not proven
                proven = starts > 0
                starts, before = starts[proven] + r["at"], before[proven]
                in_left = (starts >= r["at"]) & (starts < r["at"] + r["overlap"])
                in_right = starts >= r["own_end"]
                out.append(
                    {
                        **{k: r[k] for k in ("row", "doc_id", "n_bytes", "part", "parts")},
                        "total": total,
                        "left_at": starts[in_left].tolist() if r["part"] else [],
                        "left_tokens": before[in_left].tolist() if r["part"] else [],
                        "right_at": starts[in_right].tolist() if r["part"] < r["parts"] - 1 else [],
                        "right_tokens": before[in_right].tolist() if r["part"] < r["parts"] - 1 else [],
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema=CHUNK_SCHEMA)

    return run


CHUNK_SCHEMA = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("part", pa.int32())]
    + [("parts", pa.int32()), ("total", pa.int64())]
    + [(n, pa.list_(pa.int64())) for n in ("left_at", "left_tokens", "right_at", "right_tokens")]
)


def chunks(texts: DataFrame, chunk_chars: int, overlap: int) -> DataFrame:
    """Overlapping chunks: part k holds [k * chunk, (k + 1) * chunk + overlap)."""
    parts = F.expr(f"cast(ceil(length(text) / {chunk_chars}) as int)")
    rows = texts.withColumn("parts", parts).withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
    rows = rows.withColumn("at", F.expr(f"cast(part as bigint) * {chunk_chars}"))
    return rows.select(
        "row",
        "doc_id",
        "n_bytes",
        "part",
        "parts",
        "at",
        F.expr(f"at + {chunk_chars}").alias("own_end"),
        F.lit(overlap).cast("long").alias("overlap"),
        F.expr(f"substring(text, at + 1, {chunk_chars} + {overlap})").alias("text"),
    ).repartition("row", "part")


def spliced(encoded: DataFrame) -> DataFrame:
    """row, doc_id, n_bytes, n_tokens, aligned: chunk counts joined at common boundaries."""
    right = encoded.select(
        "row", (F.col("part") + 1).alias("part"), "right_at", "right_tokens"
    )
    left = encoded.where("part > 0").select("row", "part", "left_at", "left_tokens")
    cuts = left.join(right, ["row", "part"]).withColumn(
        "at", F.array_min(F.array_intersect("left_at", "right_at"))
    )
    cuts = cuts.select(
        "row",
        F.expr("right_tokens[cast(array_position(right_at, at) as int) - 1]").alias("upto"),
        F.expr("left_tokens[cast(array_position(left_at, at) as int) - 1]").alias("before"),
    )
    # tokens = all of the last chunk + what stands before each cut - what the next chunk has before it
    cut = cuts.groupBy("row").agg(
        F.sum("upto").alias("upto"), F.sum("before").alias("before"), F.count("upto").alias("cuts")
    )
    last = encoded.where("part = parts - 1").select("row", "doc_id", "n_bytes", "parts", "total")
    return last.join(cut, "row", "left").select(
        "row",
        "doc_id",
        "n_bytes",
        (F.col("total") + F.coalesce("upto", F.lit(0)) - F.coalesce("before", F.lit(0))).alias("n_tokens"),
        (F.coalesce("cuts", F.lit(0)) == F.col("parts") - 1).alias("aligned"),
    )


def token_counts(
    docs: DataFrame, path: str, limit: int = 2048, chunk_chars: int = 1 << 15, overlap: int = 256
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each whole text."""
    if not 0 < overlap <= chunk_chars:
        raise ValueError("overlap must lie between 1 and chunk_chars")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text",
        F.monotonically_increasing_id().alias("row"),
    )
    parts = [rows.where(F.length("text") <= chunk_chars).mapInArrow(count_whole(path), COUNTS)]
    # huge texts are numbered once, in a stage, as the rounds refer to them by row
    huge, at = stage(rows.where(F.length("text") > chunk_chars), "huge")
    longest = huge.agg(F.max(F.length("text"))).first()[0] or 0
    size = chunk_chars
    while longest:
        # read three times when spliced, encoded once
        encoded, there = stage(chunks(huge, size, overlap).mapInArrow(encode_chunks(path), CHUNKS), "encoded")
        done, _ = stage(spliced(encoded), "spliced")
        drop(docs.sparkSession, there)
        parts.append(done.where("aligned").select("doc_id", "n_bytes", "n_tokens"))
        if done.where("not aligned").isEmpty():
            break
        left = huge.join(done.where("not aligned").select("row"), "row", "left_semi")
        huge, before = stage(left, "huge")
        drop(docs.sparkSession, at)
        at = before
        overlap *= 2
        size = max(size, overlap)
    drop(docs.sparkSession, at)
    counted = parts[0]
    for part in parts[1:]:
        counted = counted.unionByName(part)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
