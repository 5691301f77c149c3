"""What the operators share: input tables, written stages, byte-level words."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# bytes of text that one numpy step handles; a longer text is a step of its own
BLOCK_BYTES = 1 << 20

# a bit table has this many bits per value, within these bounds (32 MB at most)
BITS_PER_VALUE = 32
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28

_own_folder: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local session without one gets a folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = tempfile.mkdtemp(prefix="llm-")
    return _own_folder[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def drop(spark: SparkSession, *paths: str) -> None:
    """Delete written stages whose readers are done."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stage(frame: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``frame`` to the shared folder and read it again: (frame, path).

    This cuts the lineage like a checkpoint, in columns, and survives lost
    executors. The schema is given to the reader, so an empty stage works.
    """
    spark = frame.sparkSession
    path = new_path(spark, name)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path), path


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, text_hash. Rows with equal doc_id and text have equal results, so
    results are joined back by doc_id and text_hash."""
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash")
    )


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents whose (doc_id, text_hash) is not in ``gone``."""
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_text")).distinct()
    same = docs["doc_id"].eqNullSafe(gone["gone_id"]) & (
        F.xxhash64(docs["text"].cast("string")) == gone["gone_text"]
    )
    return docs.join(gone, same, "left_anti")


def byte_classes(separators: bytes) -> np.ndarray:
    """256 entries: 0 for a separator, else the byte with A-Z lower-cased."""
    classes = np.arange(256, dtype=np.uint8)
    classes[65:91] += 32
    classes[np.frombuffer(separators, np.uint8)] = 0
    return classes


#: words are runs of anything but white space: [^\x20\x09-\x0D]+
SPACED = byte_classes(bytes([32, *range(9, 14)]))
SPACED[0] = 1  # NUL is a word character there; 1 stands for it and no other byte loses its place
#: words are runs of [^\x00-\x2F\x3A-\x60\x7B-\x7F] after A-Z are lower-cased
ALPHANUMERIC = byte_classes(bytes([*range(48), *range(58, 65), *range(91, 97), *range(123, 128)]))

# odd multipliers of 64-bit polynomial hashes
WORD_BASE = np.uint64(0x9E3779B97F4A7C15)
GRAM_BASE = np.uint64(0xD6E8FEB86659FD93)
_powers = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 64), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Texts:
    """UTF-8 texts of consecutive rows, as one byte array with row bounds."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds

    def __len__(self) -> int:
        return len(self.bounds) - 1


def blocks(column: pa.Array, limit: int = BLOCK_BYTES):
    """(first row, Texts) of the column, ``limit`` bytes or one text at a time; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # an empty one has no chunk
        column = pa.array([], pa.string())
    column = column.cast(pa.string()).fill_null("")
    if len(column) == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        upto = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        upto = max(row + 1, min(upto, len(column)))
        yield row, Texts(data[offsets[row] : offsets[upto]], offsets[row : upto + 1] - offsets[row])
        row = upto


class Words:
    """Words of a block: hash, first and last byte, and each row's first word."""

    def __init__(self, texts: Texts, classes: np.ndarray):
        low = classes[texts.data]
        inside = low != 0
        n = len(low)
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        firsts = texts.bounds[:-1]
        firsts = firsts[firsts < n]
        begins[firsts] = inside[firsts]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        lasts = texts.bounds[1:] - 1
        lasts = lasts[lasts >= 0]
        ends[lasts] = inside[lasts]
        self.low = low
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, texts.bounds)  # of each row, and the total
        length = self.end - self.start
        if len(length):
            at = np.flatnonzero(inside)
            place = np.arange(len(at)) - np.repeat(np.cumsum(length) - length, length)
            value = (low[at].astype(np.uint64) + np.uint64(1)) * powers(WORD_BASE, int(length.max()))[place]
            self.hash = mixed(np.add.reduceat(value, np.cumsum(length) - length) + length.astype(np.uint64))
        else:
            self.hash = np.zeros(0, np.uint64)

    def __len__(self) -> int:
        return len(self.start)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each k consecutive words of one row: (hash, first word)."""
        n = len(self) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = self.hash[:n].copy()
        for j in range(1, k):
            total = total * GRAM_BASE + self.hash[j : n + j]
        rows = self.rows()
        whole = np.flatnonzero(rows[:n] == rows[k - 1 :])
        return mixed(total[whole]), whole


def bit_table(rows: DataFrame, column: str) -> np.ndarray:
    """A table with a bit set for each value of a bigint column.

    Its length is bounded by ``MOST_BITS``; past that more values pass that are
    not in it, never fewer that are.
    """
    n = rows.count()
    bits = LEAST_BITS
    while bits < min(n * BITS_PER_VALUE, MOST_BITS):
        bits *= 2
    value = rows.select(F.col(column).alias("value"))
    place = F.expr(f"value & {bits - 1}")
    words = value.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(value & 63 as int))")).alias("set")
    )
    table = np.zeros(bits >> 6, np.int64)
    for r in words.toLocalIterator():  # at most bits / 64 rows
        table[r.word] = r.set
    return table.view(np.uint64)


def passing(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which hashes have their bit set."""
    place = hashes & np.uint64(len(table) * 64 - 1)
    word = table[(place >> np.uint64(6)).astype(np.int64)]
    return ((word >> (place & np.uint64(63))) & np.uint64(1)).astype(bool)
