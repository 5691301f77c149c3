"""WARC archives with a two-level capture index.

Writing: every page becomes a record, a gzip member of its own. Of pages with
equal payloads the one with the smallest page_id holds the payload, the others
are revisits of it. Each task writes its records to a file of its own in the
store folder and reports where they lie, so a task that runs again leaves a
file that nothing refers to.

Index: captures are sorted by reversed-host URL key across range partitions
and packed into compressed blocks of ``BLOCK_LINES`` lines; a sparse directory
keeps the first key and the byte range of each block. A lookup finds the index
file by its key range, binary-searches the file's directory, reads one block
by range, binary-searches its lines, and reads the record by range.

Files are opened with pyarrow's file systems, so a store may be any URI they
know, among them file:, hdfs: and s3:.

Defined results: a null html is an empty payload and a null url an empty one;
a url with control characters is percent-encoded in its record and looked up as given;
pages without an id are written, never as the first of equal payloads unless
none has an id (then all are responses); rows that repeat one page_id and
payload are all of the same type; without pages the store is empty.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import uuid
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.base import new_path, stage

BLOCK_LINES = 512
FILE_BYTES = 64 << 20
# bodies that a lookup holds before it gives them out
GIVEN_BYTES = 8 << 20

DIRECTORY = "file string, first string, last string, at bigint, length bigint, lines int"
RECORDS = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
)


def opened(uri: str):
    """(file system, path) of a URI or a plain path."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file:///" + uri[len("file:") :].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def url_key(url: str) -> str:
    """Host parts reversed and joined by commas, then the path: com,example)/a?b=c."""
    try:
        parts = urlsplit(url if "//" in url else f"//{url}")
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return f"){url}"
    host = ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, 80, 443) else "")
    return f"{host}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header_url(url: str) -> tuple[str, bool]:
    """(the URL as a header can hold it, whether it is escaped): different URLs stay different.

    A URL with control characters has them and its percent signs percent-encoded.
    """
    if all(c >= " " and c != "\x7f" for c in url):
        return url, False
    return "".join(c if c >= " " and c not in "%\x7f" else f"%{ord(c):02X}" for c in url), True


def record(page_id: int | None, url: str, payload: bytes, sha1: str, first: int | None) -> bytes:
    """One WARC record as a gzip member; with ``first`` a revisit of that page."""
    url, escaped = header_url(url)
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{sha1}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if escaped:
        fields.append(("X-Target-URI-Escaped", "true"))
    body = payload
    if first is not None:
        fields += [
            ("WARC-Refers-To", f"<urn:page:{first}>"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ]
        body = b""
    fields.append(("Content-Length", str(len(body))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return gzip.compress(head.encode() + body + b"\r\n\r\n", 6, mtime=0)


def parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields, body) of a record."""
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record does not end where its header says")
    return fields, rest[:size]


def write_records(folder: str):
    """Pages (page_id, url, html, digest, first) to records in files; CAPTURES out."""

    def run(batches):
        fs, path = opened(folder)
        out, name, at = None, "", 0
        for batch in batches:
            rows = []
            for page_id, url, html, sha1, first in zip(*(batch.column(i) for i in range(5))):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                url, page = url.as_py(), page_id.as_py()
                data = record(page, url, html.as_py().encode(), sha1.as_py(), first.as_py())
                out.write(data)
                rows.append((url_key(url), page, name, at, len(data)))
                at += len(data)
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["key", "page_id", "file", "at", "length"],
            )
        if out is not None:
            out.close()

    return run


def write_index(folder: str):
    """Sorted captures of one range to blocks in one index file; DIRECTORY out."""

    def run(batches):
        fs, path = opened(folder)
        out, name, at, lines, blocks = None, f"{uuid.uuid4().hex}.cdx.gz", 0, [], []

        def flush():
            nonlocal at, lines
            data = gzip.compress("\n".join(json.dumps(x, ensure_ascii=False) for x in lines).encode(), 6, mtime=0)
            out.write(data)
            blocks.append((name, lines[0][0], lines[-1][0], at, len(data), len(lines)))
            at, lines = at + len(data), []

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                lines.append(row)
                if len(lines) == BLOCK_LINES:
                    flush()
        if lines:
            flush()
        if out is not None:
            out.close()
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32()]
        columns = list(zip(*blocks)) or [()] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            ["file", "first", "last", "at", "length", "lines"],
        )

    return run


class Store:
    """A written archive: its folder and its block directory (a Parquet stage)."""

    def __init__(self, spark: SparkSession, folder: str, directory: DataFrame):
        self.spark, self.folder, self.directory = spark, folder, directory

    def read_all(self) -> DataFrame:
        """RECORDS of every capture, block by block through the index."""
        folder = self.folder

        def run(batches):
            fs, path = opened(folder)
            for batch in batches:
                for file, at, length in zip(*(batch.column(n).to_pylist() for n in ("file", "at", "length"))):
                    captures = read_block(fs, f"{path}/{file}", at, length)
                    yield described(fs, path, sorted(captures, key=lambda c: (c[2], c[3])))

        blocks = self.directory.select("file", "at", "length")
        # one row is one block of BLOCK_LINES captures: spread them
        return blocks.repartition("file", "at").mapInArrow(run, RECORDS)

    def lookup(self, urls: DataFrame) -> DataFrame:
        """url, page_id, html, record_type, refers_to of every capture of the given urls."""
        folder = self.folder
        files = self.directory.groupBy("file").agg(
            F.min("first").alias("low"),
            F.max("last").alias("high"),
            F.sort_array(F.collect_list(F.struct("first", "last", "at", "length"))).alias("blocks"),
        )
        # the top level: one row per index file, so as many as range partitions were written
        top = sorted((r.low, r.high, r.file) for r in files.select("low", "high", "file").collect())

        def placed(batches):
            lows = [t[0] for t in top]
            for batch in batches:
                out = []
                for url in batch.column("url").to_pylist():
                    key = url_key(url)
                    i = bisect.bisect_right(lows, key) - 1
                    while i >= 0 and top[i][1] >= key:
                        out.append((url, key, top[i][2]))
                        i -= 1
                columns = list(zip(*out)) or [()] * 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.string()) for c in columns], ["url", "key", "file"]
                )

        asked = urls.select("url").where("url is not null").distinct()
        met = asked.mapInArrow(placed, "url string, key string, file string").join(files, "file")

        def run(batches):
            fs, path = opened(folder)
            for batch in batches:
                out, size = [], 0
                for r in batch.to_pylist():
                    blocks, wanted = r["blocks"], header_url(r["url"])
                    i = max(bisect.bisect_left([b["first"] for b in blocks], r["key"]) - 1, 0)
                    while i < len(blocks) and blocks[i]["first"] <= r["key"]:
                        if blocks[i]["last"] >= r["key"]:
                            lines = read_block(fs, f"{path}/{r['file']}", blocks[i]["at"], blocks[i]["length"])
                            keys = [c[0] for c in lines]
                            for c in lines[bisect.bisect_left(keys, r["key"]) : bisect.bisect_right(keys, r["key"])]:
                                fields, body = read_record(fs, f"{path}/{c[2]}", c[3], c[4])
                                if (fields["WARC-Target-URI"], "X-Target-URI-Escaped" in fields) == wanted:
                                    out.append((r["url"], c[1], body.decode(), fields["WARC-Type"], refers(fields)))
                                    size += len(body)
                                if size >= GIVEN_BYTES:  # a URL with very many captures
                                    yield found(out)
                                    out, size = [], 0
                        i += 1
                yield found(out)

        kind = "url string, page_id bigint, html string, record_type string, refers_to bigint"
        return met.mapInArrow(run, kind)


def found(rows: list[tuple]) -> pa.RecordBatch:
    """Captures that a lookup gives out."""
    names = ["url", "page_id", "html", "record_type", "refers_to"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def read_range(fs, path: str, at: int, length: int) -> bytes:
    with fs.open_input_file(path) as file:
        return file.read_at(length, at)


def read_block(fs, path: str, at: int, length: int) -> list[tuple]:
    """Captures (key, page_id, file, at, length) of one block, in key order."""
    text = gzip.decompress(read_range(fs, path, at, length)).decode()
    return [tuple(json.loads(line)) for line in text.split("\n")]


def read_record(fs, path: str, at: int, length: int):
    return parsed(read_range(fs, path, at, length))


def refers(fields: dict[str, str]) -> int | None:
    named = fields.get("WARC-Refers-To")
    return None if named is None else int(named.removeprefix("<urn:page:").removesuffix(">"))


def described(fs, path: str, captures: list[tuple]) -> pa.RecordBatch:
    """RECORDS of captures that are sorted by file; each file is opened once."""
    rows, file, name = [], None, None
    for _, page_id, of, at, length in captures:
        if of != name:
            if file is not None:
                file.close()
            file, name = fs.open_input_file(f"{path}/{of}"), of
        fields, body = parsed(file.read_at(length, at))
        sha1 = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if fields["WARC-Type"] == "response" and (digest(body) != sha1 or len(body) != int(fields["X-Payload-Length"])):
            raise ValueError(f"payload of page {page_id} differs from its digest")
        rows.append((page_id, int(fields["X-Payload-Length"]), sha1, fields["WARC-Type"], refers(fields)))
    if file is not None:
        file.close()
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def with_digest(batches):
    for batch in batches:
        html = batch.column("html").fill_null("")
        found = pa.array([digest(x.as_py().encode()) for x in html], pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url").fill_null(""), html, found],
            ["page_id", "url", "html", "digest"],
        )


def write_archive(pages: DataFrame, folder: str | None = None, min_dedup_bytes: int = 0) -> Store:
    """Write the pages and their index below ``folder``; payloads shorter than
    ``min_dedup_bytes`` are stored each time."""
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    rows = rows.mapInArrow(with_digest, "page_id bigint, url string, html string, digest string")
    size = F.octet_length("html")
    seen = rows.where(size >= min_dedup_bytes).select("page_id", "digest")
    firsts = seen.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.where("n > 1").select("digest", "first")
    # who revisits whom, by page: the payloads themselves never meet on one key
    revisits = (
        seen.join(firsts, "digest")
        .where("not (page_id <=> first)")
        .select(F.col("page_id").alias("later"), F.col("digest").alias("same"), "first")
        .distinct()
    )
    decided = rows.join(
        revisits,
        F.col("page_id").eqNullSafe(F.col("later")) & (F.col("digest") == F.col("same")),
        "left",
    ).select("page_id", "url", "html", "digest", "first")
    make_folder(spark, folder)
    captures, _ = stage(
        decided.mapInArrow(write_records(folder), "key string, page_id bigint, file string, at bigint, length bigint"),
        "captures",
    )
    ranged = captures.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id", "file", "at")
    directory, _ = stage(ranged.mapInArrow(write_index(folder), DIRECTORY), "directory")
    return Store(spark, folder, directory)


def make_folder(spark: SparkSession, folder: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(at)
