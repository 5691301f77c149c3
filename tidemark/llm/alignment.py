"""Alignment of two public tokenizers: which token of one covers which of the other.

Both encode a space and the text. Byte offsets where a token of A and one of B
both end cut the tokens into groups; tokens of one group are linked. What is
known of a byte range of a text is a fragment: the tokens up to its first
common offset (open prefix), the groups closed inside it, and the tokens after
its last common offset (open suffix); a range without a common offset is all
prefix. Two neighbouring fragments compose to the fragment of both ranges, a
suffix and the next prefix becoming a group, and this is associative. So a
text of over ``chunk_bytes`` is cut into rows, each row is encoded and yields a
fragment for every byte range of ``chunk_bytes`` (a token belongs to the range
in which it ends, so ranges part groups anywhere), and rounds of a shuffle
compose ``FAN`` neighbours each until one fragment is the whole text.

Encoding is cut between two characters that are no white space and the single
space between them. Neither A's splitter nor any piece of B's vocabulary
reaches over such a place (the latter is checked when B is loaded), so parts
are encoded alone, each distinct part of a block of texts once.

The corpus-wide count of a linked pair of ids is the number of documents that
hold it. Documents are written in blocks with the pairs of the block summed
up; these sums are added over blocks, and each block gets the counts of its
own pairs back. What is shuffled is one row per block and pair, not per
document and pair.

Defined results: texts that are null, empty, or that either tokenizer doesn't
spell byte by byte have no tokens: zeros, no links, an empty digest. Repeated
rows and rows without a doc_id are documents of their own and each give a row.
Without documents the result is empty. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import Counter
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import drop, stage

TOKENIZERS = ("byte_bpe_50k.json", "piece_bpe_32k.model")

CHUNK_BYTES = 1 << 16
FAN = 8
BLOCK_BYTES = 1 << 20
ENCODED_AT_ONCE = 4000
# pairs of a group that are made one by one
LARGE_GROUP = 4096

# characters that no version of Unicode calls white space
SOLID = r"!-~\u00a1-\u167f\u2c00-\u2fff\u3001-\ud7ff"
CUT = re.compile(f"(?<=[{SOLID}]) (?=[{SOLID}])")

GROUPS = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
#: documents (of_block false), and for each block the number of its documents that hold a pair
HELD = f"block bigint, of_block boolean, {GROUPS}, pairs array<bigint>, times array<bigint>"
SEGMENTS = "row bigint, doc_id bigint, at bigint, text string"
#: a fragment: open prefix (head), closed groups (ids and how many of them each has), open suffix (tail)
LISTS = ("head_a", "head_b", "a", "b", "sizes_a", "sizes_b", "tail_a", "tail_b")
FRAGMENTS = "row bigint, doc_id bigint, at bigint, spelled boolean, meets boolean," + ",".join(
    f" {name} array<int>" for name in LISTS
)
ALIGNED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint,"
    " n_best bigint, count_sum bigint, groups_sha256 string"
)

_aligners: dict[tuple[str, str], Aligner] = {}


def met(a: list, ends_a: list, b: list, ends_b: list) -> tuple[list, tuple[list, list]]:
    """Groups (ids of A, ids of B) up to each common end offset, and the tokens after the last one."""
    groups, i, j, from_i, from_j = [], 0, 0, 0, 0
    while i < len(a) and j < len(b):
        if ends_a[i] == ends_b[j]:
            i, j = i + 1, j + 1
            groups.append((a[from_i:i], b[from_j:j]))
            from_i, from_j = i, j
        elif ends_a[i] < ends_b[j]:
            i += 1
        else:
            j += 1
    return groups, (a[from_i:], b[from_j:])


class Fragment:
    """What is known of a range: ``head``, closed ``groups``, ``tail``; all is head if nothing ``meets``."""

    def __init__(self, groups: list, rest: tuple[list, list]):
        self.meets = bool(groups)
        self.head = groups[0] if groups else rest
        self.groups = groups[1:]
        self.tail = rest if groups else ([], [])

    def add(self, after: Fragment) -> None:
        """Become the fragment of this range and the one that follows it."""
        if not self.meets:
            self.head = (self.head[0] + after.head[0], self.head[1] + after.head[1])
            self.meets, self.groups, self.tail = after.meets, after.groups, after.tail
            return
        joined = (self.tail[0] + after.head[0], self.tail[1] + after.head[1])
        if after.meets:
            self.groups.append(joined)
            self.groups += after.groups
            self.tail = after.tail
        else:
            self.tail = joined

    def lists(self) -> dict:
        return {
            "meets": self.meets,
            "head_a": self.head[0],
            "head_b": self.head[1],
            "a": [i for a, _ in self.groups for i in a],
            "b": [i for _, b in self.groups for i in b],
            "sizes_a": [len(a) for a, _ in self.groups],
            "sizes_b": [len(b) for _, b in self.groups],
            "tail_a": self.tail[0],
            "tail_b": self.tail[1],
        }

    @classmethod
    def read(cls, r: dict) -> Fragment:
        made = cls([], (r["head_a"], r["head_b"]))
        made.meets, made.tail = r["meets"], (r["tail_a"], r["tail_b"])
        upto_a, upto_b = list(accumulate(r["sizes_a"])), list(accumulate(r["sizes_b"]))
        made.groups = [
            (r["a"][i - n : i], r["b"][j - m : j])
            for i, n, j, m in zip(upto_a, r["sizes_a"], upto_b, r["sizes_b"])
        ]
        return made


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, … counts[0] of them, then those of starts[1], …"""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def pair_counts(groups: list, size_b: int) -> Counter:
    """How often each pair ``id of A * size_b + id of B`` is linked."""
    found = Counter()
    for a, b in groups:
        if len(a) == 1 == len(b):
            found[a[0] * size_b + b[0]] += 1
        else:
            of_b = Counter(b).items()
            for i, n in Counter(a).items():
                for j, m in of_b:
                    found[i * size_b + j] += n * m
    return found


def spelled_groups(groups: list) -> bytes:
    """``a1,a2|b1;a3|b2,b3``"""
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups).encode()


def byte_level_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, all other bytes in turn
    for the characters from U+0100 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Spelling:
    """The byte strings of ids, in one array."""

    def __init__(self, strings: list[bytes]):
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.size = np.array([len(s) for s in strings], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.data[spread(self.start[ids], self.size[ids])]


class Encoded:
    """Tokens of parts: ids, where the tokens of each part end, and which parts are spelled."""

    def __init__(self, a: np.ndarray, upto_a: np.ndarray, b: np.ndarray, upto_b: np.ndarray, spelled: np.ndarray):
        self.a, self.upto_a, self.b, self.upto_b, self.spelled = a, upto_a, b, upto_b, spelled


class Aligner:
    """Tokens of parts of texts, by the tokenizers' own libraries."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_level_alphabet()
        words = {i: w for w, i in self.a.get_vocab().items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece holds a space after another character; parts can't be encoded alone")
        self.bytes_a = Spelling(
            [bytes(alphabet.get(c, 0) for c in words.get(i, "")) for i in range(max(words) + 1)]
        )
        self.bytes_b = Spelling(
            [
                bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in enumerate(pieces)
            ]
        )
        self.size_b = len(pieces)
        self.decimals = Spelling([b"%d," % i for i in range(max(len(pieces), max(words) + 1))])

    def encoded(self, parts: list[str]) -> Encoded:
        """The parts' tokens; each part is encoded with the space before it."""
        of_a, of_b = [], []
        for at in range(0, len(parts), ENCODED_AT_ONCE):
            some = parts[at : at + ENCODED_AT_ONCE]
            of_a += [e.ids for e in self.a.encode_batch_fast([" " + p for p in some], add_special_tokens=False)]
            of_b += self.b.encode(some, num_threads=1)
        whole = np.frombuffer((" " + " ".join(parts)).encode(), np.uint8)
        size = np.array(pc.binary_length(pa.array(parts, pa.string())), np.int64) + 1
        spelled, out = size > 1, []
        for ids_of, table in ((of_a, self.bytes_a), (of_b, self.bytes_b)):
            upto = np.append(0, np.cumsum([len(ids) for ids in ids_of], dtype=np.int64))
            ids = np.fromiter(chain.from_iterable(ids_of), np.int64, upto[-1])
            bytes_upto = np.append(0, np.cumsum(table.size[ids]))[upto]
            spelled = spelled & (np.diff(bytes_upto) == size)
            out += [ids, upto]
        for ids, upto, table in ((*out[:2], self.bytes_a), (*out[2:], self.bytes_b)):
            # parts of the right length, byte by byte
            own = np.repeat(spelled, np.diff(upto))
            bytes_in = np.repeat(spelled, size)
            differs = np.flatnonzero(table.bytes_of(ids[own]) != whole[bytes_in])
            part = np.repeat(np.arange(len(parts)), size)[bytes_in][differs]
            spelled = spelled.copy()
            spelled[part] = False
        return Encoded(*out, spelled)


class Aligned:
    """Groups, links and spelled-out groups of each spelled part of ``encoded``."""

    def __init__(self, known: Aligner, encoded: Encoded):
        n = len(encoded.spelled)
        size_a, size_b = (np.diff(u) * encoded.spelled for u in (encoded.upto_a, encoded.upto_b))
        a = encoded.a[spread(encoded.upto_a[:-1], size_a)]
        b = encoded.b[spread(encoded.upto_b[:-1], size_b)]
        # ends in one count of bytes: the parts follow each other, and a part's end is common
        ends_a, ends_b = np.cumsum(known.bytes_a.size[a]), np.cumsum(known.bytes_b.size[b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        n_a, n_b = (np.bincount(g, minlength=len(common)) for g in (group_a, group_b))
        first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        part_of = np.repeat(np.arange(n), size_a)[first_a] if len(common) else np.zeros(0, np.int64)

        # every token of A with every one of B in its group; large groups by their distinct ids
        large = n_a * n_b > LARGE_GROUP
        partners = np.where(large, 0, n_b)[group_a]
        pair = np.repeat(a, partners) * known.size_b + b[spread(first_b[group_a], partners)]
        part = np.repeat(part_of[group_a], partners)
        times = np.ones(len(pair), np.int64)
        for g in np.flatnonzero(large):
            ids_a, ids_b = a[first_a[g] : first_a[g] + n_a[g]], b[first_b[g] : first_b[g] + n_b[g]]
            counted = pair_counts([(ids_a.tolist(), ids_b.tolist())], known.size_b)
            pair = np.append(pair, list(counted))
            times = np.append(times, list(counted.values()))
            part = np.append(part, np.full(len(counted), part_of[g]))
        order = np.argsort(part, kind="stable")
        self.pairs, self.times = pair[order], times[order]
        self.upto = np.append(0, np.cumsum(np.bincount(part, minlength=n)))
        n_links = np.bincount(part_of, weights=n_a * n_b, minlength=n).astype(np.int64)
        n_groups = np.bincount(part_of, minlength=n)
        self.stats = np.stack([size_a, size_b, n_groups, n_links, ~encoded.spelled], 1).astype(np.int64)

        # tokens in the order of the text of groups, A before B, and what follows each
        ids = np.empty(len(a) + len(b), np.int64)
        at_a, at_b = np.arange(len(a)) + first_b[group_a], np.arange(len(b)) + (first_a + n_a)[group_b]
        ids[at_a], ids[at_b] = a, b
        text = known.decimals.bytes_of(ids)
        ends = np.cumsum(known.decimals.size[ids])
        text[ends[at_a[first_a + n_a - 1]] - 1] = ord("|")
        text[ends[at_b[first_b + n_b - 1]] - 1] = ord(";")
        upto, text = np.append(0, ends)[np.append(0, np.cumsum(size_a + size_b))].tolist(), text.tobytes()
        self.texts = [text[i:j] for i, j in zip(upto, upto[1:])]


def distinct(parts: list[str]) -> tuple[list[str], np.ndarray]:
    """The different parts, and the place of each part among them."""
    coded = pa.array(parts, pa.string()).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)


def aligner(paths: tuple[str, str]) -> Aligner:
    if paths not in _aligners:
        _aligners[paths] = Aligner(*paths)
    return _aligners[paths]


def list_array(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def held_rows(block: int, ids, stats: np.ndarray, digests: list, bounds: np.ndarray, pairs, times) -> pa.RecordBatch:
    """HELD rows: documents whose pairs lie between ``bounds``, and one row for the block."""
    n = len(digests)
    of_block, docs = np.unique(pairs, return_counts=True)
    bounds = np.append(bounds, bounds[-1] + len(of_block))
    columns = [
        pa.array(np.full(n + 1, block, np.int64)),
        pa.array([False] * n + [True]),
        pa.array([*ids, None], pa.int64()),
        *(pa.array(np.append(stats[:, i], 0)) for i in range(4)),
        pa.array([*digests, None], pa.string()),
        list_array(np.append(pairs, of_block), bounds),
        list_array(np.append(times, docs.astype(np.int64)), bounds),
    ]
    names = "block of_block doc_id n_a n_b n_groups n_links groups_sha256 pairs times"
    return pa.RecordBatch.from_arrays(columns, names.split())


def align_block(known: Aligner, block: int, ids: list, texts: list[str]) -> pa.RecordBatch:
    """HELD rows of texts, each handled whole; null is empty."""
    parts = [CUT.split(t or "") for t in texts]
    sizes = np.array([len(p) for p in parts], np.int64)
    different, place = distinct([p for of_text in parts for p in of_text])
    del parts
    own = Aligned(known, known.encoded(different))
    text_of = np.repeat(np.arange(len(texts)), sizes)
    stats = np.zeros((len(texts), 5), np.int64)
    np.add.at(stats, text_of, own.stats[place])
    spelled = stats[:, 4] == 0
    stats[~spelled] = 0
    digests, at, places = [], 0, place.tolist()
    for n, well in zip(sizes.tolist(), spelled.tolist()):
        spelling = b"".join([own.texts[i] for i in places[at : at + n]])[:-1] if well else None
        digests.append(hashlib.sha256(spelling).hexdigest() if well else "")
        at += n
    kept = spelled[text_of]
    place, text_of = place[kept], text_of[kept]
    counts = own.upto[place + 1] - own.upto[place]
    source = spread(own.upto[place], counts)
    pairs, times, text_of = own.pairs[source], own.times[source], np.repeat(text_of, counts)
    # the pairs of a text, each once
    order = np.lexsort((pairs, text_of))
    pairs, times, text_of = pairs[order], times[order], text_of[order]
    first = np.flatnonzero(np.append(True, (pairs[1:] != pairs[:-1]) | (text_of[1:] != text_of[:-1])))
    if len(pairs):
        times = np.add.reduceat(times, first)
        pairs, text_of = pairs[first], text_of[first]
    bounds = np.searchsorted(text_of, np.arange(len(texts) + 1))
    return held_rows(block, ids, stats, digests, bounds, pairs, times)


def align_whole(paths: tuple[str, str]):
    """Rows (doc_id, text) to HELD, in blocks of about ``BLOCK_BYTES``."""

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
            block = size // BLOCK_BYTES
            for own in np.unique(block):
                lo, hi = np.searchsorted(block, [own, own + 1])
                part = batch.slice(lo, hi - lo)
                yield align_block(aligner(paths), number, part.column("doc_id").to_pylist(), part.column("text").to_pylist())
                number += 1

    return run


def segments(batches):
    """Rows (row, doc_id, text) to SEGMENTS of about ``CHUNK_BYTES``, cut where parts are."""
    for batch in batches:
        for row, doc_id, text in zip(*(batch.column(c) for c in ("row", "doc_id", "text"))):
            row, doc_id, text = row.as_py(), doc_id.as_py(), text.as_py()
            out, at, begin, size, last = [], 0, 0, 0, 0
            for cut in [*(m.start() for m in CUT.finditer(text)), len(text)]:
                size += len(text[last:cut].encode())
                last = cut
                if size >= CHUNK_BYTES or cut == len(text):
                    own = text[begin:cut]
                    out.append((row, doc_id, at, own))
                    at += 1 + len(own.encode())  # the space before it is its own
                    begin, size = cut + 1, 0
            columns = zip(*out)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["row", "doc_id", "at", "text"]
            )


def fragment_rows(rows: list[dict]) -> pa.Table:
    lists = [(c, pa.list_(pa.int32())) for c in LISTS]
    fields = [("row", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64())]
    return pa.Table.from_pylist(rows, pa.schema(fields + [("spelled", pa.bool_()), ("meets", pa.bool_())] + lists))


NOTHING = {"spelled": False} | Fragment([], ([], [])).lists()


def fragments(paths: tuple[str, str]):
    """SEGMENTS to FRAGMENTS, one for each byte range of ``CHUNK_BYTES`` that a segment has tokens in."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                known, name = aligner(paths), {c: r[c] for c in ("row", "doc_id")}
                different, place = distinct(CUT.split(r["text"]))
                of_part = known.encoded(different)
                if not of_part.spelled.all():
                    yield from fragment_rows([name | NOTHING | {"at": r["at"]}]).to_batches()
                    continue
                ids_a = of_part.a[spread(of_part.upto_a[place], np.diff(of_part.upto_a)[place])]
                ids_b = of_part.b[spread(of_part.upto_b[place], np.diff(of_part.upto_b)[place])]
                ends_a = r["at"] + np.cumsum(known.bytes_a.size[ids_a])
                ends_b = r["at"] + np.cumsum(known.bytes_b.size[ids_b])
                a, b = ids_a.tolist(), ids_b.tolist()
                out = []
                for at in range(r["at"] // CHUNK_BYTES * CHUNK_BYTES, int(ends_a[-1]), CHUNK_BYTES):
                    # the tokens that end in (at, at + CHUNK_BYTES]
                    i, upto_i = np.searchsorted(ends_a, [at, at + CHUNK_BYTES], "right").tolist()
                    j, upto_j = np.searchsorted(ends_b, [at, at + CHUNK_BYTES], "right").tolist()
                    if i < upto_i or j < upto_j:
                        own = met(a[i:upto_i], ends_a[i:upto_i].tolist(), b[j:upto_j], ends_b[j:upto_j].tolist())
                        out.append(name | {"at": max(at, r["at"]), "spelled": True} | Fragment(*own).lists())
                yield from fragment_rows(out).to_batches()

    return run


def compose(near: pa.Table) -> pa.Table:
    """Neighbouring fragments of one text to their fragment."""
    rows = sorted(near.to_pylist(), key=lambda r: r["at"])
    name = {c: rows[0][c] for c in ("row", "doc_id", "at")}
    if not all(r["spelled"] for r in rows):
        return fragment_rows([name | NOTHING])
    whole = Fragment.read(rows[0])
    for r in rows[1:]:
        whole.add(Fragment.read(r))
    return fragment_rows([name | {"spelled": True} | whole.lists()])


def finished(size_b: int):
    """The fragments of whole texts to HELD rows, each text a block."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                whole = Fragment.read(r)
                groups = [whole.head, *whole.groups] if r["spelled"] else []
                found = sorted(pair_counts(groups, size_b).items())
                pairs, times = (np.array([f[i] for f in found], np.int64) for i in (0, 1))
                stats = [sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), times.sum()]
                digest = hashlib.sha256(spelled_groups(groups)).hexdigest() if groups else ""
                bounds = np.array([0, len(pairs)])
                yield held_rows(-1 - r["row"], [r["doc_id"]], np.array([stats]), [digest], bounds, pairs, times)

    return run


def rate(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """Documents of a block and the counts of its pairs to ALIGNED rows."""
    docs = docs.combine_chunks()
    pair = counts.column("pair").to_numpy()
    order = np.argsort(pair)
    pair = pair[order]
    count = counts.column("documents").to_numpy()[order]
    best = counts.column("best").to_numpy(zero_copy_only=False).astype(bool)[order]
    pairs, times = docs.column("pairs").combine_chunks(), docs.column("times").combine_chunks()
    bounds = np.append(0, np.cumsum(pc.list_value_length(pairs).to_numpy(zero_copy_only=False)))
    at = np.searchsorted(pair, pairs.flatten().to_numpy())
    times = times.flatten().to_numpy()

    def summed(values):
        return pa.array(np.append(0, np.cumsum(values))[bounds[1:]] - np.append(0, np.cumsum(values))[bounds[:-1]])

    columns = {c: docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    columns |= {"n_best": summed(times * best[at]), "count_sum": summed(times * count[at])}
    return pa.table(columns | {"groups_sha256": docs.column("groups_sha256")})


def long_texts(docs: DataFrame, paths: tuple[str, str]) -> tuple[DataFrame | None, str]:
    """HELD rows of the texts over ``CHUNK_BYTES``, composed in rounds; the stage they are read from."""
    rows, path = stage(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "long")
    longest = rows.agg(F.max(F.octet_length("text"))).first()[0]
    if longest is None:
        return None, path
    cut = rows.mapInArrow(segments, SEGMENTS)
    spread = cut.repartition("row", "at")  # a text's segments go to many tasks
    now, width = spread.mapInArrow(fragments(paths), FRAGMENTS), CHUNK_BYTES
    while width <= longest + 1:
        width *= FAN
        now = now.withColumn("near", F.floor(F.col("at") / width))
        now = now.groupBy("row", "near").applyInArrow(lambda rows: compose(rows.drop_columns("near")), FRAGMENTS)
    return now.mapInArrow(finished(aligner(paths).size_b), HELD), path


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Tokens, groups, links and the corpus-wide counts of the links of each document."""
    spark, paths = docs.sparkSession, (path_a, path_b)
    size_b = aligner(paths).size_b
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    is_long = F.coalesce(F.octet_length("text") > CHUNK_BYTES, F.lit(False))
    short = rows.where(~is_long).mapInArrow(align_whole(paths), HELD)
    long, long_at = long_texts(rows.where(is_long), paths)
    held, held_at = stage(short if long is None else short.unionByName(long), "held")
    drop(spark, long_at)

    of_block = held.where("of_block").select("block", F.explode(F.arrays_zip("pairs", "times")).alias("held"))
    of_block = of_block.select("block", F.col("held.pairs").alias("pair"), F.col("held.times").alias("documents"))
    counts = of_block.groupBy("pair").agg(F.sum("documents").alias("documents"))
    counts = counts.withColumn("a", F.expr(f"pair div {size_b}"))
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))
    counts = counts.join(most, "a").select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))
    near = of_block.select(F.col("block").alias("of"), "pair").join(counts, "pair")
    done = (
        held.where("not of_block")
        .drop("of_block")
        .groupBy("block")
        .cogroup(near.groupBy("of"))
        .applyInArrow(rate, ALIGNED)
    )
    result, _ = stage(done, "aligned")
    drop(spark, held_at)
    return result
