"""Byte-pair encoding and decoding with a merge queue over a linked list.

A word's symbols form a doubly linked list. Every adjacent pair that has a
merge rank sits in a priority queue as (rank, position); the lowest rank is
merged first, leftmost on ties, and the neighbours of a merged symbol queue
their new pairs. Entries whose symbols have changed meanwhile are stale and
skipped. Decoding concatenates vocabulary strings.

Normalising and splitting follow the vocabulary file: special tokens are cut
out of the raw text, then NFC, white space to spaces, lower case character by
character, and words by the file's pattern; bytes map to printable characters.
Pieces with characters that this Python's Unicode tables lack are normalised
and split by the tokenizers library (never encoded by it).

Defined results: a null or empty text has no tokens and decodes to an empty
text; repeated rows and rows without a doc_id each give a row; without
documents the result is empty.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tokens import batches_of

CACHED_WORDS = 300_000


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Coder:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.path, self.library = path, None
        model = spec["model"]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(model["merges"])}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.strings = {i: s for s, i in (self.ids | special).items()}
        names = sorted(map(regex.escape, special), key=len, reverse=True)
        self.specials = regex.compile("|".join(names)) if names else None
        splits = [
            p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"
        ]
        self.words = regex.compile(splits[0])
        self.byte = byte_characters()
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str, tuple[bytes, bytes]] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """Symbols after all merges, by rank and then from the left."""
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n
        rank = self.ranks.get
        queue = []
        for i in range(n - 1):
            r = rank((symbols[i], symbols[i + 1]))
            if r is not None:
                queue.append((r, i, symbols[i], symbols[i + 1]))
        heapq.heapify(queue)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = after[i] if alive[i] else n
            if j >= n or symbols[i] != a or symbols[j] != b:
                continue  # stale
            symbols[i] = a + b
            alive[j] = False
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                r = rank((symbols[i], symbols[k]))
                if r is not None:
                    heapq.heappush(queue, (r, i, symbols[i], symbols[k]))
            h = before[i]
            if h >= 0:
                r = rank((symbols[h], symbols[i]))
                if r is not None:
                    heapq.heappush(queue, (r, h, symbols[h], symbols[i]))
        return [s for s, here in zip(symbols, alive) if here]

    def word(self, word: str) -> bytes:
        """Ids of a normalised word in byte characters, as little-endian 32-bit integers."""
        found = self.known.get(word)
        if found is None:
            symbols = list(word)
            symbols[-1] += self.suffix
            ids = [self.ids[s] for s in self.merged(symbols) if s in self.ids]
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            found = self.known[word] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def split(self, text: str) -> list[str]:
        """Normalised words of a text without special tokens, in byte characters."""
        if not text.isascii() and any(unicodedata.category(c) == "Cn" for c in text):
            # newer than this Python's Unicode tables: ask the file's own rules
            rules = self.rules()
            return [w for w, _ in rules.pre_tokenizer.pre_tokenize_str(rules.normalizer.normalize_str(text))]
        text = unicodedata.normalize("NFC", text)
        # lower() has one rule that looks around: the final sigma
        text = text.replace("Σ", "σ").lower()
        byte = self.byte
        return ["".join([byte[b] for b in word.encode()]) for word in self.words.findall(text)]

    def rules(self):
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return self.library

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        return b"".join(map(self.word, self.split(text)))

    def encode(self, text: str) -> bytes:
        if self.specials is None:
            return self.plain(text)
        out, at = [], 0
        for hit in self.specials.finditer(text):
            out += [self.plain(text[at : hit.start()]), struct.pack("<I", self.special[hit[0]])]
            at = hit.end()
        return b"".join([*out, self.plain(text[at:])])

    def decode(self, ids: bytes) -> str:
        """Vocabulary strings one after the other, spaces between (the file names no decoder)."""
        strings = self.strings
        return " ".join([strings[i] for (i,) in struct.iter_unpack("<I", ids)])

    def piece(self, piece: str) -> tuple[bytes, bytes]:
        """(ids, decoded UTF-8) of what stands between white space."""
        found = self.pieces.get(piece)
        if found is None:
            ids = self.encode(piece)
            if len(self.pieces) >= CACHED_WORDS:
                self.pieces.clear()
            found = self.pieces[piece] = (ids, self.decode(ids).encode())
        return found

    def both(self, text: str) -> tuple[bytes, bytes]:
        """(ids, decoded UTF-8) of a whole text; white space never lies inside a token."""
        found = list(map(self.piece, text.replace("\n", " ").split(" ")))
        return b"".join([ids for ids, _ in found]), b" ".join([d for ids, d in found if ids])


_coders: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def encoded(docs: DataFrame, path: str, texts: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and with ``texts`` ids and decoded.

    ``ids`` is a binary column of little-endian unsigned 32-bit integers.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for part in batches_of(batch.column("text")):
                for ids, decoded in map(coder(path).both, part):
                    row = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest())
                    rows.append((*row, ids, decoded.decode()) if texts else row)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string()][: 5 if texts else 3]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names
            )

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids binary, decoded string" * texts
    names = [field.split()[0] for field in schema.split(", ")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, schema)
