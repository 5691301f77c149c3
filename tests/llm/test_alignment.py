from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from public_tokenizers import path

from tests.llm.conftest import frame, sentence
from tidemark.llm import alignment

PATHS = tuple(path(name) for name in alignment.TOKENIZERS)
STORED = [f"<0x{b:02X}>" for b in range(256)]


@pytest.fixture(scope="module")
def coders():
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, decoders.ByteLevel(), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def bytes_of_b(b, token):
    piece = b.id_to_piece(token)
    return bytes([STORED.index(piece)]) if piece in STORED else piece.replace("▁", " ").encode()


def bytes_of_a(a, token):
    """Undo the byte-level spelling character by character."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in own]
    return bytes(ord(c) if ord(c) < 256 else others[ord(c) - 256] for c in a.id_to_token(token))


def groups_of(coders, text):
    """Groups of a whole text, encoded in one go; None if it isn't spelled."""
    a, _, b = coders
    if not text:
        return None
    ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    spelled = [bytes_of_a(a, i) for i in ids[0]], [bytes_of_b(b, i) for i in ids[1]]
    if any(b"".join(s) != (" " + text).encode() for s in spelled):
        return None
    ends = []
    for s in spelled:
        at, own = 0, []
        for piece in s:
            at += len(piece)
            own.append(at)
        ends.append(own)
    groups, at = [], [0, 0]
    for end in sorted(set(ends[0]) & set(ends[1])):
        upto = [own.index(end, i) + 1 for own, i in zip(ends, at)]
        groups.append([i[x:y] for i, x, y in zip(ids, at, upto)])
        at = upto
    return groups


def brute(coders, rows):
    all_groups = [groups_of(coders, t) for _, t in rows]
    links = [Counter((x, y) for a, b in g or [] for x in a for y in b) for g in all_groups]
    count = Counter(p for own in links for p in own)
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for (doc_id, _), groups, own in zip(rows, all_groups, links):
        groups = groups or []
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append(
            (
                doc_id,
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                sum(own.values()),
                sum(n for p, n in own.items() if count[p] == most[p[0]]),
                sum(n * count[p] for p, n in own.items()),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        )
    return out


ODD = [
    " lead and tail ", "  ", " ", "\n", "a b c", "a▁b", "x ▁ y", "<s> hi</s> <|endoftext|> <0x0A> <unk>",
    "don't  stop\t\tnow \n\n we'll 12 345", "日本語 の テキスト", "😀 😀😀 é ﻿ z", "a\x00b \x01 c",
    " x ᠎ y   z\u0085 w", "x" * 3000, "ab" * 1500 + " " + "1" * 500, "ﬁ ½ ² ok", "...!? -- ,a",
]


def test_documents_beside_brute_force(spark, corpus, coders):
    rows = [(i, t) for i, t in corpus if i != 408] + [(700 + i, t) for i, t in enumerate(ODD)]
    rows += [(703, "\n"), (800, "Die Straße ist länger als der Weg, " * 4)]
    got = alignment.aligned(frame(spark, rows), *PATHS).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(coders, rows), key=repr)


def test_long_texts_are_composed(spark, coders, monkeypatch):
    """Small chunks: many rounds, ranges that cut tokens and groups, texts without a cut."""
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 64)
    rng = random.Random(6)
    rows = [(i, sentence(rng, rng.choice([5, 100, 900]))) for i in range(8)]
    rows += [(20, "ab" * 400), (21, "日本語" * 90 + " " + "zq" * 200), (22, None), (23, ""), (24, "é " * 90 + "a▁b")]
    rows += [(25, rows[2][1]), (25, rows[2][1]), (None, rows[1][1])]
    assert got_with(spark, rows) == sorted(brute(coders, rows), key=repr)


def got_with(spark, rows):
    """In this process, so that the small chunks reach the functions."""
    known = alignment.aligner(PATHS)
    held = []
    for n, (doc_id, text) in enumerate(rows):
        if len((text or "").encode()) <= alignment.CHUNK_BYTES:
            held.append(alignment.align_block(known, n, [doc_id], [text]))
            continue
        batch = pa.RecordBatch.from_pydict({"row": [n], "doc_id": pa.array([doc_id], pa.int64()), "text": [text]})
        now = pa.Table.from_batches(alignment.fragments(PATHS)(alignment.segments([batch])))
        width = alignment.CHUNK_BYTES
        while now.num_rows > 1:
            width *= 3
            near = defaultdict(list)
            for r in now.to_pylist():
                near[r["at"] // width].append(r)
            now = pa.concat_tables(alignment.compose(alignment.fragment_rows(own)) for own in near.values())
        held += alignment.finished(known.size_b)(now.to_batches())
    table = pa.Table.from_batches(held)
    docs, blocks = table.filter(pc.invert(of_block(table))), table.filter(of_block(table))
    count = Counter()
    for pairs, times in zip(blocks.column("pairs").to_pylist(), blocks.column("times").to_pylist()):
        count.update(dict(zip(pairs, times)))
    most = defaultdict(int)
    for p, n in count.items():
        most[p // known.size_b] = max(most[p // known.size_b], n)
    counts = pa.table(
        {
            "pair": pa.array(list(count), pa.int64()),
            "documents": pa.array(list(count.values()), pa.int64()),
            "best": [n == most[p // known.size_b] for p, n in count.items()],
        }
    )
    rated = alignment.rate(docs, counts)
    names = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    return sorted((tuple(r[c] for c in names) for r in rated.to_pylist()), key=repr)


def of_block(table):
    return table.column("of_block")


def test_long_texts_across_tasks(spark, coders):
    rng = random.Random(7)
    long = sentence(rng, 50_000)
    rows = [(1, long), (2, "short text"), (1, long), (3, "x" * 70_000), (4, long[:150_000] + "▁"), (5, None)]
    assert sum(len((t or "").encode()) > alignment.CHUNK_BYTES for _, t in rows) == 4
    got = alignment.aligned(frame(spark, rows), *PATHS).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(coders, rows), key=repr)


def test_composing_is_associative():
    rng = random.Random(8)
    for _ in range(200):
        n = rng.randint(1, 40)
        ends = [sorted({n, *rng.sample(range(1, n + 1), rng.randint(0, n))}) for _ in (0, 1)]
        ids = [[100 * side + i for i in range(len(ends[side]))] for side in (0, 1)]
        cuts = sorted({0, n, *rng.sample(range(n + 1), rng.randint(0, min(n, 6)))})
        parts = []
        for lo, hi in zip(cuts, cuts[1:]):
            own = [[(i, e) for i, e in zip(ids[s], ends[s]) if lo < e <= hi] for s in (0, 1)]
            if own[0] or own[1]:
                args = [x for s in (0, 1) for x in ([i for i, _ in own[s]], [e for _, e in own[s]])]
                parts.append(alignment.Fragment.read(alignment.Fragment(*alignment.met(*args)).lists()))
        while len(parts) > 1:
            at = rng.randrange(len(parts) - 1)
            parts[at].add(parts.pop(at + 1))
        whole, _ = alignment.met(ids[0], ends[0], ids[1], ends[1])
        assert [parts[0].head, *parts[0].groups] == whole and parts[0].tail == ([], [])


def test_no_documents(spark):
    assert alignment.aligned(frame(spark, [(1, "a")]).where("false"), *PATHS).collect() == []
    got = alignment.aligned(frame(spark, [(1, None)]), *PATHS).collect()
    assert [tuple(r) for r in got] == [(1, 0, 0, 0, 0, 0, 0, "")]
