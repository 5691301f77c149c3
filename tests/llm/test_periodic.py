from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tests.llm.conftest import frame
from tidemark.llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def planted(words, doc_id):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def brute(words, least=6, times=4):
    """Every stretch of each period that cannot be extended, its smallest period only."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, length, q) for (s, length), q in found.items())


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def expected(doc_id, text, plant):
    words = WORD.findall(text or "")
    words = planted(words, doc_id) if plant else words
    runs = brute(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(collapsed(words, runs).encode()).hexdigest(),
    )


def runs_in(words):
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    hashes = np.array([ids[w] * 7919 + 13 for w in words], np.uint64)
    return [tuple(r) for r in periodic.runs_of(hashes, np.zeros(len(words), np.int64), 6, 4).tolist()]


def test_runs_of_random_and_periodic_sequences():
    rng = random.Random(3)
    for _ in range(600):
        words = []
        while len(words) < rng.randint(0, 60):
            unit = [rng.choice("ab" if rng.random() < 0.6 else "abcdef") for _ in range(rng.randint(1, 6))]
            words += unit * rng.randint(1, 8) + unit[: rng.randint(0, len(unit))]
        assert runs_in(words) == brute(words), words


@pytest.mark.parametrize("least,times", [(2, 2), (3, 2), (9, 3), (4, 5)])
def test_other_lengths(least, times):
    rng = random.Random(least)
    for _ in range(200):
        words = [rng.choice("ab") for _ in range(rng.randint(0, 40))]
        got = periodic.runs_of(np.array([ord(w) for w in words], np.uint64), np.zeros(len(words), int), least, times)
        assert [tuple(r) for r in got.tolist()] == brute(words, least, times)


def test_long_sequences():
    """Runs of one word, of a long period, and a passage repeated far apart."""
    rng = random.Random(8)
    passage = [str(rng.random()) for _ in range(40)]
    unit = [str(i) for i in range(500)]
    words = ["a"] * 30_000 + passage + unit * 9 + unit[:77] + passage * 3 + ["b"] + passage * 5
    assert runs_in(words) == [(0, 30_000, 1), (30_040, 4577, 500), (34_738, 200, 40)]
    many = [w for i in range(3000) for w in [*passage[:8], f"x{i}"]]
    assert runs_in(many) == []


@pytest.mark.parametrize("plant", [False, True])
def test_documents_beside_brute_force(spark, corpus, plant):
    rng = random.Random(4)
    rows = corpus + [
        (500, "Do do DO do do do do do"),
        (501, "do\n" * 6 + "end  "),
        (502, "\x00 \x00 \x00 \x00\t\x00 \x00 \x01"),
        (503, "a b a b a b a b c c c c c c a b a b a b a b"),
    ]
    rows += [(600 + i, " ".join(str(rng.randint(0, 40)) for _ in range(rng.randint(0, 90)))) for i in range(80)]
    rows.append((501, "do\n" * 6 + "end  "))
    got = periodic.digests(periodic.periodic_runs(frame(spark, rows), planted=plant)).collect()
    wanted = [expected(i, t, plant) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)


def test_texts_and_spans(spark):
    rows = [(1, "x  a b a b a b a b y"), (2, None), (3, "q")]
    found = {r.doc_id: r for r in periodic.periodic_runs(frame(spark, rows)).collect()}
    assert found[1].collapsed == "x a b y" and [tuple(r) for r in found[1].runs] == [(1, 8, 2)]
    assert (found[2].n_words, found[2].runs, found[2].collapsed) == (0, [], "")
    assert (found[3].n_words, found[3].runs, found[3].collapsed) == (1, [], "q")


def test_no_documents(spark):
    assert periodic.digests(periodic.periodic_runs(frame(spark, [(1, "a")]).where("false"))).collect() == []
