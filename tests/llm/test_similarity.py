"""Joins and dedup by paragraphs and substrings, against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import frame, spaced
from tidemark.llm import jaccard, paragraphs, substrings, suffixes
from tidemark.llm.components import components


def shingles(text):
    words = spaced(text)
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def roots(sets):
    """Index of the component of each set, by comparing all pairs."""
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            common = len(x & sets[j])
            if x and sets[j] and 100 * common >= 75 * (len(x) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


def joined(rows):
    known = [(i, shingles(t)) for i, t in rows if i is not None]
    root = roots([s for _, s in known])
    least = {}
    for (i, _), r in zip(known, root):
        least[r] = min(i, least.get(r, i))
    out = {(i, s): least[r] if s else i for (i, s), r in zip(known, root)}
    return Counter((i, len(shingles(t)), None if i is None else out[i, shingles(t)]) for i, t in rows)


@pytest.mark.parametrize("often", ["counted", "all", "half"])
def test_join_equals_all_pairs(spark, corpus, monkeypatch, often):
    if often != "counted":
        table = np.ones(64, bool) if often == "all" else np.arange(64) % 2 == 0
        monkeypatch.setattr(jaccard, "frequent", lambda counts, join: table)
    found = jaccard.similar(frame(spark, corpus)).drop("text_hash").collect()
    assert Counter(map(tuple, found)) == joined(corpus)


def test_one_of_each_keeps_columns_and_one_row(spark, corpus):
    docs = frame(spark, corpus)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 3 in ids and not {100, 101} & set(ids) and ids.count(None) == 2
    assert max(Counter(i for i in ids if i is not None).values()) == 1


def test_join_without_rows(spark):
    assert jaccard.similar(frame(spark, [], 1)).collect() == []


def test_prefixes_of_linked_sets_share_a_key():
    rng = np.random.default_rng(1)
    join = jaccard.Join()
    for n in (1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 33, 64, 100, 257):
        base = rng.integers(1, 2**63, n, dtype=np.uint64)
        lost = jaccard.most_missing(n, 75)
        other = base[lost:]  # exactly 75 percent or more in common
        often = rng.random(32) < rng.choice([0, 0.5, 1])
        keys = []
        for values in (base, other):
            sets = object.__new__(jaccard.Sets)
            frequent = often[(values & np.uint64(31)).astype(int)]
            order = np.lexsort((values >> np.uint64(1), frequent))
            sets.hash, sets.often = values[order], frequent[order]
            sets.rows, sets.first = np.zeros(len(values), int), np.array([0, len(values)])
            keys.append(set(jaccard.prefix_keys(sets, join)[0].tolist()))
        assert n == 1 or keys[0] & keys[1]


def test_components_of_a_path_a_hub_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(7, 7)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {i: 0 for i in range(41)} | {100: 100} | {200 + i: 100 for i in range(50)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_paragraphs_equal_all_pairs(spark, corpus):
    found = paragraphs.deduplicated(frame(spark, corpus)).collect()
    lines = []
    for place, (i, t) in enumerate(corpus):
        for k, line in enumerate((t or "").split("\n") if t and i is not None else []):
            if len(spaced(line)) >= 25:
                lines.append((i, place, k, shingles(line)))
    root = roots([x[3] for x in lines])
    members = Counter(root)
    want = {}
    for r in members:
        if members[r] > 1:
            group = [x[:3] for x, q in zip(lines, root) if q == r]
            for i, place, k in group:
                n, gone, by = want.get(place, (0, 0, set()))
                want[place] = (n + 1, gone + ((i, place, k) != min(group)), by | {min(group)[0]})
    expected = Counter()
    for place, (i, t) in enumerate(corpus):
        n, gone, by = want.get(place, (0, 0, set()))
        expected[i, len(t.split("\n")) if t else 0, n, gone if i != 101 else -1, tuple(sorted(by))] += 1
    got = Counter(
        (r.doc_id, r.n_paragraphs, r.n_repeated, r.n_removed if r.doc_id != 101 else -1, tuple(r.kept_by))
        for r in found
    )
    assert got == expected  # which of the equal rows 101 goes first is not said


def test_short_lines_and_wrapped_passages_equal_all_pairs(spark):
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    some = lambda n: [word() for _ in range(n)]
    wrap = lambda w, n: "\n".join(" ".join(w[k : k + n]) for k in range(0, len(w), n))
    nine, passage, own = " ".join(some(9)), some(60), some(26)
    rows = [(i, f"{' '.join(some(30))}\n{nine}\n{' '.join(some(30))}") for i in range(5)]
    rows += [(10 + i, f"{' '.join(some(40))}\n\n{wrap(passage, 7 + 4 * i)}\n\n{' '.join(some(3))}") for i in range(3)]
    rows += [(20, " ".join(passage)), (21, f"{' '.join(own[:24])}\n{' '.join(own[24:])}"), (22, "one two\none two")]
    # every line, and every run of short ones, with all others
    units = []
    for i, t in rows:
        lines = t.split("\n")
        units += [(i, k, 1, line) for k, line in enumerate(lines) if len(spaced(line)) >= 5]
        short = [0 < len(spaced(line)) < 25 for line in lines] + [False]
        for k in range(len(lines)):
            if short[k] and not (k and short[k - 1]):
                upto = short.index(False, k)
                joined_up = " ".join(lines[k:upto])
                if upto - k > 1 and len(spaced(joined_up)) >= 25:
                    units.append((i, k, upto - k, joined_up))
    root = roots([shingles(u[3]) for u in units])
    want = {i: set() for i, _ in rows}
    for r in set(root):
        i, k, n = min(u[:3] for u, q in zip(units, root) if q == r)
        for u, q in zip(units, root):
            if q == r and (u[0] != i or u[1] >= k + n):
                want[u[0]] |= set(range(u[1], u[1] + u[2]))
    found = {r.doc_id: r for r in paragraphs.deduplicated(frame(spark, rows)).collect()}
    assert {i: set(r.removed) for i, r in found.items()} == want
    assert [found[i].removed for i in range(5)] == [[]] + [[1]] * 4
    assert len(want[11]) == 6 and want[20] == {0} and not want[10] and not want[21]
    assert all(found[i].n_removed == len(found[i].removed) for i in want)


def test_bands_reach_the_recall():
    for percent in (75, 80, 90):
        bands, rows = paragraphs.Banding(percent=percent).shape()
        assert 1 - (1 - (percent / 100) ** rows) ** bands >= 0.9995 and bands * rows <= 64


def test_lines_are_cut_by_position(spark):
    one = spark.createDataFrame([("a\nb\na", [0])], "t string, gone array<int>")
    assert one.select(paragraphs.without_lines(one["t"], one["gone"])).first()[0] == "b\na"


def substring_rows(rows, length=200):
    seen = Counter()
    for _, t in rows:
        data = (t or "").encode()
        seen.update(data[k : k + length] for k in range(len(data) - length + 1))
    out = Counter()
    for i, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if seen[data[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[i, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("most", [20_000, 2])
def test_substrings_equal_brute_force(spark, corpus, most):
    found = substrings.deduplicated(frame(spark, corpus), most_members=most).collect()
    assert Counter(map(tuple, found)) == substring_rows(corpus)


def test_substrings_when_repeated_strings_are_not_held(spark, corpus, monkeypatch):
    monkeypatch.setattr(substrings, "MOST_HELD", 0)
    found = substrings.deduplicated(frame(spark, corpus), most_members=2).collect()
    assert Counter(map(tuple, found)) == substring_rows(corpus)


def test_substrings_without_rows(spark):
    assert substrings.deduplicated(frame(spark, [], 1)).collect() == []


def test_deep_shallow_sorts_and_extents_are_exact():
    rng = random.Random(3)
    for _ in range(400):
        known = rng.choice([0, 3])
        head = bytes(rng.choice(b"ab") for _ in range(known))
        strings = list(
            {head + bytes(rng.choice(b"ab\0") for _ in range(rng.choice([0, 1, 5, 60]))) for _ in range(9)}
        )
        order, shared = suffixes.deep_shallow(strings, known)
        assert [strings[i] for i in order] == sorted(strings)
        assert shared == [suffixes.common(strings[a], strings[b]) for a, b in zip(order, order[1:])]
        trie = suffixes.Blind(strings, known)
        for i in range(len(strings)):
            trie.insert(i)
        assert trie.ordered() == (order, shared)
        pairs = list({(bytes(rng.choices(b"ab", k=4)), head + bytes(rng.choices(b"ab", k=6))) for _ in range(9)})
        left, right = [p[0] for p in pairs], [p[1] for p in pairs]
        for i, got in enumerate(suffixes.extents(left, right, 6, known)):
            met = [(0, 0)]
            for j in range(len(pairs)):
                back, ahead = suffixes.common(left[i], left[j]), suffixes.common(right[i], right[j])
                if i != j and back + ahead >= 6:
                    met.append((back, ahead))
            assert got == tuple(map(max, zip(*met)))
