"""Scores, counts, codes and archives of single texts."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import struct
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import LOWER, SPACE, frame, sentence
from tidemark.llm import bpe, decontaminate, pii, quality, tokens, toxicity, warc

VOCABULARY = path(tokens.TOKENIZER)
ODD = [
    (900, "It's Σίσυφος ΣΣ <|endoftext|>a <|startoftext|><|endoftext|>x é ok\x00\x1c1234 İst ǅ 字 🙂🙂 'S we'll"),
    (901, "x" * 3000),
    (902, "ab\tcd\r\n" * 400),
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_codes_equal_the_library(spark, corpus, library):
    rows = corpus + ODD
    want = Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        want[i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    docs = frame(spark, rows)
    assert Counter(map(tuple, bpe.encoded(docs, VOCABULARY, texts=False).collect())) == want
    for r in bpe.encoded(docs.where("doc_id = 900"), VOCABULARY).collect():
        assert list(struct.iter_unpack("<I", r.ids)) == [(i,) for i in library.encode(ODD[0][1], add_special_tokens=False).ids]
    assert bpe.encoded(docs.limit(0), VOCABULARY).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_codes_like_the_library(text):
    known = test_any_text_codes_like_the_library.__dict__.setdefault("t", Tokenizer.from_file(VOCABULARY))
    ids = known.encode(text, add_special_tokens=False).ids
    packed, decoded = bpe.coder(VOCABULARY).both(text)
    assert packed == struct.pack(f"<{len(ids)}I", *ids)
    assert decoded.decode() == known.decode(ids, skip_special_tokens=False)
    assert tokens.encoder(VOCABULARY).count([text]) == [len(ids)]


@pytest.mark.parametrize("chunk, overlap", [(1 << 15, 256), (300, 4)])
def test_token_counts_equal_the_library(spark, corpus, library, chunk, overlap):
    rows = corpus + ODD
    want = Counter()
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want[i, len((t or "").encode()), n, n > 2048] += 1
    found = tokens.token_counts(frame(spark, rows), VOCABULARY, chunk_chars=chunk, overlap=overlap)
    assert Counter(map(tuple, found.collect())) == want
    assert tokens.token_counts(frame(spark, [], 1), VOCABULARY).collect() == []


def judged(text):
    words = SPACE.findall(text or "")
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    times = Counter(windows)
    covered = set()
    for k, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(k, k + 8))
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 20 or 100 * len(covered) > 30 * len(words),
    )


def test_quality_counts_equal_brute_force(spark, corpus):
    rows = corpus + [(910, "# a*b\n\nx y\nx y\n" + "p q r s t u v w x " * 3), (911, "a b c d e f g h " * 9)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(50)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows)
    found = quality.quality_rules(docs, labels)
    got = Counter((r.doc_id, *(r[c] for c in quality.COUNTED), r.base_failed) for r in found.collect())
    assert got == Counter((i, *judged(t)) for i, t in rows)
    assert not found.where("kept and base_failed").count()
    kept = quality.kept_only(docs, labels)
    assert kept.columns == docs.columns and kept.count() == found.where("kept").count()
    assert quality.quality_rules(docs.limit(0), labels).collect() == []
    none = quality.quality_rules(docs, labels.limit(0))
    assert none.where("kept = base_failed or score != 0").count() == 0


def test_quality_scores_are_the_ratio_of_the_counts(spark):
    rules = quality.Rules(buckets=1 << 10, smoothing=2.0)
    rows = [(i, "good clean words here " * 6) for i in range(5)] + [(9, "spam!! junk!! buy!! now!! " * 6)]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in quality.quality_rules(docs, labels, rules).collect()}

    spelled = spark.createDataFrame([(w,) for w in {w for _, t in rows for w in t.split()}], "w string")
    code = {r.w: r.h for r in spelled.select("w", F.xxhash64("w").alias("h")).collect()}
    pairs = {(code[a], code[b]) for _, t in rows for a, b in zip(t.split(), t.split()[1:])}
    hashed = spark.createDataFrame(list(pairs), "a long, b long").select("a", "b", F.xxhash64("a", "b").alias("h"))
    code2 = {(r.a, r.b): r.h for r in hashed.collect()}

    def buckets(text):
        words = [code[w] for w in text.split()]
        return [h % rules.buckets for h in words + [code2[p] for p in zip(words, words[1:])]]

    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(buckets(t))
        target.update(buckets(t) if i in (0, 1) else [])
    scale = target.total() / raw.total()
    for i, t in rows:
        ratio = [np.log((target[b] + 2) / (raw[b] * scale + 2)) for b in buckets(t)]
        assert got[i] == pytest.approx(np.mean(ratio), abs=1e-8)
    assert got[9] < 0 < got[0]


def test_toxicity_learns_words_and_their_misspellings(spark):
    import random

    rng = random.Random(2)
    bad = ["idiotic", "moronic", "wretched"]
    rows, labels = [], []
    for i in range(500):
        words = sentence(rng, 60).split(" ")
        if i % 3 == 0:
            words[rng.randrange(60)] = rng.choice(bad)
            words[rng.randrange(60)] = rng.choice(bad)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 3 == 0)))
    rows += [(1000, "some idiotik words in here"), (1001, None), (1002, ""), (None, rows[0][1])]
    table = spark.createDataFrame(labels + [(None, 1, 1), (5000, 1, 1)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows)
    model = toxicity.fitted(docs, table, toxicity.Settings(buckets=1 << 14, sample_docs=400))
    found = {r.doc_id: r for r in toxicity.toxicity(docs, model).collect()}
    held = [found[i] for i in range(500) if found[i].held_out]
    assert 60 < len(held) < 140
    right = sum((r.doc_id % 3 == 0) == bool(r.predicted) for r in held)
    assert right >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())
    assert found[1000].score > 0.5 > found[1001].score == found[1002].score
    assert found[None].score == found[0].score and found[None].held_out is False
    assert toxicity.toxicity(docs.limit(0), model).collect() == []
    flat = toxicity.fitted(docs, table.where("toxic = 0"))
    assert {r.score for r in toxicity.toxicity(docs, flat).collect()} == {0.0}


BASE = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(BASE):
        for m in pattern.finditer(text):
            digits = "".join(c for c in m[0] if c.isdigit())
            good = [
                lambda: True,
                lambda: all(int(p) <= 255 for p in m[0].split(".")),
                lambda: 14 <= len(digits) <= 19 and luhn(digits),
                lambda: 10 <= len(digits) <= 15,
            ]
            if good[kind]():
                out.append((m.start(), kind, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@+- (é0425\n_", max_size=50))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_personal_data(spark, corpus):
    rows = corpus + [(920, f"é mail a{i}@b.cd now") for i in range(2)]
    rows += [(930 + i, f"card 4111 1111 1111 111{i} ip 1.2.3.{i}, +1 (555) 123-456{i}; 999.1.1.1 x@y") for i in range(4)]
    rows += [(940 + i, f"my badge number 41111111111111{i}") for i in range(9)]
    rows += [(960 + i, f"my badge number QX77{i}31 ok") for i in range(3)]
    rows += [(980 + i, f"my badge number {4111111111111111 if i == 0 else 5500005555555559}") for i in range(2)]
    docs = frame(spark, rows)
    found = pii.personal_data(docs, pii.Rounds(least_support=1, reliable=0.1, accept=0.1)).collect()
    text_of = Counter()
    for i, t in rows:
        spans = plain_spans(t or "")
        digest = hashlib.sha256(pii.named(spans).encode()).hexdigest()
        text_of[i, *(sum(k == kind for _, k, _ in spans) for kind in range(4)), digest] += 1
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in found) == text_of
    by_id = {r.doc_id: r for r in found}
    assert by_id[960].spans == "identifier:16:23"  # met in the context of card numbers
    assert pii.personal_data(docs).where("n_identifier > 0 and doc_id < 400").count() == 0
    clean = pii.redacted(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    texts = {r.doc_id: r.text for r in clean.where("doc_id in (920, 930, 3, 400)").collect()}
    assert texts[920] == "é mail [email] now" and texts[400] is None and texts[3] == dict(corpus)[3]
    assert pii.personal_data(docs.limit(0)).collect() == []


def test_registered_rounds_find_a_kind_without_seeds_and_no_stop_words(spark):
    rng = random.Random(8)
    common = ["the", "of", "and", "one", "is", "to"]
    prose = lambda n: " ".join(rng.choice(common) for _ in range(n))
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    secrets = {i: hexes(40) for i in range(40)} | {i: f"k{i}9xyz" for i in range(40, 44)}
    rows = [(i, f'{prose(60)} token = "{s}" {prose(60)}') for i, s in secrets.items()]
    # stop words stand beside seeds and beside numbers that are none
    rows += [(100 + i, f"{prose(60)} the 10.0.{i}.7 and {prose(60)}") for i in range(60)]
    numbers = [(200 + i, f"{prose(60)} the {50000000 + i} and {prose(60)}") for i in range(20)]
    found = {r.doc_id: r for r in pii.personal_data(frame(spark, rows + numbers)).collect()}
    texts = dict(rows + numbers)
    for i, secret in secrets.items():
        start = texts[i].index(secret)
        assert found[i].spans == f"identifier:{start}:{start + len(secret)}"
    assert all(found[100 + i].n_ip == 1 and found[200 + i % 20].n_identifier == 0 for i in range(60))


def test_rounds_go_on_until_nothing_new_is_accepted(spark):
    # each link of the chain is known by strings that the link before made known
    rows = [f"label0 10.1.1.{k}" for k in range(6)]
    for link in range(7):
        rows += [f"label{link} {link}chain{k}" for k in range(6)] + [f"label{link + 1} {link}chain{k}" for k in range(6)]
    rest = "some other words follow here " * 9
    docs = frame(spark, [(n, f"before{n} {t} after{n} {rest}") for n, t in enumerate(rows)])
    found = {r.doc_id: r.n_identifier for r in pii.personal_data(docs).collect()}
    assert found == {n: int("chain" in t) for n, t in enumerate(rows)}
    some = pii.personal_data(docs, pii.Rounds(rounds=3)).agg(F.sum("n_identifier")).first()[0]
    assert 0 < some < sum(found.values())


def test_background_counts_the_contexts_of_mentions():
    rng = random.Random(2)
    for _ in range(200):
        pieces = ['key="a1b2c3d4"', "x=", "=", "the", "(edge)", "Word,", "a1b2c3d4", "z==12345678", "...", "+1"]
        text = " ".join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))
        met = pii.Contexts()
        met.add(text)
        assert sum(met.one.values()) == sum(met.two.values()) == sum(met.after.values()) == met.tokens
        own = [m[4:] for m in pii.mentions(text, [], 6)]
        assert not Counter(m[0] for m in own) - met.one and not Counter(m[2] for m in own) - met.after
        assert not Counter(m[1] for m in own) - Counter({" ".join(k): n for k, n in met.two.items()})


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_contaminated_words_equal_brute_force(spark, corpus):
    texts = dict(corpus)
    rows = corpus + [(950, f"x y {texts[40][:150]} z {texts[41].upper()}"), (951, "Alpha-beta-GAMMA"), (952, "one")]
    bench = [(str(i), texts[i][: 20 * i]) for i in range(30, 48)]
    bench += [("a", "alpha beta gamma"), ("b", "ALPHA beta gamma"), ("c", "one"), ("d", ""), ("e", None)]
    bench += [(None, "alpha beta"), ("41", texts[41]), ("41", texts[41])]
    items = spark.createDataFrame(bench, "item_id string, text string")

    def words(text):
        return WORD.findall((text or "").translate(LOWER))

    windows = defaultdict(set)
    for item, text in bench:
        w = words(text)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w and item is not None else 0):
            windows[tuple(w[k : k + n])].add(item)
    want = Counter()
    for i, t in rows:
        w, hit, met = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    met |= windows[tuple(w[k : k + n])]
        digest = hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
        want[i, len(w), len(hit), len(met), digest, bool(hit)] += 1
    docs = frame(spark, rows)
    found = decontaminate.decontaminate(docs, items)
    assert Counter(map(tuple, found.drop("items", "spans", "text_hash").collect())) == want
    assert all(sum(s.end - s.start for s in r.spans) == r.n_hit for r in found.collect())
    clean = decontaminate.clean_only(docs, items)
    assert clean.columns == docs.columns
    assert clean.count() == sum(n for row, n in want.items() if not row[-1])
    assert decontaminate.decontaminate(docs, items.limit(0)).where("contaminated").count() == 0
    assert decontaminate.decontaminate(docs.limit(0), items).collect() == []


def test_winnowing_meets_every_window():
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 5, 500, dtype=np.uint64)  # many ties
    kept = set(decontaminate.selected(hashes, np.zeros(500, int), 6).tolist())
    for s in range(495):
        window = hashes[s : s + 6]
        assert s + max(k for k in range(6) if window[k] == window.min()) in kept


def test_archive_round_trip(spark):
    pages = [(i, f"http://h{i % 5}.example.org/{i % 7}?q={i}", f"<p>{i % 9}é</p>" * (i % 4)) for i in range(60)]
    pages += [(None, "http://a.b/c", "dup"), (1001, "http://a.b/c", "dup"), (1000, None, "dup"), (1003, "no url [", None)]
    pages += [(1003, "no url [", None), (1004, "HTTP://Ex.Com:8080/x", "y\r\n\r\nWARC/1.1")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    store = warc.write_archive(table)
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = Counter()
    for i, _, h in pages:
        data = (h or "").encode()
        one = first[h or ""]
        sha1 = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want[i, len(data), sha1, "response" if i == one else "revisit", None if i == one else one] += 1
    assert Counter(map(tuple, store.read_all().collect())) == want
    asked = spark.createDataFrame([("http://a.b/c",), ("http://h3.example.org/3?q=3",), ("http://none/",), (None,)], "url string")
    met = sorted((r.url, r.page_id, r.record_type) for r in store.lookup(asked).collect() if r.page_id)
    assert met == [("http://a.b/c", 1001, "revisit"), ("http://h3.example.org/3?q=3", 3, "response")]
    assert warc.write_archive(table.limit(0)).read_all().collect() == []


def test_url_keys_sort_by_host():
    assert warc.url_key("https://www.Example.com/a?b=c") == "com,example,www)/a?b=c"
    assert warc.url_key("http://h:8080") == "h:8080)/"


def test_lookup_keeps_urls_apart_over_many_blocks(spark, monkeypatch):
    """Control characters, one very frequent URL, very long html, more captures than a block holds."""
    odd = ["http://a.b/x\ty", "http://a.b/xy", "http://a.b/z\n", "http://a.b/z", "http://a.b/%09\t", "http://a.b/\t%09", "http://a.b/%09%09"]
    rows = [(i, url, f"odd {i}") for i, url in enumerate(odd)]
    rows += [(100 + i, "http://hot.example/", f"body {i % 7}") for i in range(1500)]
    rows += [(5000 + i, f"http://h{i % 9}.example/{i}", "x" * (300_000 if i == 3 else 5)) for i in range(1200)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    monkeypatch.setattr(warc, "GIVEN_BYTES", 1000)
    store = warc.write_archive(table)
    assert store.directory.count() > 4
    asked = [*odd, "http://hot.example/", "http://h3.example/3", "http://a.b/none"]
    got = store.lookup(spark.createDataFrame([(u,) for u in asked], "url string")).collect()
    wanted = [(u, i) for i, u, _ in rows if u in asked]
    assert sorted((r.url, r.page_id) for r in got) == sorted(wanted)
    html = {i: h for i, _, h in rows}
    assert all(r.html == html[r.page_id] for r in got if r.record_type == "response")
    assert all(html[r.refers_to] == html[r.page_id] for r in got if r.record_type == "revisit")
