from __future__ import annotations

import random
import re

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, row string"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced(text):
    return SPACE.findall((text or "").translate(LOWER))


def frame(spark, rows, parts=3):
    """(doc_id, text) rows with the table's other columns and two clashing ones."""
    full = [(i, t, None if i is None else "en", "s", None if t is None else len(t), "x", None) for i, t in rows]
    return spark.createDataFrame(full, DOCS).repartition(parts)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(1, 5))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages, nulls, empty and odd ones."""
    rng = random.Random(5)
    texts = [sentence(rng, rng.choice([3, 12, 40, 90, 200])) for _ in range(50)]
    words = texts[7].split(" ")
    passage = sentence(rng, 60)
    rows = list(enumerate(texts))
    rows += [(100, texts[3]), (101, texts[3]), (101, texts[3]), (102, texts[3].upper())]
    near = sentence(rng, 120).split(" ")
    for i in range(12):  # a chain of near copies
        rows.append((200 + i, " ".join(near[i : i + 100])))
    for i in range(6):
        rows.append((300 + i, f"{sentence(rng, 30)}\n{passage}\n{sentence(rng, 10)}"))
    rows += [
        (None, texts[3]),
        (None, None),
        (400, None),
        (401, ""),
        (402, " \t\n "),
        (403, "a"),
        (404, "a" * 700),
        (405, "ab " * 300),
        (406, " ".join(words + ["tail"])),
        (407, "x\x00y   \U0001f600 " + texts[9]),
        (408, sentence(rng, 6000)),
    ]
    return rows
