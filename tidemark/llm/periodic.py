"""Runs of repeated word sequences in each text, by maximal pairs.

A run is a stretch of words with smallest period q, at least ``times`` periods
and ``least`` words long, that no neighbouring word extends. The suffixes of a
text that can take part are sorted, and their LCP-interval tree is walked from
the bottom. Each interval holds the list of its start positions in text order,
each with the class of the word on its left. When the lists of an interval's
children meet, two starts from different children and of different classes are
a maximal pair: the words after them agree for exactly the interval's length,
those before them do not. A maximal pair at distance d that agrees for l words,
l >= (times - 1) * d and l + d >= least, is a run of l + d words with period d,
and every run is such a pair, so nothing has to be extended.

The pair of a run's smallest period are neighbours in their interval's list: a
third start between them would give a smaller period. So lists are merged
small into large and only neighbours are compared, never all pairs of a list.

Only suffixes whose first words occur again in the text are sorted (a maximal
pair agrees for ``least_match`` words at least); the texts of a block are
sorted in one go, by doubling, with numpy. A text is handled whole in one task,
with some 100 bytes of memory per repeated word. Words are compared by 64-bit
hashes.

Defined results: null, empty and blank texts have no words, no runs and an
empty collapsed text; repeated rows and rows without a doc_id each give a row;
without documents the result is empty. Only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import GRAM_BASE, Texts, Words, blocks, mixed

# words are runs of anything but ASCII white space, their case kept; a separator is
# class 0 and NUL takes the place of the blank, which is none
CASED = np.arange(256, dtype=np.uint8)
CASED[[32, *range(9, 14)]] = 0
CASED[0] = 32

# words whose bytes are gathered in one step
GATHERED = 1 << 18

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
FOUND = f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string"


def least_match(least: int, times: int) -> int:
    """The fewest words for which the maximal pair of a run agrees."""
    return max(1, min(max(least, times * q) - q for q in range(1, least + 1)))


def own_order(words: Words, doc_ids: list) -> np.ndarray:
    """Each word stands for itself."""
    return np.arange(len(words))


def folded_order(words: Words, doc_ids: list) -> np.ndarray:
    """A tenth of the texts, chosen by the id, repeats a stretch up to its end: a planted run.

    With h = crc32 of the decimal id and g = h // 10, where h % 10 is 0 each word
    i >= a becomes word a + (i - a) % p, a = g % n, p = 1 + (n - a) // (3 + g % 8).
    """
    order = own_order(words, doc_ids)
    for row, doc_id in enumerate(doc_ids):
        first, n = words.first[row], words.first[row + 1] - words.first[row]
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n > 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            order[first + a : first + n] = first + a + np.arange(n - a) % p
    return order


def repeated_grams(word: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the k-word sequences found twice or more in their row, and a number for each sequence."""
    n = len(word) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    total = mixed(row[:n].astype(np.uint64) + np.uint64(1))
    for j in range(k):
        total = total * GRAM_BASE + word[j : n + j]
    whole = np.flatnonzero(row[:n] == row[k - 1 :])
    _, number, count = np.unique(mixed(total[whole]), return_inverse=True, return_counts=True)
    again = count[number] > 1
    return whole[again], number[again]


def sorted_suffixes(number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of ``number`` and the length each shares with the one before it.

    The last entry must be found once. The ranks of each doubling are kept, and
    common lengths come from climbing down through them.
    """
    m = len(number)
    order = np.argsort(number, kind="stable")

    def first_of_group(new: np.ndarray) -> np.ndarray:
        return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))

    rank = np.empty(m, np.int32)
    rank[order] = first_of_group(np.append(True, number[order][1:] != number[order][:-1]))
    levels, h = [rank], 1
    while True:
        in_order = rank[order]
        same = in_order[1:] == in_order[:-1]
        open_at = np.flatnonzero(np.append(same, False) | np.append(False, same))
        if not len(open_at):
            break
        at = order[open_at]  # whose first h entries occur again, so they don't reach the end
        group, second = rank[at], rank[at + h]
        turn = np.lexsort((second, group))
        at, second, group = at[turn], second[turn], group[turn]
        order[open_at] = at
        new = np.append(True, (second[1:] != second[:-1]) | (group[1:] != group[:-1]))
        rank = rank.copy()
        rank[at] = open_at[first_of_group(new)]
        h *= 2
        levels.append(rank)
    a, b = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(m, np.int64)
    for level in range(len(levels) - 1, -1, -1):
        step = np.where(levels[level][a] == levels[level][b], 1 << level, 0)
        shared[1:] += step
        a += step
        b += step
    return order, shared


def maximal_pairs(order: list, common: list, word_at: list, classes: list, more: int, least: int, times: int) -> list:
    """(start, length, period) of the runs, walking the LCP-interval tree from the bottom.

    ``order`` and ``common`` are the sorted suffixes and what each shares with the
    one before, ``word_at`` their word and ``classes`` the class of the word on
    their left; ``more`` words are shared beyond the common entries.
    """
    runs = []

    def merged(shared: int, children: list) -> list:
        """The children's lists as one; runs among the new neighbours are kept."""
        children.sort(key=len)
        large = children.pop()
        child_of = {}
        for number, child in enumerate(children):
            for start in child:
                child_of[start] = number
                insort(large, start)
        agree = shared + more

        def pair(x: int, y: int) -> None:
            d = word_at[y] - word_at[x]
            if agree >= (times - 1) * d and agree + d >= least and classes[x] != classes[y]:
                runs.append((word_at[x], agree + d, d))

        for start, number in child_of.items():
            at = bisect_left(large, start)
            if at and child_of.get(large[at - 1], -1) != number:
                pair(large[at - 1], start)
            if at + 1 < len(large) and large[at + 1] not in child_of:
                pair(start, large[at + 1])
        return large

    open_intervals = []  # (common length, lists of the children), each longer than the one below
    current = [order[0]] if order else []
    for suffix, shared in zip([*order[1:], None], [*common[1:], 0]):
        while open_intervals and open_intervals[-1][0] > shared:
            length, children = open_intervals.pop()
            children.append(current)
            current = merged(length, children)
        if open_intervals and open_intervals[-1][0] == shared:
            open_intervals[-1][1].append(current)
        elif shared:
            open_intervals.append((shared, [current]))
        current = [suffix]
    return runs


def runs_of(word: np.ndarray, row: np.ndarray, least: int, times: int) -> np.ndarray:
    """(first word, length, period) of all runs of a block, sorted."""
    k = least_match(least, times)
    start, number = repeated_grams(word, row, k)
    if not len(start):
        return np.zeros((0, 3), np.int64)
    # a number found once ends each stretch of consecutive starts
    goes_on = (start[1:] == start[:-1] + 1) & (row[start[1:]] == row[start[:-1]])
    ends = np.flatnonzero(np.append(~goes_on, True)) + 1
    start = np.insert(start, ends, -1)
    number = np.insert(number, ends, number.max() + 1 + np.arange(len(ends)))
    order, common = sorted_suffixes(number)
    before = np.maximum(start - 1, 0)
    opens = (start == 0) | (row[before] != row[start])
    _, classes = np.unique(word[before], return_inverse=True)
    classes = np.where(opens, -1 - np.arange(len(start)), classes)  # the begin of a text is like no word
    found = maximal_pairs(
        order.tolist(), common.tolist(), start.tolist(), classes.tolist(), k - 1, least, times
    )
    return np.array(sorted(found), np.int64).reshape(-1, 3)


def joined(texts: Texts, words: Words, order: np.ndarray, row: np.ndarray) -> pa.Array:
    """For each row its words of ``order``, joined by one space."""
    opens = np.append(True, row[1:] != row[:-1])[: len(row)]
    length = (words.end - words.start)[order] + ~opens
    upto = np.cumsum(length)
    out = np.empty(int(upto[-1]) if len(upto) else 0, np.uint8)
    for lo in range(0, len(order), GATHERED):
        part = slice(lo, lo + GATHERED)
        base = upto[part] - length[part]
        # a word is copied with the byte before it, which becomes the space
        source = words.start[order[part]] - ~opens[part]
        at = np.arange(base[0], upto[part][-1])
        out[base[0] : upto[part][-1]] = texts.data[np.repeat(source - base, length[part]) + at]
        out[base[~opens[part]]] = 32
    bounds = np.append(0, upto)[np.searchsorted(row, np.arange(len(texts) + 1))].astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer(bounds), pa.py_buffer(out)])


def finder(least: int, times: int, order_of):
    """Rows (doc_id, text) to FOUND."""
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for at, texts in blocks(batch.column("text")):
                own = ids[at : at + len(texts)]
                words = Words(texts, CASED)
                order = order_of(words, own.to_pylist())
                row = words.rows()
                found = runs_of(words.hash[order], row, least, times)
                # all words of a run after its first period go
                change = np.zeros(len(row) + 1, np.int64)
                np.add.at(change, found[:, 0] + found[:, 2], 1)
                np.add.at(change, found[:, 0] + found[:, 1], -1)
                kept = np.cumsum(change[:-1]) == 0
                per_row = np.searchsorted(found[:, 0], words.first).astype(np.int32)
                starts = found[:, 0] - np.repeat(words.first[:-1], np.diff(per_row))
                structs = pa.StructArray.from_arrays(
                    [pa.array(starts), pa.array(found[:, 1].copy()), pa.array(found[:, 2].copy())],
                    fields=list(kind.value_type),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        own,
                        pa.array(np.diff(words.first).astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(per_row), structs, type=kind),
                        joined(texts, words, order[kept], row[kept]),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return run


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4, planted: bool = False) -> DataFrame:
    """doc_id, n_words, runs (start, length, period by start) and the collapsed text of each document.

    ``planted`` first repeats a stretch in a tenth of the texts (``folded_order``).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(finder(least, times, folded_order if planted else own_order), FOUND)


# the greatest exact length / period first, then the smallest start, then the smallest period
STRONGEST = """get(array_sort(runs, (x, y) -> case
    when x.length * y.period != y.length * x.period
        then if(x.length * y.period > y.length * x.period, -1, 1)
    when x.start != y.start then if(x.start < y.start, -1, 1)
    else cast(x.period - y.period as int) end), 0)"""


def digests(found: DataFrame) -> DataFrame:
    """Counts, the strongest run and digests of each document of ``periodic_runs``."""
    lines = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\\n'), '')")
    return found.withColumn("best", F.expr(STRONGEST)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
