"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams, boundaries included, hashed into
``buckets`` embedding rows; a window of ``window`` words is the average of
their embeddings, and a linear softmax gives the probability of label 1. A
text's score is that of its highest window (windows overlap by half), so a few
words weigh as much in a long text as in a short one, and every word of the
whole text is read. Misspellings share n-grams, hence embeddings.

Training is joint (embeddings and softmax, Adam, numpy) over a bounded sample
of labelled rows: at most ``sample_docs`` documents, half of them label 1
while there are enough, chosen by the hash of their doc_id, and of at most
``sample_chars`` characters each. First every window carries its document's
label; then the highest window of each document does.

Labels never reach a score except through training, and rows whose
crc32(doc_id) mod 5 is 0 are never trained on.

Defined results: a null or empty text has one empty window and gets the score
of the bias alone; rows that repeat get equal scores; a row without a doc_id
counts as not held out and is scored; without training rows of both labels every score is 0;
without documents the result is empty.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import ALPHANUMERIC, Texts, Words, blocks, mixed


@dataclasses.dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 17
    dim: int = 8
    shortest: int = 3
    longest: int = 6
    window: int = 12
    sample_docs: int = 4000
    sample_chars: int = 20_000
    warm_epochs: int = 3
    epochs: int = 12
    rate: float = 0.02
    decay: float = 1e-5
    seed: int = 7


@dataclasses.dataclass
class Model:
    """scalars: each bucket's embedding times (softmax row 1 - row 0); bias: of the difference."""

    scalars: np.ndarray
    bias: float
    settings: Settings


def grams(words: Words, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word) of the byte n-grams of every word between boundary marks."""
    length = words.end - words.start
    if not len(length):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # each word as <word>, one after the other
    size = length + 2
    first = np.cumsum(size) - size
    text = np.full(int(size.sum()), ord("<"), np.uint64)
    text[first + size - 1] = ord(">")
    inner = np.repeat(first + 1 - words.start, length) + np.flatnonzero(words.low)
    text[inner] = words.low[words.low != 0]
    owner = np.repeat(np.arange(len(length)), size)
    found, of = [], []
    value = text.copy()
    base = np.uint64(0x100000001B3)
    for n in range(2, settings.longest + 1):
        value = value[:-1] * base + text[n - 1 :]
        if n < settings.shortest:
            continue
        whole = np.flatnonzero(owner[: len(value)] == owner[n - 1 :])
        found.append(mixed(value[whole] + np.uint64(n)) & np.uint64(settings.buckets - 1))
        of.append(owner[whole])
    # the word itself, whatever its length
    found.append(mixed(words.hash) & np.uint64(settings.buckets - 1))
    of.append(np.arange(len(length)))
    return np.concatenate(found).astype(np.int64), np.concatenate(of)


def windows(words: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, word after the last, row) of the windows; each row has one at least."""
    counts = np.diff(words.first)
    step = max(width // 2, 1)
    per = np.maximum(1, -(-(counts - width) // step) + 1)
    row = np.repeat(np.arange(len(counts)), per)
    k = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    low = words.first[row] + k * step
    return low, np.minimum(low + width, words.first[row + 1]), row


def window_sums(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[high] - total[low]


def scores(texts: Texts, model: Model) -> np.ndarray:
    """Highest window probability of each text."""
    words = Words(texts, ALPHANUMERIC)
    bucket, word = grams(words, model.settings)
    worth = np.bincount(word, model.scalars[bucket], len(words))
    count = np.bincount(word, minlength=len(words)).astype(float)
    low, high, row = windows(words, model.settings.window)
    logit = window_sums(worth, low, high) / np.maximum(window_sums(count, low, high), 1) + model.bias
    best = np.full(len(texts), -np.inf)
    np.maximum.at(best, row, logit)
    return 1 / (1 + np.exp(-best))


class Adam:
    def __init__(self, shape, rate: float):
        self.m, self.v, self.rate, self.t = np.zeros(shape), np.zeros(shape), rate, 0

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m += 0.1 * (gradient - self.m)
        self.v += 0.001 * (gradient * gradient - self.v)
        return self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def trained(texts: list[str], labels: np.ndarray, settings: Settings) -> Model:
    """Fit embeddings and softmax together."""
    empty = Model(np.zeros(settings.buckets, np.float32), -np.inf, settings)
    if len(set(labels.tolist())) < 2:
        return empty
    rng = np.random.default_rng(settings.seed)
    # distinct words of the sample, their n-grams, and the sample as word numbers
    parts, rows_of, seen = [], [], {}
    spelled, first_words = [], [np.zeros(1, np.int64)]
    total = 0
    for row, block in blocks(pa.array(texts, pa.string())):
        words = Words(block, ALPHANUMERIC)
        data = words.low.tobytes()
        numbers = np.empty(len(words), np.int64)
        for i, (s, e) in enumerate(zip(words.start.tolist(), words.end.tolist())):
            w = data[s:e]
            n = seen.get(w)
            if n is None:
                n = seen[w] = len(spelled)
                spelled.append(w.decode())
            numbers[i] = n
        parts.append(numbers)
        first_words.append(words.first[1:] + total)
        total += len(words)
    del rows_of
    numbers = np.concatenate(parts)
    bounds = np.concatenate(first_words)
    vocabulary = [Words(b, ALPHANUMERIC) for _, b in blocks(pa.array(spelled, pa.string()))]
    bucket, word, base = [], [], 0
    for v in vocabulary:
        b, w = grams(v, settings)
        bucket.append(b)
        word.append(w + base)
        base += len(v)
    bucket, word = np.concatenate(bucket), np.concatenate(word)
    order = np.argsort(word, kind="stable")
    bucket, word = bucket[order].astype(np.int32), word[order].astype(np.int32)
    count = np.bincount(word, minlength=len(spelled))
    begin = np.cumsum(count) - count

    frame = object.__new__(Words)
    frame.first = bounds
    low, high, row = windows(frame, settings.window)
    label = labels[row].astype(float)
    table = rng.normal(0, 0.1, (settings.buckets, settings.dim))
    soft = rng.normal(0, 0.1, (2, settings.dim))
    bias = np.zeros(2)
    steps = [Adam(x.shape, settings.rate) for x in (table, soft, bias)]
    size = window_sums(count[numbers].astype(float), low, high)

    def logits() -> np.ndarray:
        worth = np.bincount(word, (table @ (soft[1] - soft[0]))[bucket], len(spelled))
        return window_sums(worth[numbers], low, high) / np.maximum(size, 1) + bias[1] - bias[0]

    def update(chosen: np.ndarray) -> None:
        spans = high[chosen] - low[chosen]
        at = np.repeat(low[chosen] - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())
        w = numbers[at]
        of = np.repeat(np.arange(len(chosen)), spans)
        n = count[w]
        gram = np.repeat(begin[w] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        b, of = bucket[gram], np.repeat(of, n)
        weight = 1 / np.maximum(size[chosen], 1)
        hidden = np.stack(
            [np.bincount(of, table[b, d], len(chosen)) * weight for d in range(settings.dim)], axis=1
        )
        z = hidden @ soft.T + bias
        z = np.exp(z - z.max(1, keepdims=True))
        off = (z / z.sum(1, keepdims=True) - np.stack([1 - label[chosen], label[chosen]], 1)) / len(chosen)
        back = off @ soft * weight[:, None]
        gradient = np.stack(
            [np.bincount(b, back[of, d], settings.buckets) for d in range(settings.dim)], axis=1
        )
        soft_gradient, bias_gradient = off.T @ hidden + settings.decay * soft, off.sum(0)
        table[...] -= steps[0].step(gradient + settings.decay * table)
        soft[...] -= steps[1].step(soft_gradient)
        bias[...] -= steps[2].step(bias_gradient)

    for epoch in range(settings.warm_epochs + settings.epochs):
        if epoch < settings.warm_epochs:
            chosen = rng.permutation(len(low))[: 8 * len(labels)]
        else:
            order = np.lexsort((logits(), row))
            last = np.append(np.flatnonzero(np.diff(row[order])), len(order) - 1)
            chosen = rng.permutation(order[last])  # the highest window of each document
        for batch in np.array_split(chosen, max(1, len(chosen) // 256)):
            update(batch)
    return Model((table @ (soft[1] - soft[0])).astype(np.float32), float(bias[1] - bias[0]), settings)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> tuple[list[str], np.ndarray]:
    """At most ``sample_docs`` labelled texts that are not held out."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(~held_out())
    half = settings.sample_docs // 2
    # more ids than needed, as some have long or no texts
    chosen = [
        known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * half)
        for label in (0, 1)
    ]
    ids = chosen[0].unionByName(chosen[1])  # at most 2 * sample_docs rows: a bounded broadcast
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(
        F.length("text").between(1, settings.sample_chars)
    )
    texts = texts.join(F.broadcast(ids.withColumnRenamed("doc_id", "id")), F.col("doc_id") == F.col("id"))
    picked = [
        texts.where(F.col("toxic") == label)
        .orderBy(F.xxhash64("doc_id"), "doc_id", "text")
        .limit(half)
        .select("text", "toxic")
        for label in (0, 1)
    ]
    rows = picked[0].unionByName(picked[1]).collect()
    return [r.text for r in rows], np.array([r.toxic for r in rows], np.int64)


def fitted(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    return trained(*sample(docs, labels, settings), settings)


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets * 4 bytes

    def run(batches):
        known = shared.value
        for batch in batches:
            found = [scores(texts, known) for _, texts in blocks(batch.column("text"))]
            found = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
