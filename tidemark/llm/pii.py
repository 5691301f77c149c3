"""Personal data: fixed patterns as seeds, contextual bootstrapping for the rest.

Seeds are e-mail addresses, IP addresses, card and phone numbers found by the
fixed rules below. Every seed and every other identifier-like token (it holds
a digit, six characters or more) is a mention with its context. Lexical
patterns are the word before (or the key before a ``=``), the two words
before, and the word after.

A pattern is weighed against all tokens it meets in the corpus: with S the sum
of its mentions' scores and O the number of ordinary tokens (no mentions) in
the same context, its share is S / (S + O + smoothing), and its worth is the
share's lift over the share of mentions among all tokens, scaled so that 1 is a
pattern that meets nothing else. So a stop word is worth nothing, and a mention
of unknown status counts neither for a pattern nor against it. Seeds score 1.
Opaque strings (long, letters and digits in frequent turns, as keys and hashes
are) score ``opaque`` from the start, so that secrets, which no fixed rule
finds, make their contexts known; they are no spans by that alone. An instance
is accepted when 1 - prod(1 - worth) over its reliable patterns reaches
``accept``, and scores 1 from then on. Rounds go on until no new instance is
accepted. Mentions of accepted instances become spans of kind ``identifier``;
seed spans always stay.

Defined results: a null or empty text has no spans; rows that repeat and rows
without a doc_id each give a row; offsets are code points, the end exclusive;
without documents the result is empty.
"""

from __future__ import annotations

import dataclasses
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import bit_table, drop, keyed, passing, stage

# fixed values: the kinds in the order of the output
KINDS = ["email", "ip", "card", "phone", "identifier"]

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match never starts inside a run of digits, so looking behind only saves time
ADDRESS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
TOKEN = re.compile(r"[^ \t-\r]+")
EDGES = "\"'`()[]{}<>,;:.!?*#$%&|=+-_/\\~^@"
# an opaque string has this many letters and digits, and a turn between them in every so many
OPAQUE_LENGTH, OPAQUE_TURN = 16, 6
# tokens whose contexts a worker counts before it hands the counts on
COUNTED = 1 << 20
# one document in so many shows most of the contexts that are no good; a worker names those met so often
SHOWN, OFTEN = 32, 4


@dataclasses.dataclass(frozen=True)
class Rounds:
    """How the graph is scored."""

    rounds: int | None = None  # at most so many; None: until no new instance is accepted
    smoothing: float = 1.0
    least_support: int = 3
    reliable: float = 0.5
    accept: float = 0.75
    least_length: int = 6
    opaque: float = 0.5


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        hit = DOMAIN.match(text, at + 1) if start < at else None
        if hit:
            done = hit.end()
            yield start, done
        else:
            done = max(done, at + 1)  # an @ is in no local part
        at = text.find("@", max(done, at + 1))


def digits_of(text: str) -> str:
    return "".join(DIGIT.findall(text))


def small_part(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed rules, sorted."""
    found = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in ADDRESS.finditer(text):
            if all(map(small_part, m[0].split("."))):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = digits_of(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(digits_of(m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def context_word(raw: str) -> str:
    """A context word: the token without the punctuation around it."""
    return raw.strip(EDGES).lower()[:32] or raw[:32]


EDGE = context_word("<edge>")


def key_of(prefix: str) -> str:
    """What stands before the ``=`` of a token, as a context word of its own."""
    key = prefix.strip(EDGES).lower()[:32]
    return f"{key}=" if key else ""


def mentions(text: str, base: list[tuple[int, int, int]], least: int) -> list[tuple]:
    """(start, end, string, seed, before, two before, after) of seeds and other identifiers."""
    if not base and not DIGIT.search(text):
        return []
    tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text)]
    out = []

    def word(i: int) -> str:
        return context_word(text[tokens[i][0] : tokens[i][1]]) if 0 <= i < len(tokens) else EDGE

    def add(start: int, end: int, seed: bool, i: int, j: int, prefix: str = "") -> None:
        one = prefix or word(i - 1)
        two = f"{word(i - 1) if prefix else word(i - 2)} {one}"
        out.append((start, end, text[start:end].lower(), seed, one, two, word(j + 1)))

    i = 0
    reach = 0  # end of the last seed
    waiting = iter(base)
    seed = next(waiting, None)
    while i < len(tokens):
        low, high = tokens[i]
        if seed is not None and seed[0] < high:
            j = i
            while j + 1 < len(tokens) and tokens[j + 1][0] < seed[2]:
                j += 1
            add(seed[0], seed[2], True, i, j, key_of(text[low : seed[0]].rpartition("=")[0]))
            reach = max(reach, seed[2])
            seed = next(waiting, None)
            if seed is None or seed[0] >= tokens[i][1]:
                i += 1
            continue
        if low >= reach and high - low >= least:
            piece = text[low:high]
            if DIGIT.search(piece):
                prefix, mark, value = piece.rpartition("=")
                left = low + len(prefix) + len(mark)
                stripped = value.strip(EDGES)
                if len(stripped) >= least and DIGIT.search(stripped):
                    start = left + value.index(stripped)
                    add(start, start + len(stripped), False, i, i, key_of(prefix))
        i += 1
    return out


def named(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


SCANNED = (
    "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string,"
    " base array<struct<start:int,kind:int,end:int>>, text_hash bigint,"
    " mentions array<struct<start:int,end:int,string:string,seed:boolean,one:string,two:string,after:string>>"
)
SPAN = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
MENTION = pa.list_(
    pa.struct(
        [("start", pa.int32()), ("end", pa.int32()), ("string", pa.string()), ("seed", pa.bool_())]
        + [(n, pa.string()) for n in ("one", "two", "after")]
    )
)


def scanned(docs: DataFrame, least: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            counts, hashes, bases, met = [], [], [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                base = base_spans(text)
                counts.append([sum(k == kind for _, k, _ in base) for kind in range(4)])
                hashes.append(hashlib.sha256(named(base).encode()).hexdigest())
                bases.append([{"start": s, "kind": k, "end": e} for s, k, e in base])
                names = ("start", "end", "string", "seed", "one", "two", "after")
                met.append([dict(zip(names, m)) for m in mentions(text, base, least)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *[pa.array([c[k] for c in counts], pa.int64()) for k in range(4)],
                    pa.array(hashes, pa.string()),
                    pa.array(bases, SPAN),
                    batch.column("text_hash"),
                    pa.array(met, MENTION),
                ],
                ["doc_id", *(f"n_{k}" for k in KINDS[:4]), "base_sha256", "base", "text_hash", "mentions"],
            )

    return keyed(docs).mapInArrow(run, SCANNED)


class ContextWords(dict):
    """Context words by token, each worked out once."""

    def __missing__(self, raw: str) -> str:
        if len(self) >= COUNTED:
            self.clear()
        self[raw] = word = context_word(raw)
        return word


class Contexts:
    """Counts of the patterns around every token of some texts."""

    def __init__(self):
        self.words = ContextWords()
        self.clear()

    def clear(self) -> None:
        self.tokens, self.one, self.two, self.after = 0, Counter(), Counter(), Counter()

    def add(self, text: str) -> None:
        pieces = TOKEN.findall(text)
        n = len(pieces)
        if not n:
            return
        self.tokens += n
        words = [EDGE, EDGE, *(self.words[p] for p in pieces), EDGE]
        self.one.update(words[1 : n + 1])
        self.two.update(zip(words[:n], words[1 : n + 1]))
        self.after.update(words[3:])
        if "=" in text:
            for i, piece in enumerate(pieces):
                prefix, _, value = piece.rpartition("=")
                key = key_of(prefix) if value.strip(EDGES) else ""
                if key:  # the key stands in the place of the word before
                    self.one[words[i + 1]] -= 1
                    self.two[words[i], words[i + 1]] -= 1
                    self.one[key] += 1
                    self.two[words[i + 1], key] += 1

    def wanted(self, table: np.ndarray, least: int) -> tuple[list, list]:
        """Patterns whose bit is set that met ``least`` tokens, and their counts; None with
        the number of tokens."""

        def among(names: list[str]) -> np.ndarray:
            return passing(np.array([zlib.crc32(x.encode()) for x in names], np.uint64), table)

        patterns, counts = [None], [self.tokens]
        good = {w for w, ok in zip(self.one, among([f"1 {w}" for w in self.one])) if ok}
        # two words meet no more than the latter alone
        pairs = [(u, w) for (u, w), n in self.two.items() if n >= least and w in good]
        afters = [w for w, n in self.after.items() if n >= least]
        for names, values in (
            ([f"1 {w}" for w in good], [self.one[w] for w in good]),
            ([f"2 {u} {w}" for u, w in pairs], [self.two[p] for p in pairs]),
            ([f"3 {w}" for w in afters], [self.after[w] for w in afters]),
        ):
            for name, value, ok in zip(names, values, among(names)):
                if ok and value >= least:
                    patterns.append(name)
                    counts.append(value)
        return patterns, counts


def background(docs: DataFrame, likely: DataFrame, least: int = 1) -> DataFrame:
    """(pattern, n): how many tokens the patterns of ``likely``, and maybe others, meet;
    a null pattern for all tokens. With ``least`` above 1 the numbers are lower bounds."""
    table = docs.sparkSession.sparkContext.broadcast(
        bit_table(likely.select(F.crc32(F.col("pattern").cast("binary")).alias("crc")), "crc")
    )

    def run(batches):
        met = Contexts()

        def counted():
            patterns, counts = met.wanted(table.value, least)
            met.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(patterns, pa.string()), pa.array(counts, pa.int64())], ["pattern", "n"]
            )

        for batch in batches:
            for value in batch.column("text"):
                met.add(value.as_py() or "")
                if met.tokens >= COUNTED:
                    yield counted()
        yield counted()

    return keyed(docs).select("text").mapInArrow(run, "pattern string, n bigint").groupBy("pattern").agg(F.sum("n").alias("n"))


def opaque(string):
    """Column: whether letters and digits take turns as in a key or a hash."""
    plain = F.regexp_replace(F.lower(string), "[^a-z0-9]", "")
    turns = F.regexp_count(plain, F.lit("(?<=[a-z])[0-9]|(?<=[0-9])[a-z]"))
    return (F.length(plain) >= OPAQUE_LENGTH) & (turns * OPAQUE_TURN >= F.length(plain))


def accepted(docs: DataFrame, edges: DataFrame, settings: Rounds) -> tuple[DataFrame, str]:
    """(string) of the instances that are no seeds and are accepted, and its path."""
    spark = edges.sparkSession
    likely = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances"), F.sum("n").alias("met"))
    likely, of_likely = stage(
        likely.where(F.col("instances") >= settings.least_support).select("pattern", "met"), "likely"
    )
    # what a part of the documents shows about a pattern is a lower bound of the ordinary
    # tokens it meets, and enough to rule out stop words before all contexts are counted
    part = docs.where(F.pmod(F.xxhash64(F.col("text").cast("string")), F.lit(SHOWN)) == 0)
    shown = background(part, likely, OFTEN).join(likely, "pattern")
    poor = F.col("met") / (F.greatest("n", "met") + settings.smoothing) < settings.reliable
    likely, of_rest = stage(likely.join(shown.where(poor).select("pattern"), "pattern", "left_anti"), "likely")
    met, of_met = stage(background(docs, likely), "background")
    tokens = met.where("pattern is null").agg(F.sum("n")).first()[0] or 0
    # every mention has one pattern of a word before
    mentioned = edges.where(F.col("pattern").startswith("1 ")).agg(F.sum("n")).first()[0] or 0
    usual = min(mentioned / tokens, 1 - 1e-9) if tokens else 0.0

    def worth(score, ordinary):
        return (score / (score + ordinary + settings.smoothing) - usual) / (1 - usual)

    ordinary = F.greatest(F.col("n") - F.col("met"), F.lit(0)).alias("ordinary")
    likely = likely.join(met, "pattern").select("pattern", "met", ordinary)
    # scores are 1 at most: a pattern that is unreliable with all of them never is reliable
    able = likely.where(worth(F.col("met"), F.col("ordinary")) >= settings.reliable).select("pattern", "ordinary")
    graph, of_graph = stage(edges.join(able, "pattern"), "graph")
    drop(spark, of_likely, of_rest, of_met)
    first = F.when(F.col("seed"), 1.0).when(opaque(F.col("string")), settings.opaque).otherwise(0.0)
    scores = graph.groupBy("string").agg(F.max("seed").alias("seed")).withColumn("score", first)
    scores, at = stage(scores.withColumn("accepted", F.lit(False)), "instances")
    number, done = 0, 0
    while settings.rounds is None or done < settings.rounds:
        patterns = (
            graph.select("pattern", "ordinary", "string", "n")
            .join(scores, "string")
            .groupBy("pattern")
            .agg(
                worth(F.sum(F.col("score") * F.col("n")), F.first("ordinary")).alias("worth"),
                F.count_if(F.col("score") >= settings.reliable).alias("support"),
            )
            .where((F.col("support") >= settings.least_support) & (F.col("worth") >= settings.reliable))
        )
        doubt = (
            graph.join(patterns, "pattern")
            .groupBy("string")
            .agg((1 - F.exp(F.sum(F.log(1 - F.least("worth", F.lit(0.999)))))).alias("believed"))
        )
        now = F.col("accepted") | (~F.col("seed") & (F.coalesce("believed", F.lit(0.0)) >= settings.accept))
        better = scores.join(doubt, "string", "left").select(
            "string", "seed", F.when(now, 1.0).otherwise(F.col("score")).alias("score"), now.alias("accepted")
        )
        scores, where = stage(better, "instances")
        drop(spark, at)
        at, done, before = where, done + 1, number
        number = scores.where("accepted").count()
        if number == before:
            break
    drop(spark, of_graph)
    return scores.where("accepted").select("string"), at


def personal_data(docs: DataFrame, settings: Rounds = Rounds()) -> DataFrame:
    """doc_id, counts and digest of the fixed rules, spans, n_identifier, text_hash, found."""
    spark = docs.sparkSession
    rows, _ = stage(
        scanned(docs, settings.least_length).withColumn("row", F.monotonically_increasing_id()), "scanned"
    )
    met = rows.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    edges = met.select(
        "string",
        "seed",
        F.explode(
            F.array(F.concat(F.lit("1 "), "one"), F.concat(F.lit("2 "), "two"), F.concat(F.lit("3 "), "after"))
        ).alias("pattern"),
    )
    # a string that was met as a seed anywhere is one
    edges = edges.groupBy("pattern", "string").agg(F.max("seed").alias("seed"), F.count(F.lit(1)).alias("n"))
    edges, at = stage(edges, "edges")
    good, _ = accepted(docs, edges, settings)
    drop(spark, at)
    found = (
        met.where(~F.col("seed"))
        .join(good, "string")
        .groupBy("row")
        .agg(
            F.collect_list(
                F.struct("start", F.lit(KINDS.index("identifier")).alias("kind"), "end")
            ).alias("found")
        )
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    kinds = F.array(*map(F.lit, KINDS))
    spans = F.array_sort(F.concat("base", F.coalesce("found", none)))
    return (
        rows.drop("mentions")
        .join(found, "row", "left")
        .withColumn("all", spans)
        .select(
            "doc_id",
            *(f"n_{k}" for k in KINDS[:4]),
            "base_sha256",
            F.array_join(
                F.transform(
                    "all", lambda x: F.concat_ws(":", kinds[x["kind"]], x["start"].cast("string"), x["end"].cast("string"))
                ),
                ",",
            ).alias("spans"),
            F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("n_identifier"),
            "text_hash",
            F.col("all").alias("found"),
        )
    )


def redacted(docs: DataFrame, settings: Rounds = Rounds()) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; other columns stay."""
    marked = personal_data(docs, settings).where(F.size("found") > 0)
    # equal rows have equal spans, so doc_id and text decide
    marked = marked.select(F.col("doc_id").alias("of"), F.col("text_hash").alias("hash"), "found").dropDuplicates(
        ["of", "hash"]
    )
    both = docs.withColumn("text_hash_of", F.xxhash64(F.col("text").cast("string"))).join(
        marked, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash_of") == F.col("hash")), "left"
    )

    return both.withColumn("text", masked(F.col("text"), F.col("found"))).select(*docs.columns)


def masked(text, spans):
    """Column: the text with its sorted, possibly overlapping spans replaced."""
    kinds = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).alias("reach"))

    def step(done, span):
        begin = F.greatest(done["reach"], span["start"])
        gap = F.substring(text, done["reach"] + 1, F.greatest(begin - done["reach"], F.lit(0)))
        return F.when(span["end"] <= done["reach"], done).otherwise(
            F.struct(
                F.concat(done["parts"], F.array(gap, kinds[span["kind"]])).alias("parts"),
                span["end"].alias("reach"),
            )
        )

    def finish(done):
        return F.concat(F.array_join(done["parts"], ""), F.substring(text, done["reach"] + 1, F.length(text)))

    return F.when(spans.isNull() | (F.size(spans) == 0), text).otherwise(F.aggregate(spans, start, step, finish))
