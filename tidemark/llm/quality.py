"""Quality rules: a log-likelihood ratio of hashed n-grams, and counted rules.

Two multinomials over hashed word unigrams and bigrams are counted: one over a
trusted target (documents labelled good), one over the whole raw corpus. A
document's score is its summed log(target / raw), divided by its number of
features; it is kept when the score reaches ``threshold`` and no counted rule
fails. ``smoothing`` pseudo-counts per bucket draw a ratio to 1 where there is
little evidence, so a small corpus rejects less, not more. No random draw is involved: equal rows get equal verdicts.

Defined results: a null or empty text has no words and fails the rules; rows
that repeat, and rows without a doc_id, are scored like any other; without
documents the result is empty; without trusted labels the target is flat noise
alone, so the score is left at 0 and only the counted rules decide.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8


@dataclasses.dataclass(frozen=True)
class Rules:
    """buckets bounds the broadcast tables; target_docs bounds the trusted sample."""

    buckets: int = 1 << 16
    target_docs: int = 20_000
    smoothing: float = 8.0
    threshold: float = -0.12
    min_words: int = 20
    max_repeat_percent: int = 30


# white space to spaces, then single characters split without a regular expression
SPACED = "coalesce(cast(text as string), '')"
for mark in ("\\t", "\\n", "\\x0B", "\\f", "\\r"):
    SPACED = f"replace({SPACED}, '{mark.encode().decode('unicode_escape')}', ' ')"


# always true, and an expression that the optimiser neither copies nor moves: without it a
# filter on a verdict is pushed below the arrays, which are then built once per element
ONCE = "monotonically_increasing_id() >= 0"


def pairs(column: str, step: int) -> Column:
    """Hashes of 2 * step words from hashes of ``step`` words."""
    size = f"greatest(size({column}) - {step}, 0)"
    return F.expr(
        f"zip_with(slice({column}, 1, {size}), slice({column}, {step + 1}, {size}), (x, y) -> xxhash64(x, y))"
    )


def hashed(docs: DataFrame) -> DataFrame:
    """The whole row as ``doc``, doc_id, text, split pieces, hashes of single words and of pairs."""
    rows = docs.select(
        F.struct("*").alias("doc"), "doc_id", "text", F.expr(f"split({SPACED}, ' ')").alias("pieces")
    )
    rows = rows.withColumn(
        "ones", F.expr("transform(array_remove(pieces, ''), w -> xxhash64(w))")
    )
    return rows.withColumn("twos", pairs("ones", 1))


def measured(rows: DataFrame) -> DataFrame:
    """Add the counted columns of each whole text to ``hashed`` rows."""
    text = "coalesce(cast(text as string), '')"
    rows = rows.withColumns(
        {
            "lines": F.expr(f"filter(split({text}, '\\n'), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')"),
            "fours": pairs("twos", 2),
        }
    )
    rows = rows.withColumns(
        {
            "n_words": F.size("ones").cast("long"),
            "word_chars": F.expr(f"cast(length({text}) - size(pieces) + 1 as bigint)"),
            "n_symbols": F.expr(f"cast(size(split({text}, '[#*$%&|<>]', -1)) - 1 as bigint)"),
            "n_dup_lines": F.expr("cast(size(lines) - size(array_distinct(lines)) as bigint)"),
            "windows": pairs("fours", 4),
        }
    ).drop("text", "lines", "pieces", "fours")
    # only texts with an equal pair of windows look at positions
    rows = rows.withColumn(
        "placed",
        F.expr(
            f"case when {ONCE} and size(array_distinct(windows)) < size(windows)"
            " then array_sort(transform(windows, (h, i) -> struct(h as h, i as i))) end"
        ),
    )
    rows = rows.withColumn(
        "repeated",
        F.expr(
            "case when placed is not null then array_sort(transform(filter(placed, (x, k) ->"
            " (k > 0 and x.h = placed[k - 1].h) or (k < size(placed) - 1 and x.h = placed[k + 1].h)),"
            " x -> x.i)) end"
        ),
    )
    covered = F.expr(
        f"case when {ONCE} and repeated is null then 0L else aggregate(repeated, struct(0L as total, 0L as reach),"
        f" (a, p) -> struct(a.total + p + {WINDOW}L - greatest(cast(p as bigint), a.reach) as total,"
        f" p + {WINDOW}L as reach), a -> a.total) end"
    )
    return rows.withColumn("n_repeat_words", covered).drop("windows", "placed", "repeated")


def ratios(docs: DataFrame, labels: DataFrame, rules: Rules) -> DataFrame:
    """One row: an array of log(target / raw) by bucket."""
    trusted = (
        labels.where("quality = 1 and doc_id is not null")
        .select(F.col("doc_id").alias("trusted_id"))
        .distinct()
        .orderBy(F.xxhash64("trusted_id"), "trusted_id")
        .limit(rules.target_docs)
    )
    # the sample has at most target_docs ids: a bounded broadcast
    flagged = hashed(docs).join(
        F.broadcast(trusted), F.col("doc_id") == F.col("trusted_id"), "left"
    )
    counts = (
        flagged.select("trusted_id", F.explode(F.concat("ones", "twos")).alias("feature"))
        .groupBy(F.pmod("feature", F.lit(rules.buckets)).cast("int").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("raw"), F.count("trusted_id").alias("target"))
    )
    every = docs.sparkSession.range(rules.buckets).select(F.col("id").cast("int").alias("bucket"))
    # one row of exactly ``buckets`` entries, whatever the corpus is
    gathered = every.join(counts, "bucket", "left").agg(
        F.sort_array(
            F.collect_list(F.struct("bucket", F.coalesce("raw", F.lit(0)).alias("raw"),
                                    F.coalesce("target", F.lit(0)).alias("target")))
        ).alias("of"),
        F.sum("raw").alias("raws"),
        F.sum("target").alias("targets"),
    )
    # both counts on the target's scale; pseudo-counts pull rare buckets to no verdict
    return gathered.select(
        F.expr(
            f"transform(of, b -> case when coalesce(targets, 0) = 0 then 0D else"
            f" ln((b.target + {rules.smoothing}D) / (b.raw * (targets / raws) + {rules.smoothing}D)) end)"
        )
    )


COUNTED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judged(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """doc (the whole row), doc_id, the counted columns, score, base_failed, kept."""
    rows = measured(hashed(docs)).withColumn("ratios", ratios(docs, labels, rules).scalar())
    total = F.expr(
        f"case when {ONCE} then aggregate(concat(ones, twos), 0D, (a, x) ->"
        f" a + ratios[cast(pmod(x, {rules.buckets}) as int)]) end"
    )
    scored = rows.withColumn("score", F.round(total / F.greatest(F.size("ones") + F.size("twos"), F.lit(1)), 9))
    failed = (F.col("n_words") < rules.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent
    )
    return (
        scored.withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= rules.threshold))
        .select("doc", "doc_id", *COUNTED, "score", "base_failed", "kept")
    )


def quality_rules(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """doc_id, the counted columns, score, base_failed, kept: one row per document."""
    return judged(docs.select("doc_id", "text"), labels, rules).drop("doc")


def kept_only(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    return judged(docs, labels, rules).where("kept").select("doc.*")
