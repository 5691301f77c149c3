"""Repository categories from a user-supplied function or from name rules."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.prompts import extract_repo_section
from tidemark.functions.responses import CATEGORIES, let
from tidemark.operators.documents import KEY, only_unclassified, partial_upsert

# Whole words of a lower-cased name or text, first rule wins.
NAME_WORDS = [
    ("Other", "test tests bot bots e2e"),
    ("DevTools", "warp n8n zapier mattpocock/skills"),
    (
        "AI/ML",
        "llm llms neural gpt agent agents codex nn-zero diffusion transformer transformers"
        " machinelearning machine-learning",
    ),
    ("Infra", "kube kubectl kubernetes docker terraform postgres redis kafka grafana cloud spark"),
    ("Web", "react nuxt vue svelte tailwind shadcn django nextjs next.js http https"),
    ("Game", "godot unreal unity game games"),
    ("DevTools", "cli sdk lint linter compiler vscode editor build plugin plugins"),
]
# Letters and digits belong to a word; what separates words (also _ and -) does not.
# A word of two parts is joined by JOINT before a text is split.
JOINT = "\ue000"
WORD_BREAK = f"[^a-z0-9{JOINT}]+"


def joined(word: str) -> str:
    return "".join(c if c.isalnum() else JOINT for c in word)


WORD_OF = {joined(word): word for _, words in NAME_WORDS for word in words.split()}
RULE_OF = {joined(word): rule for rule, (_, words) in enumerate(NAME_WORDS) for word in words.split()}

CLASSIFIED = (
    "date string, repo_name string, category string, confidence double, reasoning string, failed boolean"
)
CLASSIFIED_COLUMNS = ["date", "repo_name", "category", "confidence", "reasoning", "failed"]

Classifier = Callable[[pd.DataFrame], pd.DataFrame]


def _first_rule(text: Column, confidence: float) -> Column:
    """struct<category, confidence, reasoning> of the first rule, or NULL.

    The text is split once and its words are met with those of all rules in
    one pass; they keep the order of the text, so the first of a rule is its leftmost.
    """

    def lookup(values: dict) -> Column:
        return F.create_map(*[F.lit(part) for pair in values.items() for part in pair])

    def answer(found: Column) -> Column:
        rules = F.transform(found, lambda word: F.element_at(lookup(RULE_OF), word))
        rule = F.array_min(rules)
        word = F.get(found, (F.array_position(rules, rule) - 1).cast("int"))
        return F.when(
            F.size(found) > 0,
            F.struct(
                F.get(F.array(*[F.lit(category) for category, _ in NAME_WORDS]), rule).alias("category"),
                F.lit(confidence).alias("confidence"),
                F.concat(F.lit("matched "), F.element_at(lookup(WORD_OF), word)).alias("reasoning"),
            ),
        )

    prepared = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit(JOINT), F.lit(" "))
    for whole, word in WORD_OF.items():
        if whole != word:
            prepared = F.replace(prepared, F.lit(word), F.lit(whole))
    words = F.array(*[F.lit(word) for word in RULE_OF])
    return let(F.array_intersect(F.split(prepared, WORD_BREAK), words), answer)


def keyword_category(repo_name: Column, excerpt: Column) -> Column:
    """struct<category, confidence, reasoning> from the name, then the text."""
    nothing = F.struct(
        F.lit("Other").alias("category"),
        F.lit(0.3).alias("confidence"),
        F.lit("no rule matched").alias("reasoning"),
    )
    return F.coalesce(_first_rule(repo_name, 0.9), _first_rule(excerpt, 0.6), nothing)


def with_excerpts(docs: DataFrame) -> DataFrame:
    return docs.select(
        *KEY,
        F.coalesce("dominant_event_type", F.lit("Unknown")).alias("dominant_event_type"),
        "event_count",
        extract_repo_section(F.col("insight_markdown"), F.col("repo_name")).alias("excerpt"),
    )


def classify_repos(rows: DataFrame, fn: Classifier | None = None) -> DataFrame:
    """Category of each row (date, repo_name, dominant type, count, excerpt).

    ``fn`` maps a pandas batch to one with category, confidence and
    reasoning; it runs in the executors on Arrow batches. Its answers are
    matched by their ``date`` and ``repo_name`` columns when it returns them,
    else by position, which needs as many answers as rows. A batch it fails on
    (or answers in another number) is retried row by row. Rows without an
    answer, or whose category is NULL, come back with ``failed`` set. Unknown
    categories become Other, confidences are clamped to 0..1 (unreadable: 0).
    Without ``fn`` the name rules are used, which stay in the JVM.
    """
    if fn is None:
        answer = keyword_category(F.col("repo_name"), F.col("excerpt"))
        return rows.select(*KEY, answer.alias("a")).select(*KEY, "a.*", F.lit(False).alias("failed"))

    columns = CLASSIFIED_COLUMNS

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        keyed, answer = batch[KEY].reset_index(drop=True), fn(batch).reset_index(drop=True)
        fields = ["category", "confidence", "reasoning"]
        if set(KEY) <= set(answer.columns):
            named = answer[KEY + fields].drop_duplicates(KEY, keep="last")
            found = keyed.merge(named, on=KEY, how="left")
        elif len(answer) == len(keyed):
            found = pd.concat([keyed, answer[fields]], axis=1)
        else:
            raise ValueError(f"{len(answer)} answers to {len(keyed)} rows")
        given = found["category"].notna()
        confidence = pd.to_numeric(found["confidence"], errors="coerce").fillna(0.0).clip(0.0, 1.0)
        known = found["category"].where(found["category"].isin(CATEGORIES), "Other")
        reasoning = found["reasoning"].map(lambda x: "" if pd.isna(x) else str(x))
        return found.assign(
            category=known.where(given, None),
            confidence=confidence.astype(float).where(given),
            reasoning=reasoning.where(given, None),
            failed=~given,
        )

    def run_rows(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for position in range(len(batch)):
            row = batch.iloc[[position]]
            try:
                yield run(row)[columns]
            except Exception:  # noqa: BLE001 - a classifier may raise anything
                blank = {"category": None, "confidence": None, "reasoning": None, "failed": True}
                yield row[KEY].assign(**blank)[columns]

    def classify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            try:
                yield run(batch)[columns]
            except Exception:  # noqa: BLE001
                yield from run_rows(batch)

    return rows.mapInPandas(classify, CLASSIFIED)


def apply_categories(docs: DataFrame, classified: DataFrame, categorized_at: Column) -> DataFrame:
    """Write classifications onto their documents; failed ones change nothing."""
    updates = classified.where(~F.col("failed")).select(
        *KEY,
        "category",
        F.col("confidence").alias("category_confidence"),
        F.col("reasoning").alias("category_reasoning"),
        categorized_at.cast("timestamp_ntz").alias("categorized_at"),
    )
    always = F.lit(True)
    names = ("category", "category_confidence", "category_reasoning", "categorized_at")
    return partial_upsert(docs, updates, {name: always for name in names})


def unclassified_rows(docs: DataFrame, force: bool = False) -> DataFrame:
    """Rows ready for ``classify_repos``: named documents not done yet."""
    named = docs.where(F.coalesce(F.col("repo_name") != "", F.lit(False)))
    return with_excerpts(only_unclassified(named, force))
