"""The keyed document table: one document per (date, repo_name)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import safe_double, safe_int
from tidemark.operators.serving import by_score, top_rows
from tidemark.schemas import DOC_CORE, DOCUMENT
from tidemark.session import new_stage_path
from tidemark.sources.paths import delete_path
from tidemark.sources.tables import read_documents

KEY = ["date", "repo_name"]


def _filled(text: Column) -> Column:
    return F.coalesce(text != "", F.lit(False))


def fold_updates(updates: DataFrame, present: Mapping[str, Column], seq: Column) -> DataFrame:
    """Several updates of one key to one, as if applied in ``seq`` order.

    Each field keeps the value of the last update that carried it. Partial
    aggregates run before the shuffle, so a key updated very often is cheap.
    """
    folded = updates.groupBy(*KEY).agg(
        *[
            part
            for name, given in present.items()
            for part in (
                F.max_by(F.col(name), F.when(given, seq)).alias(name),
                F.max(F.coalesce(given, F.lit(False))).alias(f"_has_{name}"),
            )
        ]
    )
    return folded


def default_order(updates: DataFrame) -> Column:
    """Order of updates that come without one: the best ranked is applied last."""
    score = F.col("rank_score") if "rank_score" in updates.columns else F.lit(None).cast("double")
    content = F.to_json(F.struct(*sorted(updates.columns)), {"ignoreNullFields": "false"})
    return F.struct(F.coalesce(score, F.lit(float("-inf"))), F.sha2(content, 256))


def partial_upsert(
    base: DataFrame,
    updates: DataFrame,
    present: Mapping[str, Column],
    seq: Column | None = None,
    null_keys: bool = True,
) -> DataFrame:
    """Merge partial documents into ``base``; unknown keys are inserted.

    ``present`` names the fields an update carries and, per row, whether it
    carries them. A carried NULL overwrites; a field not carried keeps its
    old value. Several updates of a key are applied in ``seq`` order, by
    default worst rank first, then by their content: the result is one row per
    key whatever the order of the rows. NULL is a key like any other; without
    ``null_keys`` neither side has one, and a base in buckets of the key stays where it is.
    """
    folded = fold_updates(updates, present, default_order(updates) if seq is None else seq)
    renamed = folded.withColumnsRenamed({name: f"_new_{name}" for name in [*present, *KEY]})
    same = F.lit(True)
    for name in KEY:
        new = F.col(f"_new_{name}")
        same = same & (F.col(name).eqNullSafe(new) if null_keys else F.col(name) == new)
    merged = base.withColumn("_stored", F.lit(True)).join(renamed, same, "full_outer")

    def value(field) -> Column:
        if field.name in KEY:
            kept = F.when(F.col("_stored"), F.col(field.name)).otherwise(F.col(f"_new_{field.name}"))
            return kept.alias(field.name)
        if field.name not in present:
            return F.col(field.name)
        new = F.col(f"_new_{field.name}").cast(field.dataType)
        return F.when(F.col(f"_has_{field.name}"), new).otherwise(F.col(field.name)).alias(field.name)

    return merged.select(*[value(field) for field in base.schema.fields])


def upsert_docs(
    base: DataFrame, updates: DataFrame, seq: Column | None = None, null_keys: bool = True
) -> DataFrame:
    """Merge ranked rows: core fields always win, even when NULL.

    The category block is only taken when the update has a category, its
    reasoning only when that is not empty; texts cached on the document by
    other jobs survive. ``updates`` holds document columns.
    """
    always = F.lit(True)
    has_category = _filled(F.col("category"))
    present = {name: always for name in DOC_CORE.fieldNames()}
    present["category"] = has_category
    present["category_confidence"] = has_category
    present["category_reasoning"] = has_category & _filled(F.col("category_reasoning"))
    present["categorized_at"] = has_category
    return partial_upsert(base, updates, present, seq, null_keys)


def documents_from_ranking(
    ranked: DataFrame, insight_markdown: Column, indexed_at: Column
) -> DataFrame:
    """Ranked rows (numbers or text) in document form."""
    def optional(name: str, kind: str) -> Column:
        return F.col(name) if name in ranked.columns else F.lit(None).cast(kind)

    category = optional("category", "string")
    return ranked.select(
        F.date_format("event_date", "yyyy-MM-dd").alias("date"),
        "repo_name",
        F.col("repo_id").cast("string").alias("repo_id"),
        safe_int(F.col("event_count").cast("string")).alias("event_count"),
        *[
            safe_double(F.col(name).cast("string")).alias(name)
            for name in (
                "acceleration_ratio",
                "anomaly_score",
                "watch_zscore",
                "watch_ratio",
                "rank_score",
            )
        ],
        "dominant_event_type",
        insight_markdown.cast("string").alias("insight_markdown"),
        indexed_at.cast("timestamp_ntz").alias("indexed_at"),
        category.alias("category"),
        optional("category_confidence", "double").alias("category_confidence"),
        optional("category_reasoning", "string").alias("category_reasoning"),
        F.when(_filled(category), indexed_at).cast("timestamp_ntz").alias("categorized_at"),
    )


def cache_repo_insight(base: DataFrame, insights: DataFrame, generated_at: Column) -> DataFrame:
    """Store one generated text per (date, repo_name), other fields untouched."""
    updates = insights.select(
        *KEY, "repo_insight_markdown", generated_at.alias("repo_insight_generated_at")
    )
    always = F.lit(True)
    return partial_upsert(
        base, updates, {"repo_insight_markdown": always, "repo_insight_generated_at": always}
    )


def get_repo_insight(docs: DataFrame, date: str, repo_name: str) -> DataFrame:
    """The cached text of one document; the date filter prunes folders."""
    return docs.where(
        (F.col("date") == F.lit(date)) & (F.col("repo_name") == F.lit(repo_name))
    ).select(*KEY, "repo_insight_markdown")


def docs_by_date(docs: DataFrame, date: str | None = None, size: int = 10) -> DataFrame:
    """Best ``size`` documents of a date (or of each date) and the date's total."""
    rows = docs if date is None else docs.where(F.col("date") == F.lit(date))
    totals = rows.groupBy("date").agg(F.count(F.lit(1)).alias("total"))
    order = [F.desc_nulls_last("rank_score"), F.asc("repo_name")]
    return top_rows(rows, order, size, "date").join(totals, "date")


def indexed_dates(docs: DataFrame, size: int = 30) -> DataFrame:
    """Latest dates that have documents."""
    return docs.select("date").distinct().orderBy(F.desc("date")).limit(size)


def index_stats(spark: SparkSession, root: str) -> DataFrame:
    """Documents and bytes of the stored table."""
    docs = spark.read.parquet(f"{root}/documents")
    files = docs.groupBy("_metadata.file_path").agg(
        F.max("_metadata.file_size").alias("bytes"), F.count(F.lit(1)).alias("docs")
    )
    return files.agg(F.sum("docs").alias("doc_count"), F.sum("bytes").alias("size_bytes"))


def merge_categories(ranked: DataFrame, docs: DataFrame) -> DataFrame:
    """Look up each ranked row's category; rows without a document get NULL.

    Both sides are keyed by (date, repo_name); the join strategy is left to
    the sizes AQE measures.
    """
    known = docs.select(
        F.col("date").cast("date").alias("event_date"), "repo_name", "category", "category_confidence"
    )
    return ranked.join(known, ["event_date", "repo_name"], "left")


def fill_missing_categories(ranked: DataFrame, classified: DataFrame) -> DataFrame:
    """Take a batch result where a row has no category yet, else keep it.

    Several results for one name: the last in ``position`` order counts.
    """
    latest = classified.groupBy("event_date", "repo_name").agg(
        *[
            F.max_by(F.col(source), F.col("position")).alias(f"_new_{target}")
            for source, target in (
                ("category", "category"),
                ("confidence", "category_confidence"),
                ("reasoning", "category_reasoning"),
            )
        ],
    )
    missing = ~_filled(F.col("category"))
    if "category_reasoning" not in ranked.columns:
        ranked = ranked.withColumn("category_reasoning", F.lit(None).cast("string"))
    joined = ranked.join(latest, ["event_date", "repo_name"], "left")
    matched = missing & F.col("_new_category").isNotNull()
    names = ("category", "category_confidence", "category_reasoning")
    return joined.select(
        *[
            F.when(matched, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in names else F.col(c)
            for c in ranked.columns
        ]
    )


def only_unclassified(docs: DataFrame, force: bool = False) -> DataFrame:
    """Documents still to classify: all when forced, else those never done."""
    return docs if force else docs.where(F.col("categorized_at").isNull())


def category_trending(ranked: DataFrame, n: int | None = None) -> DataFrame:
    """Repositories of each day grouped by category; none counts as Other.

    With ``n`` the best n of every category, else the size of each group.
    """
    named = ranked.withColumn("category", F.coalesce(F.nullif("category", F.lit("")), F.lit("Other")))
    if n is None:
        return named.groupBy("event_date", "category").agg(
            F.count(F.lit(1)).alias("repos"),
            F.sum("event_count").alias("total_events"),
            F.max("rank_score").alias("best_rank_score"),
        )
    group = F.concat_ws("|", "event_date", "category")
    return top_rows(
        named.withColumn("_group", group), by_score("rank_score"), n, "_group"
    ).drop("_group")


def replace_documents(spark: SparkSession, root: str, documents: DataFrame) -> None:
    """Rewrite the date folders that ``documents`` covers, and only those.

    The rows are staged in the shared folder first, because they usually
    derive from the very folders being replaced.
    """
    staged = new_stage_path(spark, "documents")
    documents.select(*DOCUMENT.fieldNames()).write.parquet(staged)
    (
        spark.read.schema(DOCUMENT)
        .parquet(staged)
        .hint("rebalance", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(f"{root}/documents")
    )
    delete_path(spark, staged)


def index_daily(spark: SparkSession, root: str, updates: DataFrame, date: str) -> None:
    """Upsert one date's documents; only that date's folder is read and written."""
    day = updates.where(F.col("date") == F.lit(date))
    replace_documents(spark, root, upsert_docs(read_documents(spark, root, date), day))
