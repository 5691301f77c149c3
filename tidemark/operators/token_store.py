"""A stored token index: updated by document, read only where the best hits can be.

Four tables below one path, all in date folders:

* ``postings`` (field, token, slice, repo_name, tf, dl), in files of whole slices sorted by (token, field, slice)
* ``bounds`` (field, token, slice, docs, max_tf, min_dl), one row per token and slice
* ``lengths`` (field, docs, dl), sums of the date
* ``texts`` (repo_name, field, content), a hash of every indexed text

A slice is a range of texts of like length within a date and field. BM25 grows
with tf and falls with dl, so (max_tf, min_dl) bounds what a token can add to
any text of a slice, whatever the mean length is at query time. Documents
without a date or a name have no key and are not indexed.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.documents import KEY
from tidemark.operators.search import B, FIELD_BOOST, K1, field_texts, query_tokens, tokens
from tidemark.session import new_stage_path
from tidemark.sources.paths import delete_path, path_exists

# slices per doubling of the length, and how many texts of one length share a slice's number
STEPS_PER_DOUBLING = 2
SPREAD = 16
# slices that the first pass reads to learn a threshold
FIRST_SLICES = 16
# rows of a page of the postings: what a lookup skips is counted in pages
PAGE_ROWS = 2000
# tokens that one task splits and sorts into a file; a slice is never cut
TASK_TOKENS = 1_000_000
LEAST_TOKENS = 20_000

TABLES = {
    "postings": "date string, field string, token string, slice int, repo_name string, tf bigint, dl bigint",
    "bounds": "date string, field string, token string, slice int, docs bigint, max_tf bigint, min_dl bigint",
    "lengths": "date string, field string, docs bigint, dl bigint",
    "texts": "date string, repo_name string, field string, content bigint",
}
TEXT = [*KEY, "field"]
SLICE = ["date", "field", "slice"]
# staged during an update
WORDS = "date string, repo_name string, field string, dl bigint, words string, slice int"
MASSES = "date string, field string, slice int, mass bigint"
PARTS = "date string, field string, slice int, part int"


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One of the index's tables; empty before the first update."""
    schema = T.StructType.fromDDL(TABLES[name])
    if not path_exists(spark, f"{path}/{name}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{name}")


def slice_of(dl: Column) -> Column:
    """Number of a text's slice: by length, then spread by name; shorter texts have smaller numbers."""
    step = F.floor(F.log2(dl.cast("double")) * STEPS_PER_DOUBLING)
    return (step * SPREAD + F.pmod(F.xxhash64(*KEY), F.lit(SPREAD))).cast("int")


def content_hashes(docs: DataFrame) -> DataFrame:
    """(date, repo_name, field, content) of every text; a missing text is an empty one."""
    return field_texts(docs).select(*TEXT, F.xxhash64(F.coalesce("text", F.lit(""))).alias("content"))


def changed_texts(stored: DataFrame, docs: DataFrame, whole_dates: bool) -> DataFrame:
    """Texts whose content differs from the stored one; ``content`` is NULL where the text is gone."""
    new = content_hashes(docs)
    old = stored.withColumnRenamed("content", "was")
    joined = old.join(new, TEXT, "full_outer" if whole_dates else "right")
    return joined.where(~F.col("content").eqNullSafe(F.col("was"))).select(*TEXT, "content")


def split_texts(docs: DataFrame, changed: DataFrame | None) -> DataFrame:
    """(date, repo_name, field, dl, slice, words) of the texts of ``docs`` in ``changed``, or of all of them.

    ``words`` are the text's tokens behind each other: a token holds no space.
    """
    texts = field_texts(docs)
    if changed is not None:
        texts = texts.join(changed.where("content IS NOT NULL").select(*TEXT), TEXT, "left_semi")
    split = texts.select(*TEXT, tokens(F.col("text")).alias("tokens"))
    words = split.select(*TEXT, F.size("tokens").cast("bigint").alias("dl"), F.array_join("tokens", " ").alias("words"))
    return words.withColumn("slice", slice_of(F.col("dl")))


def slice_masses(words: DataFrame, bounds: DataFrame) -> DataFrame:
    """(date, field, slice, mass): the tokens and the stored postings of each slice."""
    new = words.groupBy(*SLICE).agg(F.sum("dl").alias("mass"))
    old = bounds.groupBy(*SLICE).agg(F.sum("docs").alias("mass"))
    return new.unionByName(old).groupBy(*SLICE).agg(F.sum("mass").alias("mass"))


def numbered_slices(masses: DataFrame) -> tuple[DataFrame, int]:
    """(date, field, slice, part) and the number of parts: neighbouring slices of one date.

    A part gets as many tokens as any other, however long its texts are.
    """
    spark = masses.sparkSession
    sums = masses.groupBy("date").agg(F.sum("mass").alias("mass")).orderBy("date").collect()  # a row per date
    share = max(sum(r.mass for r in sums) // spark.sparkContext.defaultParallelism, LEAST_TOKENS)
    share, firsts, n = min(share, TASK_TOKENS), [], 0
    for r in sums:
        firsts.append((r.date, n))
        n += -(-r.mass // share)
    first = spark.createDataFrame(firsts, "date string, first int")
    ahead = Window.partitionBy("date").orderBy("field", "slice").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("mass").over(ahead), F.lit(0))
    part = (F.col("first") + F.floor(F.col("before") / share)).cast("int")
    parts = masses.withColumn("before", before).join(F.broadcast(first), "date")
    return parts.select(*SLICE, part.alias("part")), max(n, 1)


def merged_postings(words: DataFrame, kept: DataFrame, parts: DataFrame, n: int) -> DataFrame:
    """Postings of the split texts and the kept ones; each of the ``n`` parts in a partition of its own.

    Texts are shuffled, not their postings: a part holds whole texts and slices,
    so tokens are counted, and ``bounds_of`` taken, where they are.
    """
    none = {"words": "string", "token": "string", "tf": "bigint"}
    rows = words.unionByName(kept, allowMissingColumns=True).select(
        *TEXT, "dl", "slice", *[F.col(name).cast(kind) for name, kind in none.items()]
    )
    # a slice that an update that broke off did not count goes to the first part
    placed = rows.join(parts, SLICE, "left").fillna(0, ["part"]).repartitionById(n, "part")
    listed = F.coalesce(F.split("words", " "), F.array("token"))
    listed = placed.select(
        "part", *TEXT, "dl", "slice", F.coalesce("tf", F.lit(1)).alias("n"), F.explode(listed).alias("token")
    )
    return listed.groupBy("part", "field", "token", *KEY, "dl", "slice").agg(F.sum("n").alias("tf"))


def bounds_of(postings: DataFrame) -> DataFrame:
    return postings.groupBy("part", "date", "field", "token", "slice").agg(
        F.count(F.lit(1)).alias("docs"), F.max("tf").alias("max_tf"), F.min("dl").alias("min_dl")
    )


def lengths_of(words: DataFrame, kept: DataFrame) -> DataFrame:
    rows = words.select(*TEXT, "dl").unionByName(kept.select(*TEXT, "dl"))
    texts = rows.groupBy(*TEXT).agg(F.max("dl").alias("dl"))
    return texts.groupBy("date", "field").agg(F.count(F.lit(1)).alias("docs"), F.sum("dl").alias("dl"))


def _names(spark: SparkSession, name: str) -> list[str]:
    return T.StructType.fromDDL(TABLES[name]).fieldNames()


@contextmanager
def _one_date_a_task(spark: SparkSession) -> Iterator[None]:
    """Tasks that write one date's folder need no sort by date before that of their rows."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _replace(rows: DataFrame, path: str, name: str, order: list[str]) -> None:
    """Overwrite the date folders that ``rows`` covers."""
    (
        rows.sortWithinPartitions(*order)
        .select(*_names(rows.sparkSession, name))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .partitionBy("date")
        .parquet(f"{path}/{name}")
    )


def update_token_index(docs: DataFrame, path: str, whole_dates: bool = False) -> dict[str, int]:
    """Bring the index up to date with ``docs``, one row per key.

    Only texts whose content changed are split into tokens, and only the date
    folders that hold one are rewritten; nothing is written when none changed.
    With ``whole_dates`` stored documents of the dates of ``docs`` that are not
    among them are removed. ``texts`` is written last: an update that broke off
    is done again by the next call.

    Returns the number of changed texts and of rewritten dates.
    """
    spark, docs = docs.sparkSession, docs.dropna(subset=KEY)
    dates = [r.date for r in docs.select("date").distinct().collect()]  # one per calendar date
    stored = read_table(spark, path, "texts").where(F.col("date").isin(dates))
    staged = new_stage_path(spark, "texts")
    changed_texts(stored, docs, whole_dates).write.parquet(staged)
    changed = spark.read.schema(TABLES["texts"]).parquet(staged)
    touched = {r.date: r.n for r in changed.groupBy("date").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not touched:
        delete_path(spark, staged)
        return {"texts": 0, "dates": 0}

    in_touched = F.col("date").isin(list(touched))
    split = new_stage_path(spark, "words")
    # where nothing is stored, every text is new
    known = changed if path_exists(spark, f"{path}/texts") else None
    split_texts(docs.where(in_touched), known).write.parquet(split)
    # a filter before the stage would be pushed down and split every text twice
    words = spark.read.schema(WORDS).parquet(split).where("dl > 0")
    rest = new_stage_path(spark, "postings")  # three tables are made from them
    read_table(spark, path, "postings").where(in_touched).join(changed, TEXT, "left_anti").write.parquet(rest)
    kept = spark.read.schema(TABLES["postings"]).parquet(rest)
    counted = new_stage_path(spark, "slices")
    slice_masses(words, read_table(spark, path, "bounds").where(in_touched)).write.parquet(f"{counted}/masses")
    parts, n = numbered_slices(spark.read.schema(MASSES).parquet(f"{counted}/masses"))
    parts.write.parquet(f"{counted}/parts")  # read with its size, so texts are not shuffled to it
    postings = merged_postings(words, kept, spark.read.schema(PARTS).parquet(f"{counted}/parts"), n)

    _replace(lengths_of(words, kept).hint("rebalance", "date"), path, "lengths", ["date"])
    with _one_date_a_task(spark):
        _replace(bounds_of(postings), path, "bounds", ["token"])
        _replace(postings, path, "postings", ["token", "field", "slice"])
    texts = stored.where(in_touched).join(changed, TEXT, "left_anti")
    texts = texts.unionByName(changed.where("content IS NOT NULL"))
    hashed = new_stage_path(spark, "texts")
    texts.write.parquet(hashed)
    _replace(spark.read.schema(TABLES["texts"]).parquet(hashed).hint("rebalance", "date"), path, "texts", ["date"])
    _drop_emptied(spark, path, list(touched), hashed)
    for at in (staged, split, rest, counted, hashed):
        delete_path(spark, at)
    return {"texts": sum(touched.values()), "dates": len(touched)}


def _drop_emptied(spark: SparkSession, path: str, dates: list[str], hashed: str) -> None:
    """Dates whose last text is gone lose their folders (a dynamic overwrite leaves them)."""
    left = spark.read.schema(TABLES["texts"]).parquet(hashed).select("date").distinct()
    for date in set(dates) - {r.date for r in left.collect()}:
        for name in TABLES:
            delete_path(spark, f"{path}/{name}/date={date}")


# --- lookup ---------------------------------------------------------------


def _part(idf: Column, tf: Column, dl: Column, mean: Column) -> Column:
    """What a token adds to a text's score."""
    return idf * tf / (tf + K1 * (1 - B + B * dl / mean))


def _boost() -> Column:
    pairs = [F.lit(v) for pair in FIELD_BOOST.items() for v in pair]
    return F.element_at(F.create_map(*pairs), F.col("field"))


def term_weights(bounds: DataFrame, lengths: DataFrame) -> DataFrame:
    """(field, token, idf, mean): from counts stored with the index, no posting is read."""
    fields = lengths.groupBy("field").agg(
        F.sum("docs").alias("n"), (F.sum("dl") / F.sum("docs")).alias("mean")
    )
    found = bounds.groupBy("field", "token").agg(F.sum("docs").alias("df"))
    idf = F.ln(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return found.join(fields, "field").select("field", "token", idf.alias("idf"), "mean")


def slice_bounds(bounds: DataFrame, weights: DataFrame, terms: list[str]) -> DataFrame:
    """(date, field, slice, upper): the best score any text of a slice that holds all terms can have."""
    upper = _part(F.col("idf"), F.col("max_tf"), F.col("min_dl"), F.col("mean"))
    per_slice = (
        bounds.join(F.broadcast(weights), ["field", "token"])  # a row per field and term
        .groupBy("date", "field", "slice")
        .agg(F.count(F.lit(1)).alias("found"), F.sum(upper).alias("upper"))
    )
    return per_slice.where(F.col("found") == len(terms)).select(
        "date", "field", "slice", (_boost() * F.col("upper")).alias("upper")
    )


def scored_texts(postings: DataFrame, slices: DataFrame, weights: DataFrame, terms: list[str]) -> DataFrame:
    """Best score of each document among the texts of ``slices`` that hold all terms."""
    part = _part(F.col("idf"), F.col("tf"), F.col("dl"), F.col("mean"))
    per_field = (
        postings.join(slices.select("date", "field", "slice"), ["date", "field", "slice"], "left_semi")
        .join(F.broadcast(weights), ["field", "token"])
        .groupBy(*TEXT)
        .agg(F.count(F.lit(1)).alias("found"), F.sum(part).alias("parts"))
        .where(F.col("found") == len(terms))
    )
    best = per_field.groupBy(*KEY).agg(F.max(_boost() * F.col("parts")).alias("score"))
    return best.withColumn("score", F.round("score", 9))


def _within(postings: DataFrame, slices: DataFrame) -> DataFrame | None:
    """Postings cut by literals that reach the scan: date folders, and each field's span of slices."""
    spans = (
        slices.groupBy("field")
        .agg(F.min("slice").alias("low"), F.max("slice").alias("high"), F.collect_set("date").alias("dates"))
        .collect()  # a row per field
    )
    if not spans:
        return None
    inside = [(F.col("field") == r.field) & F.col("slice").between(r.low, r.high) for r in spans]
    dates = sorted({d for r in spans for d in r.dates})
    return postings.where(F.col("date").isin(dates)).where(reduce(Column.__or__, inside))


def best_documents(
    spark: SparkSession, path: str, query: str, size: int = 10, first_slices: int = FIRST_SLICES
) -> DataFrame:
    """The ``size`` best documents: score, then newest, then name; read from as few slices as can hold them.

    The stored bounds name the slices that can score highest. The texts of the
    first few are scored exactly, and the ``size``-th best score found is a
    threshold: a slice whose bound lies below it holds none of the best. The
    second pass reads the others. Where fewer than ``size`` documents were
    found, there is no threshold and all slices with all terms are read.
    """
    terms = query_tokens(spark, query)
    empty = spark.createDataFrame([], "date string, repo_name string, score double")
    if not terms:
        return empty
    in_terms = F.col("token").isin(terms)
    bounds = read_table(spark, path, "bounds").where(in_terms)
    weights = term_weights(bounds, read_table(spark, path, "lengths"))
    weights = spark.createDataFrame(weights.collect(), weights.schema)  # a row per field and term
    staged = new_stage_path(spark, "slices")
    slices = slice_bounds(bounds, weights, terms)
    slices.write.parquet(staged)
    slices = spark.read.schema(slices.schema).parquet(staged)

    postings = read_table(spark, path, "postings").where(in_terms)
    order = [F.desc("upper"), "date", "field", "slice"]
    first = spark.createDataFrame(slices.orderBy(*order).limit(first_slices).collect(), slices.schema)
    if first.isEmpty():
        delete_path(spark, staged)
        return empty
    known = scored_texts(_within(postings, first), first, weights, terms)
    best = known.orderBy(F.desc("score")).limit(size).collect()
    # scores are rounded; a slice that comes near the threshold is read
    threshold = best[-1].score - 1e-8 if len(best) == size else float("-inf")
    rest = slices.join(first, ["date", "field", "slice"], "left_anti").where(F.col("upper") >= threshold)
    rest_postings = _within(postings, rest)
    if rest_postings is not None:
        more = scored_texts(rest_postings, rest, weights, terms)
        known = known.unionByName(more).groupBy(*KEY).agg(F.max("score").alias("score"))
    found = known.orderBy(F.desc("score"), F.desc("date"), F.asc("repo_name")).limit(size).collect()
    delete_path(spark, staged)
    return spark.createDataFrame(found, empty.schema)
