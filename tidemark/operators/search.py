"""Token search over document names and bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.documents import KEY
from tidemark.session import new_stage_path
from tidemark.sources.paths import delete_path

# Field weights, and the published BM25 constants.
FIELD_BOOST = {"name": 2.0, "body": 1.0}
K1 = 1.2
B = 0.75

# letters, digits and '_' make up a token, everything else separates
SEPARATORS = r"[^\p{L}\p{N}_]+"


def tokens(text: Column) -> Column:
    """Lower-case tokens of a whole text, in order."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS)
    return F.array_remove(parts, "")


def field_texts(docs: DataFrame) -> DataFrame:
    """One row per document and field, with its text."""
    return docs.select(
        *KEY, F.expr("stack(2, 'name', repo_name, 'body', insight_markdown) AS (field, text)")
    )


def build_token_index(docs: DataFrame) -> DataFrame:
    """(field, token, document, tf, dl) postings.

    A document sits in one task, so its repeats are combined before the
    shuffle; the shuffle key includes the document, so a token present
    everywhere still spreads over all tasks.
    """
    split = field_texts(docs).select(*KEY, "field", tokens(F.col("text")).alias("tokens"))
    exploded = split.select(
        *KEY, "field", F.size("tokens").alias("dl"), F.explode("tokens").alias("token")
    )
    return (
        exploded.groupBy("field", "token", *KEY, "dl")
        .agg(F.count(F.lit(1)).alias("tf"))
        .select("field", "token", *KEY, F.col("tf"), F.col("dl").cast("bigint").alias("dl"))
    )


def write_token_index(docs: DataFrame, path: str) -> None:
    """Store postings, sorted by token across files, and the statistics of the fields.

    Range partitions on (token, document) cut a very common token into
    several files, and the sort lets a lookup skip row groups.
    """
    index = build_token_index(docs)
    (
        index.repartitionByRange("token", *KEY)
        .sortWithinPartitions("token", *KEY)
        .write.mode("overwrite")
        .parquet(f"{path}/postings")
    )
    stored = docs.sparkSession.read.schema(index.schema).parquet(f"{path}/postings")
    field_stats(stored).write.mode("overwrite").parquet(f"{path}/fields")


def field_stats(index: DataFrame) -> DataFrame:
    """Documents and mean length of each field; postings carry their document's length."""
    lengths = index.groupBy(*KEY, "field").agg(F.max("dl").alias("dl"))
    return lengths.groupBy("field").agg(
        F.count(F.lit(1)).alias("docs"), F.avg("dl").alias("avg_dl")
    )


def query_tokens(spark: SparkSession, query: str) -> list[str]:
    """Distinct tokens of a query string, split exactly like the texts."""
    row = spark.range(1).select(F.array_distinct(tokens(F.lit(query))).alias("t")).first()
    return list(row["t"])


def matches(index: DataFrame, fields: DataFrame, terms: list[str]) -> DataFrame:
    """Score of each document holding every term inside one field.

    BM25 per field, times the field's weight; the best field counts. The
    term list filters the postings scan; ``fields`` are the statistics stored
    with the index, one row per field.
    """
    hits = index.where(F.col("token").isin(terms))
    term_stats = hits.groupBy("field", "token").agg(F.count(F.lit(1)).alias("df"))
    stats = term_stats.join(fields, "field")
    idf = F.ln(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = K1 * (1 - B + B * F.col("dl") / F.col("avg_dl"))
    weight = F.element_at(
        F.create_map(*[F.lit(v) for pair in FIELD_BOOST.items() for v in pair]), F.col("field")
    )
    per_field = (
        hits.join(stats, ["field", "token"])
        .withColumn("part", idf * F.col("tf") / (F.col("tf") + norm))
        .groupBy(*KEY, "field")
        .agg(F.count(F.lit(1)).alias("found"), F.sum("part").alias("parts"))
        .where(F.col("found") == len(terms))
        .withColumn("score", weight * F.col("parts"))
    )
    return per_field.groupBy(*KEY).agg(F.max("score").alias("score"))


def search(index: DataFrame, fields: DataFrame, query: str, size: int = 10) -> DataFrame:
    """The ``size`` best documents for a query: score, then newest, then name."""
    terms = query_tokens(index.sparkSession, query)
    if not terms:
        return index.select(*KEY).where(F.lit(False)).withColumn("score", F.lit(0.0))
    found = matches(index, fields, terms).withColumn("score", F.round("score", 9))
    return found.orderBy(F.desc("score"), F.desc("date"), F.asc("repo_name")).limit(size)


def search_total(index: DataFrame, fields: DataFrame, query: str) -> DataFrame:
    """How many documents a query matches."""
    terms = query_tokens(index.sparkSession, query)
    return matches(index, fields, terms).agg(F.count(F.lit(1)).alias("total"))


def search_documents(
    index: DataFrame, fields: DataFrame, docs: DataFrame, query: str, size: int = 10
) -> DataFrame:
    """The best documents themselves, with score, rank and the number of all hits.

    The matches are scored once, into a stage that both the best ``size`` and
    the total are read from. The dates of the hits prune the folders of ``docs``.
    """
    spark = index.sparkSession
    terms = query_tokens(spark, query)
    top, total = [], 0
    if terms:
        staged = new_stage_path(spark, "hits")
        scored = matches(index, fields, terms).withColumn("score", F.round("score", 9))
        scored.write.parquet(staged)
        scored = spark.read.schema(scored.schema).parquet(staged)
        top = scored.orderBy(F.desc("score"), F.desc("date"), F.asc("repo_name")).limit(size).collect()
        total = scored.count()
        delete_path(spark, staged)
    hits = spark.createDataFrame(
        [(r.date, r.repo_name, r.score, rank, total) for rank, r in enumerate(top, 1)],
        "date string, repo_name string, score double, rank int, total bigint",
    )
    return docs.where(F.col("date").isin(sorted({r.date for r in top}))).join(hits, KEY)
