"""Text handed to, or cut from, a text generator."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

USER_MARK = "## user_template"
SYSTEM_MARK = "## system"
SECTION_MARK = "\n#### "
MISSING = "—"

# Head of the ranking table.
TABLE_HEAD = [
    "| # | repo | events | dominant | acc | anomaly | watch_z |",
    "|---|------|--------|----------|-----|---------|---------|",
]


def two_decimals(number: Column) -> Column:
    """Fixed two decimals, halves rounded to even, the sign of a tiny negative kept."""
    rounded = F.bround(number, 2)
    sign = F.when((rounded == 0) & (number < 0), "-").otherwise("")
    return F.concat(sign, F.format_string("%.2f", rounded))


def fmt(value: Column, default: str = MISSING) -> Column:
    """A metric for a prompt: two decimals, text as it is, or a dash."""
    text = value.cast("string")
    number = text.try_cast("double")
    return (
        F.when(text.isNull() | (text == "") | F.isnan(number), default)
        .when(number.isNotNull(), two_decimals(number))
        .otherwise(text)
    )


def split_template(template: str) -> tuple[str, str]:
    """(system part, user part) of a prompt file's text."""
    system, _, user = template.partition(USER_MARK)
    return system.replace(SYSTEM_MARK, "").strip(), user.split(USER_MARK)[0].strip()


def render(text: str, values: Mapping[str, Column]) -> Column:
    """Replace every {{key}} of a fixed text by that row's value, in order."""
    result = F.lit(text)
    for key, value in values.items():
        shown = F.coalesce(value.cast("string"), F.lit(MISSING))
        result = F.replace(result, F.lit("{{" + key + "}}"), shown)
    return result


def render_prompt(template: str, values: Mapping[str, Column]) -> tuple[Column, Column]:
    """(system, user) prompt columns of a template, both parts filled."""
    system, user = split_template(template)
    return render(system, values), render(user, values)


def repo_insight_values() -> dict[str, Column]:
    """Values of the single-repository prompt, from profile metrics."""
    def count(name: str, default: str = "0") -> Column:
        value = F.col(name)
        return F.when(value.isNull() | (value == 0), default).otherwise(value.cast("string"))

    dominant = F.coalesce(F.nullif("dominant_event_type", F.lit("")), F.lit("Unknown"))
    return {
        "date": F.date_format("event_date", "yyyy-MM-dd"),
        "repo_name": F.col("repo_name"),
        "event_count": count("event_count", "?"),
        "dominant_event_type": dominant,
        "acceleration_ratio": fmt(F.col("acceleration_ratio")),
        "anomaly_score": fmt(F.col("anomaly_score")),
        "watch_zscore": fmt(F.col("watch_zscore")),
        "watch_count": count("watch_count"),
        "fork_count": count("fork_count"),
        "pr_count": count("pr_count"),
        "push_count": count("push_count"),
    }


def extract_repo_section(
    markdown: Column, repo_name: Column, max_chars: int | None = None
) -> Column:
    """The first '####' section that names the repository, or ''.

    Whole by default; ``max_chars`` is for callers with a prompt budget.
    """
    parts = F.split(markdown, SECTION_MARK)
    part = F.get(F.filter(parts, lambda p: F.contains(p, repo_name)), 0)
    headed = F.when(F.startswith(part, F.lit("#")), part).otherwise(F.concat(F.lit("#### "), part))
    trimmed = F.regexp_replace(headed, r"^\s+|\s+$", "")
    cut = trimmed if max_chars is None else F.left(trimmed, F.lit(max_chars))
    return F.coalesce(cut, F.lit(""))


def rank_table_markdown(ranked: DataFrame, n: int | None = None) -> DataFrame:
    """The ranking of each date as one numbered text table.

    ``ranked`` is a ranking with its ``rank``: a date's table has as many
    lines as the ranking kept for it, or the best n of them.
    """
    zero = F.lit(0.0)
    line = F.concat(
        F.format_string("| %d | ", F.col("rank")),
        F.coalesce("repo_name", F.lit("None")),
        F.format_string(" | %d ", F.col("event_count")),
        F.lit("| "),
        F.coalesce("dominant_event_type", F.lit("None")),
        *[
            F.concat(F.lit(" | "), two_decimals(F.coalesce(name, zero)))
            for name in ("acceleration_ratio", "anomaly_score", "watch_zscore")
        ],
        F.lit(" |"),
    )
    lines = F.array_sort(F.collect_list(F.struct(F.col("rank"), line.alias("line"))))
    head = F.lit("\n".join(TABLE_HEAD))
    body = F.array_join(F.transform(lines, lambda row: row.getField("line")), "\n")
    return (
        best(ranked, n)
        .groupBy("event_date")
        .agg(F.concat(head, F.lit("\n"), body).alias("repo_table"))
    )


def best(ranked: DataFrame, n: int | None) -> DataFrame:
    return ranked if n is None else ranked.where(F.col("rank") <= n)


def repo_lines(ranked: DataFrame, n: int | None = None) -> DataFrame:
    """One bullet per ranked repository and the number of them, per date."""
    # fixed values: the wording of a line
    line = F.concat(
        F.lit("- "),
        F.col("repo_name"),
        F.lit(" (주요 활동: "),
        F.coalesce("dominant_event_type", F.lit("Unknown")),
        F.lit(", 활동수: "),
        F.col("event_count").cast("string"),
        F.lit(")"),
    )
    lines = F.array_sort(F.collect_list(F.struct(F.col("rank"), line.alias("line"))))
    body = F.array_join(F.transform(lines, lambda row: row.getField("line")), "\n")
    return (
        best(ranked, n)
        .groupBy("event_date")
        .agg(F.count(F.lit(1)).alias("n"), body.alias("repo_lines"))
    )
