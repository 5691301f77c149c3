"""Classifier answers (free text around JSON) to typed columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The categories a repository may have.
CATEGORIES = ["AI/ML", "Web", "Infra", "DevTools", "Game", "Other"]
PARSE_FAILED = "JSON parse failed"

_JSON = {"allowSingleQuotes": "false"}
JSON_FENCE = "```json"
FENCE = "```"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def after_first(text: Column, mark: str) -> Column:
    """Text after the first ``mark``; NULL when it does not occur."""
    at = F.instr(text, mark)
    return F.when(at > 0, F.substr(text, at + len(mark)))


def fenced(text: Column, mark: str) -> Column:
    """Text from the first ``mark`` to the next fence, or to the end."""
    return F.substring_index(after_first(text, mark), FENCE, 1)


def span(text: Column, first: str, last: str) -> Column:
    """Text from the first ``first`` to the last ``last``; NULL without both."""
    start = F.instr(text, first)
    end = F.length(text) - F.instr(F.reverse(text), last) + 1
    both = (start > 0) & (F.instr(text, last) > 0) & (end >= start)
    return F.when(both, F.substr(text, start, end - start + 1))


def single_json(text: Column, opening: str) -> Column:
    """The text when it is exactly one JSON value that begins with ``opening``.

    Read as the only element of an array, so anything after the value makes
    it invalid.
    """
    elements = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", _JSON)

    def only_one(found: Column) -> Column:
        first = F.get(found, 0)
        return F.when((F.size(found) == 1) & F.startswith(first, F.lit(opening)), first)

    return let(elements, only_one)


def json_object(text: Column) -> Column:
    """Members of a JSON object as text; NULL when it is none."""
    return F.from_json(single_json(text, "{"), "map<string,string>", _JSON)


def _category(members: Column) -> Column:
    category = F.try_element_at(members, F.lit("category"))
    return F.when(category.isin(CATEGORIES), category).otherwise("Other")


def _confidence(members: Column) -> Column:
    number = F.try_element_at(members, F.lit("confidence")).try_cast("double")
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), number))
    return F.when(number.isNull(), 0.0).otherwise(clamped)


def _text(members: Column, key: str) -> Column:
    """A member as text: '' when missing, 'None' when it is null."""
    value = F.coalesce(F.try_element_at(members, F.lit(key)), F.lit("None"))
    return F.when(F.map_contains_key(members, key), value).otherwise("")


def _answer(members: Column) -> list[Column]:
    return [
        _category(members).alias("category"),
        _confidence(members).alias("confidence"),
        _text(members, "reasoning").alias("reasoning"),
    ]


def parse_category_response(text: Column) -> Column:
    """struct<category, confidence, reasoning> of one answer.

    A json fence is tried first, then a plain fence, then the text from the
    first brace to the last; an answer with no readable object is Other / 0.
    """

    def members_of(answer: Column) -> Column:
        return F.coalesce(
            json_object(fenced(answer, JSON_FENCE)),
            json_object(fenced(answer, FENCE)),
            json_object(span(answer, "{", "}")),
        )

    members = let(text, members_of)
    failed = F.struct(
        F.lit("Other").alias("category"),
        F.lit(0.0).alias("confidence"),
        F.lit(PARSE_FAILED).alias("reasoning"),
    )
    return let(members, lambda m: F.when(m.isNotNull(), F.struct(*_answer(m))).otherwise(failed))


def parse_batch_response(text: Column) -> Column:
    """array<struct<repo_name, category, confidence, reasoning>> of an answer.

    One form only: the json fence, else a plain fence, else first to last
    bracket. Elements that are no objects are dropped; an unreadable answer
    or one that is no list gives an empty array.
    """

    def chunk_of(answer: Column) -> Column:
        return F.coalesce(
            fenced(answer, JSON_FENCE), fenced(answer, FENCE), span(answer, "[", "]"), answer
        )

    chunk = let(text, chunk_of)
    elements = F.from_json(single_json(chunk, "["), "array<string>", _JSON)
    objects = F.filter(F.transform(elements, json_object), lambda members: members.isNotNull())

    def item(members: Column) -> Column:
        return F.struct(F.trim(_text(members, "repo_name")).alias("repo_name"), *_answer(members))

    empty = "array<struct<repo_name:string,category:string,confidence:double,reasoning:string>>"
    return F.coalesce(F.transform(objects, item), F.array().cast(empty))
