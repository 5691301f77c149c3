"""Repository language from an event payload."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import PAYLOAD

UNKNOWN = "Unknown"

# Lower-case spelling -> canonical name.
ALIASES = {
    "javascript": "JavaScript",
    "js": "JavaScript",
    "typescript": "TypeScript",
    "ts": "TypeScript",
    "python": "Python",
    "py": "Python",
    "rust": "Rust",
    "go": "Go",
    "golang": "Go",
    "c++": "C++",
    "cpp": "C++",
    "c#": "C#",
    "csharp": "C#",
    "": UNKNOWN,
}

# Where a language may stand, most specific place first.
LANGUAGE_PATHS = [
    "pull_request.head.repo.language",
    "pull_request.base.repo.language",
    "repository.language",
    "forkee.language",
    "release.author.repo.language",
    "head_commit.repo.language",
]


def parsed_payload(payload: Column) -> Column:
    """The payload members in use, from one JSON parse per row."""
    return F.from_json(payload, PAYLOAD)


def scalar_or_null(value: Column) -> Column:
    """NULL for a JSON object or array, which arrive here as their JSON text."""
    nested = F.startswith(value, F.lit("{")) | F.startswith(value, F.lit("["))
    return F.when(~nested, value)


def raw_language(parsed: Column) -> Column:
    def member(path: str) -> Column:
        found = parsed
        for step in path.split("."):
            found = found.getField(step)
        return scalar_or_null(found)

    return F.coalesce(*[member(path) for path in LANGUAGE_PATHS])


def normalize_language(raw: Column) -> Column:
    """Canonical name; other spellings keep their own case, empty is Unknown."""
    text = F.coalesce(raw, F.lit(""))
    pairs = [F.lit(part) for pair in ALIASES.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(text)), text)
