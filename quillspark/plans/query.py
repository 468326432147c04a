"""Queries as immutable values. Building one touches no data and needs no index."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from quillspark.errors import QueryError

# How a clause takes part, and how many terms a phrase prefix expands to.
OCCURS = ("must", "should", "must_not")


class Query:
    """Base of all queries."""


@dataclass(frozen=True)
class Match(Query):
    """Any of the words, in any of the fields; a word that splits into several tokens is a phrase."""

    text: str
    fields: tuple[str, ...] = ()


@dataclass(frozen=True)
class Term(Query):
    """Exactly this value: a verbatim token of a text or string field, or a typed value."""

    field: str
    value: Any


@dataclass(frozen=True)
class All(Query):
    """Every document."""


@dataclass(frozen=True)
class Phrase(Query):
    """Adjacent words in order; words are only lowercased."""

    field: str
    words: tuple[str, ...]


@dataclass(frozen=True)
class PhrasePrefix(Query):
    """A phrase whose last word is a prefix: of any term, or, if the caller says so, of the first ``max_expansions``."""

    field: str
    words: tuple[str, ...]
    max_expansions: int | None = None


@dataclass(frozen=True)
class QuotedPhrase(Query):
    """A quoted text, analysed per field, over the default fields or the given ones."""

    text: str
    fields: tuple[str, ...] = ()


@dataclass(frozen=True)
class Regex(Query):
    """Documents with a term the whole of which matches the pattern."""

    field: str
    pattern: str


@dataclass(frozen=True)
class Exists(Query):
    """Documents with any value in the field."""

    field: str


@dataclass(frozen=True)
class Fuzzy(Query):
    """Documents with a term within an edit distance of 0 to 2."""

    field: str
    value: str
    distance: int = 1
    transpose_costs_one: bool = True

    def __post_init__(self):
        if self.distance not in (0, 1, 2):
            raise QueryError(f"invalid fuzzy distance: {self.distance}. Expected 0, 1 or 2")


@dataclass(frozen=True)
class Prefix(Query):
    """Documents with a term that starts like this."""

    field: str
    prefix: str


@dataclass(frozen=True)
class Range(Query):
    """Values between two ends; None leaves an end open."""

    field: str
    lower: Any = None
    upper: Any = None
    include_lower: bool = True
    include_upper: bool = True


@dataclass(frozen=True)
class JsonPath(Query):
    """A value inside a json field: ``JsonPath("props", "user.name", "ann")``."""

    field: str
    path: str
    value: Any


@dataclass(frozen=True)
class Facet(Query):
    """Documents filed under this path or anywhere below it."""

    field: str
    path: str


@dataclass(frozen=True)
class Bool(Query):
    """Clauses ``(occur, query)``; occur is must, should or must_not."""

    clauses: tuple[tuple[str, Query], ...]

    def __post_init__(self):
        for occur, _ in self.clauses:
            if occur not in OCCURS:
                raise QueryError(f"{occur!r} is no kind of clause; there are {', '.join(OCCURS)}")


@dataclass(frozen=True)
class Boost(Query):
    """The same documents with the score multiplied; the factor is a float."""

    query: Query
    factor: float

    def __post_init__(self):
        if not isinstance(self.factor, float):
            raise QueryError(f"boost factor must be a float: {self.factor!r}")


def match(text: str, *fields: str) -> Match:
    return Match(text, tuple(fields))


def phrase(field: str, *words: str) -> Phrase:
    return Phrase(field, tuple(words))


def phrase_prefix(field: str, *words: str, max_expansions: int | None = None) -> PhrasePrefix:
    return PhrasePrefix(field, tuple(words), max_expansions)


def boolean(*clauses: tuple[str, Query]) -> Bool:
    return Bool(tuple(clauses))


def all_of(*queries: Query) -> Bool:
    """Every query must match: ``a AND b``."""
    return Bool(tuple(("must", q) for q in queries))


def any_of(*queries: Query) -> Bool:
    """At least one must match: ``a OR b``."""
    return Bool(tuple(("should", q) for q in queries))


def none_of(*queries: Query) -> Bool:
    """Exclusions, ``NOT a``; combine with a positive query, alone they match nothing."""
    return Bool(tuple(("must_not", q) for q in queries))


def boosted_fields(text: str, boosts: dict[str, float]) -> Bool:
    """The text in several fields, each field with its own weight."""
    return any_of(*[Boost(Match(text, (f,)), w) if w != 1.0 else Match(text, (f,)) for f, w in boosts.items()])


def search_box(text: str, boosts: dict[str, float]) -> Bool | None:
    """A typo-tolerant search box: short words exactly, longer ones within one edit; None when blank."""
    clauses = []
    for word in text.lower().split():
        for field, weight in boosts.items():
            fuzzy = Fuzzy(field, word, 0 if len(word) <= 3 else 1)
            clauses.append(Boost(fuzzy, weight) if weight != 1.0 else fuzzy)
    return any_of(*clauses) if clauses else None


def as_query(value: str | Query | list | tuple, fields: tuple[str, ...] = ()) -> Query:
    """Text, a built query, or ``[(occur, text or query), ...]`` to a query."""
    if isinstance(value, Query):
        return value
    if isinstance(value, str):
        return Match(value, tuple(fields))
    if isinstance(value, (list, tuple)) and value:
        return Bool(tuple((occur, as_query(part, fields)) for occur, part in value))
    raise QueryError(f"not a query: {value!r}")
