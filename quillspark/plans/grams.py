"""What a term must contain to match a pattern: sets of three-letter pieces, found in a table instead of the vocabulary.

A term's pieces are those of the term between two marks, so they also say how it begins and ends. A filter is a list of
alternatives, each some pieces and how many of them a term has at least. It lets through every term that matches, and
others; the pattern itself decides. Where nothing can be said for sure there is no filter.
"""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

BEGIN, END = "\x02", "\x03"
SIZE = 3
#: A regex that stands for more strings than this gets no filter; a class with more letters is a gap.
MOST_STRINGS, MOST_LETTERS = 48, 6
#: Pieces asked for at most: the longest stretches come first, and fewer pieces only let more terms through.
MOST_PIECES = 64


@dataclass(frozen=True)
class Filter:
    """Alternatives of (pieces, how many of them a term has at least)."""

    alternatives: tuple[tuple[frozenset[str], int], ...]

    @property
    def pieces(self) -> list[str]:
        return sorted(set().union(*(pieces for pieces, _ in self.alternatives)))

    def passes(self, have: Column) -> Column:
        """Whether a set of pieces is enough for one of the alternatives."""
        tests = [F.size(F.array_intersect(have, F.array(*map(F.lit, sorted(p))))) >= n for p, n in self.alternatives]
        passed = tests[0]
        for test in tests[1:]:
            passed = passed | test
        return passed


def pieces_of(term: Column) -> Column:
    """The distinct pieces of a term; a term of no letters has one, the two marks."""
    marked = F.concat(F.lit(BEGIN), term, F.lit(END))
    places = F.sequence(F.lit(1), F.greatest(F.length(term), F.lit(1)))
    return F.array_distinct(F.transform(places, lambda i: F.substring(marked, i, F.lit(SIZE))))


def _pieces(text: str) -> set[str]:
    return {text[i : i + SIZE] for i in range(len(text) - SIZE + 1)}


def for_fuzzy(value: str, distance: int, swaps: bool) -> Filter | None:
    """An edit spoils the pieces it touches: three, or four if it swaps neighbours. What is left must be shared."""
    pieces = _pieces(BEGIN + value + END)
    least = len(pieces) - distance * (SIZE + 1 if swaps else SIZE)
    return Filter(((frozenset(pieces), least),)) if least > 0 else None


class _Unsure(Exception):
    """Nothing can be said for sure."""


def for_regex(pattern: str) -> Filter | None:
    """From the strings that the whole of a term must consist of, with gaps where anything may stand.

    Only what the two regex dialects at hand read alike is looked at; flags, escapes and classes that they may read
    differently give no filter."""
    if any(s in pattern for s in ("\\0", "\\b{", "\\Q", "&&")) or "(?" in pattern.replace("(?:", ""):
        return None
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("error")
            tree = re._parser.parse(pattern)
        if tree.state.flags & ~re.UNICODE.value:
            return None
        strings = _strings(tree)
    except (re.error, _Unsure, RecursionError, FutureWarning, DeprecationWarning, OverflowError):
        return None
    alternatives = []
    for letters in strings:
        text = "".join("\n" if c is None else c for c in (BEGIN, *letters, END))
        runs = sorted((run for run in text.split("\n") if len(run) >= SIZE), key=len, reverse=True)
        pieces = sorted(set().union(*map(_pieces, runs))) if runs else []
        if not pieces:
            return None
        alternatives.append((frozenset(pieces[:MOST_PIECES]), min(len(pieces), MOST_PIECES)))
    return Filter(tuple(dict.fromkeys(alternatives)))


def _strings(tree) -> list[tuple[str | None, ...]]:
    """All strings a part of a regex can be; None is a gap of any length."""
    found: list[tuple[str | None, ...]] = [()]
    for op, value in tree:
        part = _part(str(op), value)
        found = [a + b for a, b in product(found, part)]
        if len(found) > MOST_STRINGS:
            raise _Unsure
    return found


def _part(op: str, value) -> list[tuple[str | None, ...]]:
    gap: list[tuple[str | None, ...]] = [(None,)]
    match op:
        case "LITERAL":
            return [(chr(value),)] if value >= 0x20 and not 0xD800 <= value < 0xE000 else gap
        case "ANY" | "NOT_LITERAL":
            return gap
        case "IN":
            return _class(value) or gap
        case "AT":
            return [()]
        case "BRANCH":
            return [s for branch in value[1] for s in _strings(branch)]
        case "SUBPATTERN":
            _, added, removed, inner = value
            if added or removed:
                raise _Unsure
            return _strings(inner)
        case "ATOMIC_GROUP":
            return _strings(value)
        case "MAX_REPEAT" | "MIN_REPEAT" | "POSSESSIVE_REPEAT":
            least, most, inner = value
            if least == 0:
                return gap
            once = _strings(inner)
            if least == most and len(once) == 1 and least <= 8:
                return [once[0] * least]
            return once if most == 1 else [s + (None,) for s in once]
    raise _Unsure


def _class(items) -> list[tuple[str | None, ...]] | None:
    """The letters of a small class."""
    letters: list[int] = []
    for op, value in items:
        if str(op) == "LITERAL":
            if chr(value) in "[&":  # another dialect may see a class in the class
                raise _Unsure
            letters.append(value)
        elif str(op) == "RANGE":
            if value[1] - value[0] >= MOST_LETTERS:
                return None
            letters += range(value[0], value[1] + 1)
        else:
            return None
    if len(letters) > MOST_LETTERS or any(c < 0x20 or 0xD800 <= c < 0xE000 for c in letters):
        return None
    return [(chr(c),) for c in letters]
