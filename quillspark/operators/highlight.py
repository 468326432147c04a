"""Highlighted snippets, as array expressions over a row's own text.

A text is cut into alternating words and gaps that join back to it exactly, so a term is marked only
where it is a whole token and the rest can be escaped piece by piece.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.analysis import (
    NON_BLANK,
    TOO_LONG_BYTES,
    WORD,
    has_builtin_stemmer,
    let,
    stem_words_udf,
)

# The marks, the escapes, and the length of a fragment in characters.
OPEN, CLOSE = "<b>", "</b>"
ESCAPES = {"&": "&amp;", "<": "&lt;", ">": "&gt;", '"': "&quot;", "'": "&#x27;"}
FRAGMENT_CHARS = 150


def escaped(text: Column) -> Column:
    for raw, entity in ESCAPES.items():
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def _pieces(text: Column, analyzer: str) -> Column:
    """``array<struct<piece, term>>``: ``term`` is the token's indexed form, null for a gap."""
    if analyzer == "raw":
        return F.when(text.isNotNull(), F.array(F.struct(text.alias("piece"), text.alias("term"))))
    if analyzer == "whitespace":
        pieces = F.regexp_extract_all(text, F.lit(rf"{NON_BLANK}|[ \t\n\f\r]+"), F.lit(0))
        return F.transform(
            pieces, lambda p: F.struct(p.alias("piece"), F.when(p.rlike(f"^{NON_BLANK}"), p).alias("term"))
        )
    gap = WORD.replace("[", "[^", 1)
    pieces = F.regexp_extract_all(text, F.lit(f"{WORD}|{gap}"), F.lit(0))
    token = lambda p: F.when(p.rlike(f"^{WORD}") & (F.octet_length(p) < TOO_LONG_BYTES), F.lower(p))
    if not has_builtin_stemmer(analyzer):
        return F.transform(pieces, lambda p: F.struct(p.alias("piece"), token(p).alias("term")))
    stems = stem_words_udf(F.transform(pieces, lambda p: F.coalesce(token(p), F.lit(""))))
    return F.transform(
        F.arrays_zip(pieces, stems),
        lambda z: F.struct(z["0"].alias("piece"), F.when(z["1"] != "", z["1"]).alias("term")),
    )


def _marked(pieces: Column, known: Column) -> Column:
    marked = F.transform(
        pieces,
        lambda p: F.when(
            F.array_contains(known, p["term"]), F.concat(F.lit(OPEN), escaped(p["piece"]), F.lit(CLOSE))
        ).otherwise(escaped(p["piece"])),
    )
    return F.array_join(marked, "")


def whole_field(text: Column, terms: list[str], analyzer: str = "default") -> Column:
    """The whole text, escaped, with every matching token marked; empty when none matches."""
    if not terms:
        return F.lit("")
    known = F.array(*[F.lit(t) for t in sorted(terms)])

    def mark(pieces: Column) -> Column:
        hit = F.exists(pieces, lambda p: F.coalesce(F.array_contains(known, p["term"]), F.lit(False)))
        return F.when(hit, _marked(pieces, known)).otherwise("")

    return F.coalesce(let(_pieces(text, analyzer), mark), F.lit(""))


def snippet(text: Column, frequencies: dict[str, int] | Column, analyzer: str = "default") -> Column:
    """The best fragment of the text with its matching tokens marked; empty when none matches.

    Fragments follow each other; one closes before the token that would make it longer than
    ``FRAGMENT_CHARS``. A token weighs ``1 / (1 + df)``; the first of the heaviest fragments wins. The words, with their
    df, are the same for all rows, or a map of each row's own.
    """
    if isinstance(frequencies, Column):
        weights = F.transform_values(frequencies, lambda _, df: F.lit(1.0) / (1 + df))
        known = F.map_keys(frequencies)
    elif frequencies:
        terms = sorted(frequencies)
        weights = F.create_map(*[F.lit(x) for t in terms for x in (t, 1.0 / (1 + frequencies[t]))])
        known = F.array(*[F.lit(t) for t in terms])
    else:
        return F.lit("")

    def step(s: Column, numbered: Column) -> Column:
        i, length = numbered["i"], F.length(numbered["p"]["piece"])
        term = numbered["p"]["term"]
        end = s["at"] + length
        gain = F.coalesce(F.get(F.map_values(F.map_filter(weights, lambda k, _: k == term)), F.lit(0)), F.lit(0.0))
        opens = s["first"].isNull() | (end - s["begin"] > FRAGMENT_CHARS)
        closes = opens & (s["score"] > s["best_score"])
        moved = F.struct(
            end.alias("at"),
            F.when(opens, i).otherwise(s["first"]).alias("first"),
            i.alias("last"),
            F.when(opens, s["at"]).otherwise(s["begin"]).alias("begin"),
            F.when(opens, gain).otherwise(s["score"] + gain).alias("score"),
            F.when(closes, s["first"]).otherwise(s["best_first"]).alias("best_first"),
            F.when(closes, s["last"]).otherwise(s["best_last"]).alias("best_last"),
            F.when(closes, s["score"]).otherwise(s["best_score"]).alias("best_score"),
        )
        return F.when(term.isNotNull(), moved).otherwise(s.withField("at", end))

    none = F.lit(None).cast("int")
    start = F.struct(
        F.lit(0).alias("at"), none.alias("first"), none.alias("last"), F.lit(0).alias("begin"),
        F.lit(0.0).alias("score"), none.alias("best_first"), none.alias("best_last"), F.lit(0.0).alias("best_score"),
    )

    def best(pieces: Column) -> Column:
        numbered = F.transform(pieces, lambda p, i: F.struct(p.alias("p"), i.alias("i")))
        ends = F.aggregate(
            numbered,
            start,
            step,
            lambda s: F.when(
                s["score"] > s["best_score"], F.struct(s["first"].alias("a"), s["last"].alias("z"))
            ).when(s["best_score"] > 0, F.struct(s["best_first"].alias("a"), s["best_last"].alias("z"))),
        )
        return let(ends, lambda e: F.when(e.isNotNull(), _marked(F.slice(pieces, e["a"] + 1, e["z"] - e["a"] + 1), known)))

    return F.coalesce(let(_pieces(text, analyzer), best), F.lit(""))

