"""Text analysis as Spark column expressions.

Every expression here works inside one row: a document is split, filtered, sorted and grouped
into postings by array functions on the JVM, so building postings needs no shuffle at all.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.stemming import stem_words, stem_words_udf

# What a token is, and the byte length from which a token is dropped.
WORD = r"[\p{IsAlphabetic}\p{N}]+"
NON_BLANK = r"[^ \t\n\f\r]+"
BETWEEN_WORDS, BLANK = r"[^\p{IsAlphabetic}\p{N}]+", r"[ \t\n\f\r]+"
TOO_LONG_BYTES = 40
# Slots of the frequent words whose pairs are kept.
WORD_SLOTS = 4096


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def token_entries(text: Column, analyzer: str) -> Column:
    """``array<struct<term, pos>>`` of a text, before any stemming.

    ``pos`` counts tokens before the length filter, so a dropped token leaves a hole.
    """
    if analyzer == "raw":
        return F.when(text.isNotNull(), F.array(F.struct(text.alias("term"), F.lit(0).alias("pos"))))
    if analyzer == "whitespace":
        words = F.regexp_extract_all(text, F.lit(NON_BLANK), F.lit(0))
        return F.transform(words, lambda w, i: F.struct(w.alias("term"), i.alias("pos")))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    kept = lambda w: F.when(F.octet_length(w) < TOO_LONG_BYTES, F.lower(w))
    placed = F.transform(words, lambda w, i: F.struct(kept(w).alias("term"), i.alias("pos")))
    return F.filter(placed, lambda e: e["term"].isNotNull())


def separated(text: Column, analyzer: str) -> tuple[Column, Column]:
    """The words of ``token_entries`` as one text with a blank between two of them, too long ones included, and that text
    before lowercasing where a length may differ. A ``raw`` value is left whole."""
    none = F.lit(None).cast("string")
    if analyzer == "raw":
        return text, none
    if analyzer == "whitespace":
        return F.regexp_replace(text, BLANK, " "), none
    words = F.regexp_replace(text, BETWEEN_WORDS, " ")
    return F.lower(words), F.when(F.octet_length(words) != F.length(words), words)


def has_tokens(text: Column, analyzer: str) -> Column:
    """Whether a text has any token at all."""
    entries = token_entries(text, "default" if is_stemmed(analyzer) else analyzer)
    return F.coalesce(F.size(entries) > 0, F.lit(False))


def has_builtin_stemmer(analyzer: str) -> bool:
    return analyzer == "en_stem"


def is_stemmed(analyzer: str) -> bool:
    return analyzer.endswith("_stem")


def stemmed_entries(groups: Column) -> Column:
    """Entries with English stems, from the grouped entries of a row: only its distinct terms are stemmed, in one Arrow
    call per batch, memoised per worker."""
    stems = stem_words_udf(F.transform(groups, lambda g: g["term"]))
    placed = lambda z: F.transform(
        z["0"]["positions"], lambda p: F.struct(z["1"].alias("term"), p.alias("pos"))
    )
    return F.flatten(F.transform(F.arrays_zip(groups.alias("0"), stems.alias("1")), placed))


def grouped_entries(entries: Column) -> Column:
    """``array<struct<term, tf, dl, positions>>``: one element per distinct term of the row.

    Sorting the entries puts equal terms side by side in position order; the run boundaries then
    give every term's frequency and positions by slicing. Cost is that of one in-row sort.
    """
    return let(F.sort_array(entries), lambda s: F.when(F.size(s) > 0, let(run_starts(s), lambda st: runs(s, st))))


def run_starts(ordered: Column) -> Column:
    """Where each distinct term of sorted entries begins."""
    first = lambda e, i: F.when((i == 0) | (e["term"] != F.get(ordered, i - 1)["term"]), i)
    return F.array_compact(F.transform(ordered, first))


def runs(ordered: Column, starts: Column, **more: Column) -> Column:
    """The groups of sorted entries, from where each begins; ``more`` are columns that stand before every group's own.

    Every array function copies what it hands on, so sorted entries and starts are best columns of their own."""
    n = F.size(ordered)
    end = lambda j: F.coalesce(F.get(starts, j + 1), n)
    return F.transform(
        starts,
        lambda a, j: F.struct(
            *[c.alias(name) for name, c in more.items()],
            F.get(ordered, a)["term"].alias("term"),
            (end(j) - a).alias("tf"),
            n.alias("dl"),
            F.transform(F.sequence(a, end(j) - 1), lambda k: F.get(ordered, k)["pos"]).alias("positions"),
        ),
    )


def word_slots(spark: SparkSession, words: list[str]) -> list[str]:
    """Words, each at the slot its hash says, so that one look tells whether a term is among them; of words that share a
    slot the first stays. No job runs."""
    if not words:
        return []
    rows = spark.createDataFrame(pa.table({"t": pa.array(words, pa.string())}))
    slots = [""] * WORD_SLOTS
    for r in rows.select("t", _slot(F.col("t")).alias("slot")).collect():
        slots[r["slot"]] = slots[r["slot"]] or r["t"]
    return slots


def _slot(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(WORD_SLOTS)).cast("int")


def pair_entries(entries: Column, slots: list[str]) -> Column:
    """The pairs of adjacent terms that are both in ``slots``, as entries of one term with a blank in it, at the first's
    position. ``entries`` are in the order of the text."""
    table = F.split(F.lit("\n".join(slots)), "\n", -1)  # folds to one constant
    mark = lambda e: F.struct(e["term"].alias("term"), e["pos"].alias("pos"), (F.get(table, _slot(e["term"])) == e["term"]).alias("in"))

    def pairs(m: Column) -> Column:
        after = lambda i: F.get(m, i + 1)
        near = lambda i: F.get(m, i)["in"] & after(i)["in"] & (after(i)["pos"] == F.get(m, i)["pos"] + 1)
        both = F.filter(F.sequence(F.lit(0), F.size(m) - 2), near)
        return F.transform(both, lambda i: F.struct(F.concat_ws(" ", F.get(m, i)["term"], after(i)["term"]).alias("term"), F.get(m, i)["pos"].alias("pos")))

    return F.when(F.size(entries) > 1, let(F.transform(entries, mark), pairs))


def analyze_literals(spark: SparkSession, texts: list[str], analyzer: str) -> list[list[tuple[str, int]]]:
    """The (term, position) lists of query literals, by the expression that analysed the documents.

    The input is a local relation, so Catalyst folds the answer on the driver and no job runs.
    """
    if not texts:
        return []
    base = "default" if is_stemmed(analyzer) else analyzer
    rows = spark.createDataFrame(pa.table({"t": pa.array(texts, pa.string())}))
    found = [r["e"] or [] for r in rows.select(token_entries(F.col("t"), base).alias("e")).collect()]
    stem = stem_words if has_builtin_stemmer(analyzer) else list
    return [list(zip(stem([e["term"] for e in entries]), [e["pos"] for e in entries])) for entries in found]
