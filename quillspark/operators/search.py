"""Ranked search: top-k, paging, hits with stored fields and snippets, several indexes at once."""

from __future__ import annotations

from collections.abc import Mapping as Dict
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import scoring
from quillspark.functions.values import ipv4_text
from quillspark.operators import highlight as hl
from quillspark.plans.compile import Compiled, compile_query, matches
from quillspark.plans.query import Query, as_query
from quillspark.sources.index import Index

# Fixed value: hits on a page. Pages up to BROADCAST_HITS rows are sent to the documents, not shuffled.
PAGE = 10
BROADCAST_HITS = 100_000


def ranked(hits: DataFrame, key: str, limit: int | None = PAGE, offset: int = 0) -> DataFrame:
    """One page of hits, best first, ties by key; runs as a bounded top-k per task."""
    hits = hits.withColumn("score", scoring.rounded(F.col("score")))
    if limit is None:
        return hits
    page = hits.orderBy(F.desc("score"), key)
    return (page.offset(offset) if offset else page).limit(limit)


def top_k(
    index: Index, query: str | Query | list, limit: int | None = PAGE, offset: int = 0, fields: tuple[str, ...] = ()
) -> DataFrame:
    """``(key, score)`` of one page."""
    best = limit + offset if limit else None
    hits = compile_query(as_query(query, fields), index, best=best).hits
    return ranked(hits, index.mapping.key, limit, offset)


def count_hits(index: Index, query: str | Query | list, fields: tuple[str, ...] = ()) -> DataFrame:
    """How many documents match, as one row."""
    return matches(as_query(query, fields), index).agg(F.count(F.lit(1)).alias("hits"))


def stored_document(index: Index, stringify: bool = False) -> Column:
    """The stored fields as one struct, in their own types or as text."""

    def shown(name: str) -> Column:
        column, kind = F.col(f"`{name}`"), index.mapping.type_of(name)
        if not stringify:
            return column
        if kind == "date":
            return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss'Z'")
        if kind == "bytes":
            return F.decode(column, "UTF-8")
        if kind == "json":
            return F.to_json(column)
        return ipv4_text(column) if kind == "ip_addr" else column.cast("string")

    names = index.mapping.stored
    return F.struct(*[shown(n).alias(n) for n in names]) if names else F.lit(None).cast("struct<>")


def search(
    index: Index,
    query: str | Query | list,
    limit: int = PAGE,
    offset: int = 0,
    fields: tuple[str, ...] = (),
    highlight: tuple[str, ...] = (),
    highlight_expanded: bool = False,
    stringify: bool = False,
) -> DataFrame:
    """``(rank, key, score, doc, highlights)`` of one page of hits.

    Stored fields are read after the limit, for the hits alone.
    """
    key = index.mapping.key
    compiled = compile_query(as_query(query, fields), index, highlight_expanded, best=limit + offset if limit else None)
    page = ranked(compiled.hits, key, limit, offset)
    if limit <= BROADCAST_HITS:
        page = F.broadcast(page)
    words = compiled.words
    if highlight_expanded and compiled.patterns:
        words = _words_on_page(index, compiled, page.select(key), highlight)
    snippets = snippet_map(index, highlight, words)
    hits = index.docs_of(page).select(key, "score", stored_document(index, stringify).alias("doc"), snippets.alias("highlights"))
    # The page is as long as the caller's limit, so numbering it in one task is bounded.
    best_first = Window.orderBy(F.desc("score"), key)
    return hits.select((F.row_number().over(best_first) + offset).alias("rank"), key, "score", "doc", "highlights")


def _words_on_page(index: Index, compiled: Compiled, page: DataFrame, fields: tuple[str, ...]) -> Dict[str, Dict[str, int]]:
    """The words to highlight where a pattern has too many terms to list: those that the documents of the page have."""
    words = {name: dict(own) for name, own in compiled.words.items()}
    for name, matching in compiled.patterns:
        if name not in fields:
            continue
        rows = index.postings.filter((F.col("field") == name) & matching).join(page, index.mapping.key, "left_semi")
        terms = [r["term"] for r in rows.select("term").distinct().collect()]
        frequencies = index.doc_frequencies((name, t) for t in terms)
        words.setdefault(name, {}).update({t: df for (_, t), df in frequencies.items()})
    return words


def snippet_map(index: Index, fields: tuple[str, ...], words: Dict[str, Dict[str, int]]) -> Column:
    """One snippet per requested field; unknown fields are left out, no match gives an empty snippet."""
    entries = []
    for name in fields:
        if not index.mapping.has(name):
            continue
        f = index.mapping.field(name)
        shown = f.stored and f.type in ("text", "string")
        snippet = hl.snippet(F.col(f"`{name}`"), *index.surface_words(name, words.get(name, {}))) if shown else F.lit("")
        entries += [F.lit(name), snippet]
    if not entries:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*entries)


def highlight_all(index: Index, query: str | Query | list, field: str, fields: tuple[str, ...] = ()) -> DataFrame:
    """``(key, highlight)`` of every hit, whole field, for result sets of any size."""
    key = index.mapping.key
    compiled = compile_query(as_query(query, fields), index)
    words, analyzer = index.surface_words(field, compiled.words.get(field, {}))
    marked = hl.whole_field(F.col(f"`{field}`"), sorted(words), analyzer)
    return index.docs_of(compiled.keys(key), "left_semi").select(key, marked.alias("highlight"))


def search_indexes(
    indexes: Dict[str, Index], query: str | Query | list, limit: int = PAGE, highlight: Dict[str, tuple[str, ...]] | None = None
) -> DataFrame:
    """The best hits of several indexes, tagged with the index they come from, merged by score."""
    highlight = highlight or {}
    pages = []
    for name, index in indexes.items():
        hits = search(index, query, limit, highlight=highlight.get(name, ()), stringify=True)
        pages.append(
            hits.select(
                F.lit(name).alias("source_index"),
                F.col(index.mapping.key).cast("string").alias("id"),
                "score",
                F.to_json("doc").alias("doc"),
                "highlights",
            )
        )
    merged = reduce(DataFrame.unionByName, pages)
    return merged.orderBy(F.desc("score"), "source_index", "id").limit(limit)


def lookup(index: Index, field: str, value) -> DataFrame:
    """The first document with this value in the field, in key order."""
    return browse(index, field, value).orderBy(index.mapping.key).limit(1)


def browse(index: Index, field: str | None = None, value=None) -> DataFrame:
    """Documents of one category, or all of them; the condition reaches the scan."""
    docs = index.docs if field is None or value is None else index.docs.filter(F.col(f"`{field}`") == value)
    return docs.select(index.mapping.key, *[f"`{n}`" for n in index.mapping.stored])
