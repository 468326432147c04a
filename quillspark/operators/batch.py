"""A whole table of queries against the index in one job, top-k per query.

Postings are dealt to blocks of documents once, and a block gives its best of every query
(``quillspark.operators.blocks``). Beyond a size two exact steps spare additions. A query's rarest words, enough to reach ``k``
documents, give the k-th best score a lower bound. Words whose best possible scores together stay below
that bound cannot lift a document into the top k by themselves, so only the other words bring in
candidates, and the common words are looked up for the candidates alone.
"""

from __future__ import annotations

import weakref

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import scoring
from quillspark.functions.analysis import grouped_entries, has_builtin_stemmer, is_stemmed, stemmed_entries, token_entries
from quillspark.mapping import PAIRED
from quillspark.operators import highlight as hl
from quillspark.operators.blocks import MARGIN, best_in_blocks
from quillspark.operators.search import stored_document
from quillspark.plans.compile import BROADCAST_KEYS
from quillspark.sources import tables
from quillspark.sources.index import Index

# Postings to score from which the two steps are worth their own passes.
MANY_POSTINGS = 50_000_000


def _tokens(index: Index, queries: DataFrame, query_id: str, text: str, fields: tuple[str, ...]) -> DataFrame:
    """``(query_id, field, chunk, size, term, pos)``: the analysed tokens of every chunk between white space."""
    chunks = queries.select(query_id, F.posexplode(F.split(F.trim(F.col(text)), r"(?U)\s+")).alias("chunk", "_text"))
    parts = []
    for name in fields or tuple(index.mapping.default_fields):
        analyzer = index.field(name).analyzer
        base = "default" if is_stemmed(analyzer) else analyzer
        staged = chunks.filter("_text != ''").select(query_id, "chunk", token_entries(F.col("_text"), base).alias("e"))
        if has_builtin_stemmer(analyzer):
            staged = staged.withColumn("e", grouped_entries(F.col("e"))).withColumn("e", stemmed_entries(F.col("e")))
        rows = staged.select(query_id, F.lit(name).alias("field"), "chunk", F.size("e").alias("size"), F.inline("e"))
        if analyzer in index.stem_maps:
            stems = index.stem_maps[analyzer].select("term", "stem")
            rows = rows.join(stems, "term", "left").withColumn("term", F.coalesce("stem", "term")).drop("stem")
        parts.append(rows.select(query_id, "field", "chunk", "size", "term", "pos"))
    tokens = parts[0]
    for more in parts[1:]:
        tokens = tokens.unionByName(more)
    return tokens


def query_words(index: Index, queries: DataFrame, query_id: str, text: str, fields: tuple[str, ...] = ()) -> DataFrame:
    """``(query_id, field, term, times)``: the analysed words of every query, phrases apart."""
    return _words(_tokens(index, queries, query_id, text, fields), query_id)


def _words(tokens: DataFrame, query_id: str) -> DataFrame:
    return tokens.filter("size = 1").groupBy(query_id, "field", "term").agg(F.count(F.lit(1)).alias("times"))


def _chunks(index: Index, tokens: DataFrame, query_id: str) -> DataFrame:
    """The parts of the chunks that are several tokens, such as words with a hyphen: their tokens side by side, with the
    weight of the whole. A chunk with a token that no document has is left out."""
    tokens = tokens.filter("size > 1")
    chunk = [query_id, "field", "chunk"]
    words = _weighted(index, tokens.withColumn("times", F.lit(1)))
    whole = words.groupBy(*chunk).agg(F.sum("weight").alias("gain"), F.first("avgdl").alias("avgdl"), F.count("*").alias("known"))
    parts = _phrase_parts(index, tokens, chunk).join(whole, chunk).filter(F.col("known") == F.col("size"))
    return parts.withColumnRenamed("field", "of_field").withColumnRenamed("part_field", "field")


def _phrase_parts(index: Index, tokens: DataFrame, chunk: list[str]) -> DataFrame:
    """``part_field``, ``term`` and ``pos`` that together make each phrase: pairs of frequent words where the index keeps
    them, all other words by themselves; ``parts`` is how many there are."""
    own = Window.partitionBy(*chunk)
    if not any(index.paired.values()):
        return tokens.withColumns({"part_field": F.col("field"), "parts": F.col("size")})
    listed = [(name, word) for name, words in index.paired.items() for word in words]
    often = index.spark.createDataFrame(listed, "field string, term string").withColumn("often", F.lit(True))
    marked = tokens.join(F.broadcast(often), ["field", "term"], "left")
    near = own.orderBy("pos")
    joins = F.col("often") & F.lead("often").over(near) & (F.lead("pos").over(near) == F.col("pos") + 1)
    marked = marked.withColumns({"next": F.lead("term").over(near), "joins": F.coalesce(joins, F.lit(False))})
    marked = marked.withColumn("joined", F.coalesce(F.lag("joins").over(near), F.lit(False)))
    alone = marked.filter("not joins and not joined").select(*chunk, "size", F.col("field").alias("part_field"), "term", "pos")
    pair = (F.concat("field", F.lit(PAIRED)).alias("part_field"), F.concat_ws(" ", "term", "next").alias("term"))
    both = alone.unionByName(marked.filter("joins").select(*chunk, "size", *pair, "pos"))
    return both.withColumn("parts", F.count("*").over(own))


def _weighted(index: Index, words: DataFrame) -> DataFrame:
    """Words that occur in the index, with their weight and the average length of their field."""
    if index.term_buckets:
        words = words.withColumn("term_bucket", tables.bucket_of(F.col("term"), index.term_buckets))
    on = ["field", "term"] + (["term_bucket"] if index.term_buckets else [])
    n_docs, tokens = index.counts
    lengths = F.create_map(*[F.lit(x) for name in index.mapping.default_fields for x in (name, index.avgdl(name))])
    return words.join(index.terms.select(*on, "df"), on).withColumns(
        {
            "weight": F.col("times") * scoring.idf_column(F.col("df"), F.lit(n_docs)),
            "avgdl": F.get(F.map_values(F.map_filter(lengths, lambda k, _: k == F.col("field"))), F.lit(0)),
        }
    )


def batch_search(
    index: Index,
    queries: DataFrame,
    k: int = 10,
    query_id: str = "query_id",
    text: str = "text",
    fields: tuple[str, ...] = (),
    many_postings: int = MANY_POSTINGS,
) -> DataFrame:
    """``(query_id, rank, key, score)``: the top ``k`` documents of every query, as ``search`` would find them one by one.

    ``many_postings`` is where the two steps begin; results do not depend on it. The analysed queries are kept while the
    returned DataFrame is."""
    key = index.mapping.key
    kept = []

    def keep(rows: DataFrame) -> DataFrame:
        # Read several times below; the blocks spill and can be recomputed.
        kept.append(rows.persist(StorageLevel.MEMORY_AND_DISK))
        return rows

    tokens = keep(_tokens(index, queries, query_id, text, fields))
    words = keep(_weighted(index, _words(tokens, query_id)))
    size = words.agg(F.coalesce(F.sum("df"), F.lit(0)).alias("n")).first()["n"]
    phrased = tokens.filter("size > 1").select(query_id).distinct()
    chunks = None if phrased.isEmpty() else keep(_chunks(index, tokens, query_id))
    if size < many_postings:
        words = words.withColumn("optional", F.lit(False))
    else:
        words = _in_two_steps(index, words, query_id, k, None if chunks is None else phrased, keep)
    best = best_in_blocks(index, words, chunks, query_id, k, keep)
    order = Window.partitionBy(query_id).orderBy(F.desc("score"), key)
    ranked = (
        best.withColumn("score", scoring.rounded(F.col("score")))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select(query_id, "rank", key, "score")
    )
    for rows in kept:
        weakref.finalize(ranked, rows.unpersist)
    return ranked


def _in_two_steps(index: Index, words: DataFrame, query_id: str, k: int, phrased: DataFrame | None, keep) -> DataFrame:
    """Words with ``optional``: those that cannot lift a document into the best ``k`` of their query by themselves. Queries
    with phrases are scored in full: a document's words say nothing about the phrases it has."""
    rarest = Window.partitionBy(query_id).orderBy("df", "field", "term")
    before = rarest.rowsBetween(Window.unboundedPreceding, -1)
    words = words.withColumn("reached", F.coalesce(F.sum("df").over(before), F.lit(0)))

    seeds = words.filter(F.col("reached") < 2 * k).withColumn("optional", F.lit(False))
    key = index.mapping.key
    order = Window.partitionBy(query_id).orderBy(F.desc("score"), key)
    bound = (
        best_in_blocks(index, seeds, None, query_id, k, keep)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .groupBy(query_id)
        .agg(F.when(F.count(F.lit(1)) == k, F.min("score")).otherwise(0.0).alias("bound"))
    )

    # From the most common word on: while the words so far cannot reach the bound, they are optional.
    commonest = Window.partitionBy(query_id).orderBy(F.desc("df"), F.desc("field"), F.desc("term"))
    best_so_far = F.sum(F.col("weight") * (scoring.K1 + 1.0)).over(commonest)
    words = words.withColumn("ceiling", best_so_far).join(bound, query_id)
    words = words.withColumn("optional", F.col("ceiling") + MARGIN < F.col("bound")).drop("reached", "ceiling", "bound")

    # Looking words up for candidates must come to fewer rows than scoring their postings outright.
    own = Window.partitionBy(query_id)
    lookups_needed = F.sum(F.when(~F.col("optional"), F.col("df")).otherwise(0)).over(own) * F.count_if("optional").over(own)
    spared = F.sum(F.when(F.col("optional"), F.col("df")).otherwise(0)).over(own)
    words = words.withColumn("optional", F.col("optional") & (lookups_needed < spared))
    if phrased is not None:
        marked = phrased.select(F.col(query_id), F.lit(True).alias("phrased"))
        words = words.join(marked, query_id, "left").withColumn("optional", F.col("optional") & F.col("phrased").isNull()).drop("phrased")
    return keep(words)


def batch_hits(
    index: Index,
    queries: DataFrame,
    k: int = 10,
    query_id: str = "query_id",
    text: str = "text",
    fields: tuple[str, ...] = (),
    highlight: tuple[str, ...] = (),
    stringify: bool = False,
    many_postings: int = MANY_POSTINGS,
) -> DataFrame:
    """``(query_id, rank, key, score, doc, highlights)``: the best hits of every query with stored fields and snippets, as
    ``search`` would give them one by one.

    The words to mark travel with the hits, one map per query and field; stored fields are read for the hits alone."""
    key = index.mapping.key
    best = batch_search(index, queries, k, query_id, text, fields, many_postings)
    shown = [n for n in highlight if index.mapping.has(n)]
    marked = [n for n in shown if index.mapping.field(n).stored and index.mapping.field(n).in_postings]
    hits = index.docs_of(best.select(query_id, "rank", key, "score"))
    analyzers = {}
    if marked:
        words = _marked_words(index, queries, query_id, text, tuple(fields), marked, analyzers)
        hits = hits.join(words, query_id, "left")
    empty = F.create_map().cast("map<string,bigint>")
    entries = []
    for name in shown:
        own = F.coalesce(F.try_element_at("_words", F.lit(name)), empty) if name in marked else None
        snippet = hl.snippet(F.col(f"`{name}`"), own, analyzers[name]) if own is not None else F.lit("")
        entries += [F.lit(name), snippet]
    snippets = F.create_map(*entries) if entries else F.create_map().cast("map<string,string>")
    return hits.select(query_id, "rank", key, "score", stored_document(index, stringify).alias("doc"), snippets.alias("highlights"))


def _marked_words(
    index: Index, queries: DataFrame, query_id: str, text: str, fields: tuple[str, ...], marked: list[str], analyzers: dict[str, str]
) -> DataFrame:
    """``query_id`` and ``_words``, for each field the words to look for with the frequencies of their terms. ``analyzers``
    is told which analyzer finds them."""
    on = ["field", "term"]
    asked = _tokens(index, queries, query_id, text, fields).filter(F.col("field").isin(marked)).select(query_id, *on).distinct()
    if index.term_buckets:
        asked = asked.withColumn("term_bucket", tables.bucket_of(F.col("term"), index.term_buckets))
        on = [*on, "term_bucket"]
    known = asked.join(index.terms.select(*on, "df"), on).select(query_id, "field", F.col("term").alias("word"), "df")
    for name in marked:
        analyzers[name] = index.field(name).analyzer
        if analyzers[name] not in index.stem_maps:
            continue
        # All words that the caller's map sends to a term, and terms that the map does not speak of.
        stems = index.stem_maps[analyzers[name]]
        mine, analyzers[name] = known.filter(F.col("field") == name), "default"
        sent = mine.join(stems.select(F.col("stem").alias("word"), F.col("term").alias("w")), "word")
        same = mine.join(stems.select(F.col("term").alias("word")), "word", "left_anti")
        other = known.filter(F.col("field") != name)
        known = other.unionByName(sent.select(query_id, "field", F.col("w").alias("word"), "df").distinct()).unionByName(same)
    maps = known.groupBy(query_id, "field").agg(F.map_from_entries(F.collect_list(F.struct("word", "df"))).alias("words"))
    return maps.groupBy(query_id).agg(F.map_from_entries(F.collect_list(F.struct("field", "words"))).alias("_words"))


# So many documents times texts, at most, are scored in a task of a search box.
SCORED_PAIRS = 1 << 19
# A word of at least so many letters may be one edit off in a search box.
TYPO_LETTERS = 4


def _shortened(word: Column) -> Column:
    """A word and all it can become by losing a letter. Two words that are one edit apart, or one swap of neighbours,
    have one of these in common."""
    lost = F.transform(
        F.sequence(F.lit(1), F.length(word)),
        lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))),
    )
    return F.array_distinct(F.concat(F.array(word), F.when(F.length(word) > 0, lost).otherwise(F.array().cast("array<string>"))))


def _one_edit(a: Column, b: Column) -> Column:
    """Whether two words are at most one edit apart, a swap of neighbours counting one."""
    n = F.length(a)
    swap = lambda i: F.concat(
        F.substring(a, F.lit(1), i - 1), F.substring(a, i + 1, F.lit(1)), F.substring(a, i, F.lit(1)), F.substring(a, i + 2, n)
    )
    swapped = F.exists(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: swap(i) == b)
    return (F.levenshtein(a, b, 1) >= 0) | ((n == F.length(b)) & (n > 1) & swapped)


def near_terms(index: Index, words: DataFrame, fields: list[str]) -> DataFrame:
    """``(word, field, term)``: for each of ``words`` (``word``, distinct) the terms of the fields that it may stand for in a
    search box: itself, and from ``TYPO_LETTERS`` letters on what is one edit away.

    An edit-distance join by deletions: both sides are spelled out as what is left when a letter goes, joined by equality,
    and the pairs verified. The vocabulary grows by its terms' lengths; nothing is compared with everything."""
    vocabulary = index.terms.filter(F.col("field").isin(fields)).select("field", "term")
    short = words.filter(F.length("word") < TYPO_LETTERS).select("word", F.col("word").alias("term")).join(vocabulary, "term")
    long = words.filter(F.length("word") >= TYPO_LETTERS).select("word", F.explode(_shortened(F.col("word"))).alias("left"))
    terms = vocabulary.filter(F.length("term") >= TYPO_LETTERS - 1).select("field", "term", F.explode(_shortened(F.col("term"))).alias("left"))
    near = long.join(terms, "left").filter(_one_edit(F.col("word"), F.col("term"))).select("word", "field", "term").distinct()
    return short.select("word", "field", "term").unionByName(near)


def batch_search_box(
    index: Index, queries: DataFrame, boosts: dict[str, float], k: int = 10, query_id: str = "query_id", text: str = "text"
) -> DataFrame:
    """``(query_id, rank, key, score)``: the best ``k`` documents of every query text, as the search box finds them one by
    one. Each word of a text gives a field's boost to the documents that have it there, or a word one edit away from it if
    it is long; words that repeat count again.

    Words are looked up once, however many queries have them. A text without words has no hits."""
    key = index.mapping.key
    words = queries.select(query_id, F.explode(F.split(F.trim(F.lower(F.col(text))), r"(?U)\s+")).alias("word")).filter("word != ''")
    words = words.groupBy(query_id, "word").agg(F.count(F.lit(1)).alias("times"))
    near = near_terms(index, words.select("word").distinct(), list(boosts))
    if index.term_buckets:
        near = near.withColumn("term_bucket", tables.bucket_of(F.col("term"), index.term_buckets))
    on = [c for c in ("field", "term", "term_bucket") if c in near.columns]
    found = index.postings.select(*on, key).join(near, on)
    asked, texts = words.agg(F.count(F.lit(1)), F.count_distinct(query_id)).first()
    if asked <= BROADCAST_KEYS:
        # Few words are sent to documents dealt by key, so that neither these nor their queries are shuffled again.
        parts = max(index.spark.sparkContext.defaultParallelism, -(-index.n_docs * texts // SCORED_PAIRS))
        words, found = F.broadcast(words), found.select("word", "field", key).repartition(parts, F.col(key))
    gains = [F.max(F.when(F.col("field") == name, F.lit(float(boost))).otherwise(0.0)) for name, boost in boosts.items()]
    gain = gains[0]
    for more in gains[1:]:
        gain = gain + more
    documents = found.groupBy("word", key).agg(gain.alias("gain"))
    best = documents.join(words, "word").groupBy(query_id, key).agg(F.sum(F.col("gain") * F.col("times")).alias("score"))
    order = Window.partitionBy(query_id).orderBy(F.desc("score"), key)
    ranked = best.withColumn("score", scoring.rounded(F.col("score"))).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select(query_id, "rank", key, "score")
