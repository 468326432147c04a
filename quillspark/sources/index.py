"""One consistent state of an index: its tables as DataFrames plus its counts.

An ``Index`` never changes. Adding or deleting gives another ``Index`` (in memory) or another version
(on disk, ``quillspark.sources.versions``), so whoever holds one keeps reading what it held.
"""

from __future__ import annotations

from collections.abc import Iterable
from collections.abc import Mapping as Dict
from functools import cached_property, reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.errors import QueryError
from quillspark.functions import analysis
from quillspark.functions.coerce import coerce
from quillspark.mapping import PAIRED, Field, Mapping
from quillspark.plans.grams import Filter
from quillspark.sources import tables

# The most vocabulary entries a pattern may resolve to before the pattern itself is applied to the
# postings instead; both give the same rows.
RESOLVED_TERMS = 1000


class Index:
    def __init__(
        self,
        spark: SparkSession,
        mapping: Mapping,
        docs: DataFrame,
        postings: DataFrame,
        terms: DataFrame,
        counts: tuple[int, Dict[str, int]] | None = None,
        term_buckets: int | None = None,
        doc_buckets: int | None = None,
        stem_maps: Dict[str, DataFrame] | None = None,
        paired: Dict[str, list[str]] | None = None,
        grams: DataFrame | None = None,
        tiers: DataFrame | None = None,
        lengths: Dict[str, float] | None = None,
        summaries: DataFrame | None = None,
        ranges: Dict[str, DataFrame] | None = None,
        cuts: Dict[str, list[str]] | None = None,
    ):
        """``postings`` and ``terms`` may hold pairs of the words in ``paired``; ``grams`` leads from pieces to terms."""
        self.spark = spark
        self.mapping = mapping
        self.docs = docs
        self.paired = {name: frozenset(words) for name, words in (paired or {}).items()}
        self.everything, self.statistics, self.grams = postings, terms, grams
        # How many postings of a term are in each tier, where none of them is of a deleted document.
        self.tiers, self.lengths = tiers, dict(lengths or {})
        self.summaries = summaries
        self.ranges, self.cuts = dict(ranges or {}), dict(cuts or {})
        words = ~F.col("field").endswith(PAIRED)
        self.postings = postings.filter(words) if self.paired else postings
        self.terms = terms.filter(words) if self.paired else terms
        self.term_buckets = term_buckets
        self.doc_buckets = doc_buckets
        self.stem_maps = dict(stem_maps or {})
        self._counts = counts

    # -- in memory ---------------------------------------------------------------------------

    @classmethod
    def in_memory(
        cls, records: DataFrame, mapping: Mapping, stem_maps: Dict[str, DataFrame] | None = None, typed: bool = False
    ) -> Index:
        """Index a batch of records without a directory; blocks spill to disk and are recomputable."""
        documents = tables.spread(records if typed else coerce(records, mapping))
        docs = tables.docs_table(documents, mapping).persist(StorageLevel.MEMORY_AND_DISK)
        postings = tables.postings_table(documents, mapping, stem_maps).persist(StorageLevel.MEMORY_AND_DISK)
        terms = tables.terms_table(postings).persist(StorageLevel.MEMORY_AND_DISK)
        return cls(records.sparkSession, mapping, docs, postings, terms, stem_maps=stem_maps)

    def added(self, records: DataFrame) -> Index:
        """This index plus a batch of records."""
        more = Index.in_memory(records, self.mapping, self.stem_maps)
        postings = self.postings.unionByName(more.postings)
        terms = self.terms.unionByName(more.terms).groupBy("field", "term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))
        return Index(
            self.spark, self.mapping, self.docs.unionByName(more.docs), postings,
            terms.persist(StorageLevel.MEMORY_AND_DISK), stem_maps=self.stem_maps,
        )

    def without(self, keys: DataFrame) -> Index:
        """This index minus the documents with these keys; statistics come from what remains."""
        key = self.mapping.key
        postings = self.postings.join(keys, key, "left_anti")
        return Index(
            self.spark, self.mapping, self.docs.join(keys, key, "left_anti"), postings,
            tables.terms_table(postings).persist(StorageLevel.MEMORY_AND_DISK), stem_maps=self.stem_maps,
        )

    def close(self) -> None:
        for table in (self.docs, self.postings, self.terms):
            table.unpersist()

    # -- statistics --------------------------------------------------------------------------

    @cached_property
    def counts(self) -> tuple[int, Dict[str, int]]:
        """Documents in the index, and tokens per field: one number per mapped field."""
        if self._counts is not None:
            return self._counts
        sums = self.terms.groupBy("field").agg(F.sum("cf").alias("n")).collect()
        return self.docs.count(), {r["field"]: r["n"] for r in sums}

    @property
    def n_docs(self) -> int:
        return self.counts[0]

    def avgdl(self, field: str) -> float:
        tokens = self.counts[1].get(field, 0)
        return tokens / self.n_docs if self.n_docs and tokens else 1.0

    def field_stats(self) -> DataFrame:
        """field, n_docs, sum_dl."""
        n_docs, tokens = self.counts
        rows = [(n, n_docs, int(tokens.get(n, 0))) for n in tables.indexed_fields(self.mapping)]
        return self.spark.createDataFrame(rows, "field string, n_docs bigint, sum_dl bigint")

    def _in_buckets(self, terms: Iterable[str]) -> Column:
        if not self.term_buckets:
            return F.lit(True)
        return F.col("term_bucket").isin([tables.bucket_of(F.lit(t), self.term_buckets) for t in terms])

    def doc_frequencies(self, pairs: Iterable[tuple[str, str]]) -> dict[tuple[str, str], int]:
        """df of the given (field, term) pairs; as many rows come back as a query has words."""
        pairs = set(pairs)
        if not pairs:
            return {}
        names, words = {f for f, _ in pairs}, {t for _, t in pairs}
        rows = self.statistics.filter(
            F.col("field").isin(*names) & F.col("term").isin(*words) & self._in_buckets(words)
        ).select("field", "term", "df")
        found = {(r["field"], r["term"]): r["df"] for r in rows.collect()}
        return {p: found[p] for p in pairs if p in found}

    def tier_counts(self, pairs: Iterable[tuple[str, str]]) -> dict[tuple[str, str], dict[int, int]]:
        """How many postings the (field, term) pairs have in each tier; nothing for rare terms. As many rows come back as a
        query has words, times batches."""
        pairs = set(pairs)
        if self.tiers is None or not pairs:
            return {}
        names, words = {f for f, _ in pairs}, {t for _, t in pairs}
        rows = self.tiers.filter(F.col("field").isin(*names) & F.col("term").isin(*words) & self._in_buckets(words))
        found: dict[tuple[str, str], dict[int, int]] = {}
        for r in rows.select("field", "term", "tiers").collect():
            if (r["field"], r["term"]) in pairs:
                own = found.setdefault((r["field"], r["term"]), {})
                for tier, n in r["tiers"]:
                    own[tier] = own.get(tier, 0) + n
        return found

    def resolve(self, patterns: list[tuple[str, Column, Filter | None]]) -> list[list[str] | None]:
        """For each (field, test of the term, what its pieces say) the terms that match, or None when there are more than
        ``RESOLVED_TERMS``.

        Patterns that the table of pieces can answer read its rows of their pieces; all others share one pass over the
        vocabulary. No task sends more than that many terms each."""
        if not patterns:
            return []
        most = RESOLVED_TERMS + 1
        if len(patterns) == 1:
            found = [[r["term"] for r in self.terms_matching(*patterns[0]).orderBy("term").limit(most).collect()]]
        else:
            listed = [i for i, (name, _, pieces) in enumerate(patterns) if self._has_pieces(name, pieces)]
            tests = [F.when((F.col("field") == p[0]) & p[1], F.lit(i)) for i, p in enumerate(patterns) if i not in listed]
            parts = [self.terms_matching(*patterns[i]).withColumn("i", F.lit(i)) for i in listed]
            if tests:
                rows = self.terms.filter(F.col("field").isin(sorted({p[0] for i, p in enumerate(patterns) if i not in listed})))
                parts.append(rows.select("term", F.explode(F.array_compact(F.array(*tests))).alias("i")))
            rank = F.row_number().over(Window.partitionBy("i").orderBy("term"))
            found = [[] for _ in patterns]
            for r in reduce(DataFrame.unionByName, parts).withColumn("rank", rank).filter(F.col("rank") <= most).collect():
                found[r["i"]].append(r["term"])
        return [terms if len(terms) < most else None for terms in found]

    def _has_pieces(self, field: str, pieces: Filter | None) -> bool:
        return pieces is not None and self.grams is not None and self.field(field).grams

    def terms_matching(self, field: str, matches: Column, pieces: Filter | None = None) -> DataFrame:
        """``term``: the terms of a field that pass a test. Where pieces are known, only their rows of the table of pieces
        are read, and terms that have enough of them are tested; it may name terms that no document has any more."""
        if not self._has_pieces(field, pieces):
            return self.terms.filter((F.col("field") == field) & matches).select("term")
        asked = pieces.pieces
        rows = self.grams.filter((F.col("field") == field) & F.col("gram").isin(asked))
        if self.term_buckets:
            rows = rows.filter(F.col("gram_bucket").isin([tables.bucket_of(F.lit(g), self.term_buckets) for g in asked]))
        have = rows.groupBy("term").agg(F.collect_set("gram").alias("have"))
        return have.filter(pieces.passes(F.col("have")) & matches).select("term")

    def first_terms(self, field: str, matches: Column, n: int) -> list[str]:
        """The first ``n`` matching terms in term order: one pass, at most ``n`` terms from any task."""
        return [r["term"] for r in self.terms_matching(field, matches).orderBy("term").limit(n).collect()]

    # -- reading -----------------------------------------------------------------------------

    def postings_of(self, pairs: Iterable[tuple[str, str]]) -> DataFrame:
        """Postings of literal terms: directory, row-group and page pruning all apply."""
        pairs = set(pairs)
        words = {t for _, t in pairs}
        return self.everything.filter(
            F.col("field").isin(*{f for f, _ in pairs}) & F.col("term").isin(*words) & self._in_buckets(words)
        )

    def docs_of(self, keys: DataFrame, how: str = "inner") -> DataFrame:
        """Documents joined to ``keys``; only the directories the keys hash to are opened."""
        key = self.mapping.key
        if not self.doc_buckets:
            return self.docs.join(keys, key, how)
        placed = keys.withColumn("doc_bucket", tables.bucket_of(F.col(key), self.doc_buckets))
        return self.docs.join(placed, ["doc_bucket", key], how).drop("doc_bucket")

    def values_between(self, field: str, lower: Column | None, upper: Column | None) -> DataFrame:
        """Key and value of the documents in the ranges between two literals; only the folders of these are opened."""
        rows = self.ranges[field]
        part = lambda value: tables.range_of(self.mapping, field, value, self.cuts.get(field, []))
        if lower is not None:
            rows = rows.filter(F.col("part") >= part(lower))
        if upper is not None:
            rows = rows.filter(F.col("part") <= part(upper))
        return rows.select(self.mapping.key, f"`{field}`")

    # -- query-time analysis -----------------------------------------------------------------

    def field(self, name: str) -> Field:
        if not self.mapping.has(name):
            raise QueryError(f"invalid field: unknown field: {name}")
        return self.mapping.field(name)

    def analyze(self, name: str, texts: list[str]) -> list[list[tuple[str, int]]]:
        """(term, position) lists of query texts, analysed as the field's documents were."""
        analyzer = self.field(name).analyzer
        mapped = analyzer in self.stem_maps
        found = analysis.analyze_literals(self.spark, texts, "default" if mapped else analyzer)
        words = {t for tokens in found for t, _ in tokens}
        if not mapped or not words:
            return found
        rows = self.stem_maps[analyzer].filter(F.col("term").isin(*words)).collect()
        stems = {r["term"]: r["stem"] for r in rows}
        return [[(stems.get(t, t), p) for t, p in tokens] for tokens in found]

    def surface_words(self, name: str, frequencies: Dict[str, int]) -> tuple[dict[str, int], str]:
        """The words to look for in a text of this field, by the frequency of their term, and the analyzer that finds them:
        for a field stemmed by a caller's map, all words that the map sends to one of the terms."""
        analyzer = self.field(name).analyzer
        if analyzer not in self.stem_maps or not frequencies:
            return dict(frequencies), analyzer
        terms = list(frequencies)
        rows = self.stem_maps[analyzer].filter(F.col("stem").isin(terms) | F.col("term").isin(terms)).collect()
        elsewhere = {r["term"] for r in rows}
        words = {t: df for t, df in frequencies.items() if t not in elsewhere}
        return words | {r["term"]: frequencies[r["stem"]] for r in rows if r["stem"] in frequencies}, "default"
