"""Query tree to ``DataFrame(key, score)``, at most one row per document.

However deeply a query nests, the plan has the same shape: one pruned scan of the postings for all its
words, one scan of the documents for all its typed conditions, one shuffle on the key that adds up every
leaf of the tree, and the tree itself as a column expression over those sums. A query on documents
alone, or on one word, has no shuffle.

Document frequencies are known before the plan is made, so two exact shortcuts are taken when words are
frequent enough to matter. If a required part of the query matches few documents, those keys gate every
other scan, and the frequent words' postings are never shuffled. If only the best k are wanted and the
frequent words cannot lift a document among them, they are looked up for the other words' documents alone.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.errors import QueryError
from quillspark.functions import scoring
from quillspark.functions.analysis import WORD, analyze_literals, has_tokens
from quillspark.functions.distance import within_distance
from quillspark.functions.values import typed_literal
from quillspark.mapping import PAIRED
from quillspark.plans import grams
from quillspark.plans import query as q
from quillspark.sources.index import Index

@dataclass
class Node:
    """A node of the compiled tree. ``evaluate`` gives, over the summed leaves, whether a document matches
    and its score; ``needs`` lists sets of leaves of which every hit has at least one."""

    evaluate: Callable[[], tuple[Column, Column]]
    needs: list[frozenset[int]] = field(default_factory=list)

# A set of keys is broadcast when document frequencies prove it is at most this long. A gate is worth a
# second look at its words when it can spare this many rows the shuffle.
BROADCAST_KEYS = 1_000_000
SPARED_ROWS = 5_000_000

_UNSUPPORTED_REGEX = re.compile(r"\(\?<?[=!]|\\[1-9]|\\k<")


@dataclass
class _Phrase:
    """``words`` are (field, term, offset) to be read, pairs of words among them; ``required`` those that every hit has."""

    words: list[tuple[str, str, int]]
    scored: list[str]
    required: list[tuple[str, str]]
    offsets: list[int]


@dataclass
class Compiled:
    """A compiled query: its hits, the most there can be if that is known, and the words worth
    highlighting, ``{field: {term: df}}``."""

    hits: DataFrame
    words: dict[str, dict[str, int]] = field(default_factory=dict)
    at_most: int | None = None
    # What a document must meet, when the documents alone can tell.
    condition: Column | None = None
    # Patterns over the terms of a field that are not listed in ``words``.
    patterns: list[tuple[str, Column]] = field(default_factory=list)

    def keys(self, key: str) -> DataFrame:
        """The keys of the hits, marked for broadcast only if they are known to be few."""
        keys = self.hits.select(key)
        return F.broadcast(keys) if self.at_most is not None and self.at_most <= BROADCAST_KEYS else keys


class Compiler:
    """``filter_only`` asks which documents match and not how well, so that string fields are tested in
    the documents themselves rather than in the postings."""

    def __init__(self, index: Index, highlight_expanded: bool = False, filter_only: bool = False):
        self.index = index
        self.filter_only = filter_only
        self.key = index.mapping.key
        self.highlight_expanded = highlight_expanded
        self.kinds: list[str] = []
        # leaf -> (field, term) -> weight, for words scored by BM25
        self.scored: dict[int, dict[tuple[str, str], float]] = {}
        self.constant: dict[int, set[tuple[str, str]]] = {}
        self.phrases: dict[int, tuple[str, _Phrase]] = {}
        # A phrase that is one pair of words: leaf -> (field, pair, words)
        self.pairs: dict[int, tuple[str, str, list[str]]] = {}
        # (leaf, offset, field, test of the term, whether the test is cheap enough for every posting, what its pieces say)
        self.patterns: list[tuple[int, int, str, Column, bool, grams.Filter | None]] = []
        self.pending: list[tuple[int, str, Column, bool, grams.Filter | None]] = []
        self.conditions: dict[int, Column] = {}
        self.documents_only = False
        # Conditions on a field whose values are kept by range: leaf -> (field, lower, upper)
        self.between: dict[int, tuple[str, Column | None, Column | None]] = {}
        # (field, term) -> the lowest tier of its postings that is read
        self.least: dict[tuple[str, str], int] = {}

    # -- leaves ------------------------------------------------------------------------------

    def _leaf(self, kind: str) -> int:
        self.kinds.append(kind)
        return len(self.kinds) - 1

    def _node(self, leaf: int) -> Node:
        def evaluate():
            if self.documents_only:
                # The condition itself, so that it reaches the scan.
                met = self.conditions.get(leaf, F.lit(False))
                return met, F.when(met, 1.0).otherwise(0.0)
            return F.col(f"v{leaf}").isNotNull(), F.coalesce(F.col(f"v{leaf}"), F.lit(0.0))

        return Node(evaluate, [frozenset([leaf])])

    def _nothing(self) -> Node:
        return Node(lambda: (F.lit(False), F.lit(0.0)))

    def _condition(self, predicate: Column, between: tuple[str, Column | None, Column | None] | None = None) -> Node:
        leaf = self._leaf("constant")
        self.conditions[leaf] = predicate
        if between is not None and between[0] in self.index.ranges:
            self.between[leaf] = between
        return self._node(leaf)

    def _in_documents(self, name: str) -> bool:
        f = self.index.field(name)
        return self.filter_only and f.type == "string" and f.in_docs

    def _terms_matching(
        self, name: str, test: Callable[[Column], Column], cheap: bool = True, pieces: grams.Filter | None = None
    ) -> Node:
        """Documents with any term that passes; one point, however many terms do."""
        if self._in_documents(name):
            return self._condition(test(self._column(name)))
        leaf = self._leaf("constant")
        self.pending.append((leaf, name, test(F.col("term")), cheap, pieces))
        return self._node(leaf)

    def _resolve(self) -> None:
        """The terms of all patterns of the query, by one job; where there are too many, the pattern stays one."""
        found = self.index.resolve([(name, matches, pieces) for _, name, matches, _, pieces in self.pending])
        for (leaf, name, matches, cheap, pieces), terms in zip(self.pending, found, strict=True):
            if terms is None:
                self.patterns.append((leaf, 0, name, matches, cheap, pieces))
            else:
                self.constant[leaf] = {(name, t) for t in terms}

    def _postings_field(self, name: str) -> bool:
        return self.index.field(name).in_postings

    def _column(self, name: str) -> Column:
        f = self.index.field(name)
        if not f.indexed and f.type not in ("text", "json", "facet"):
            raise QueryError(f"field is not indexed: {name}")
        return F.col(f"`{name}`")

    # -- words -------------------------------------------------------------------------------

    def _match_parts(self, match: q.Match) -> tuple[dict[tuple[str, str], float], list[tuple[str, list[tuple[str, int]]]]]:
        """Single-token words with their multiplicity, and words that became phrases."""
        words: dict[tuple[str, str], float] = defaultdict(float)
        phrases = []
        chunks = match.text.split()
        for name in match.fields or self.index.mapping.default_fields:
            if not self._postings_field(name):
                raise QueryError(f"invalid field: {name} is not a text or string field")
            for tokens in self.index.analyze(name, chunks):
                if len(tokens) == 1:
                    words[(name, tokens[0][0])] += 1.0
                elif tokens:
                    phrases.append((name, tokens))
        return words, phrases

    def _pure_words(self, query: q.Query) -> dict[tuple[str, str], float] | None:
        """The weighted words of a query that is nothing but an OR of scored words, else None."""
        if isinstance(query, q.Match):
            words, phrases = self._match_parts(query)
            return None if phrases or any(self._in_documents(f) for f, _ in words) else dict(words)
        if isinstance(query, q.Term) and self._postings_field(query.field) and not self._in_documents(query.field):
            return {(query.field, str(query.value)): 1.0}
        if isinstance(query, q.Boost):
            inner = self._pure_words(query.query)
            return None if inner is None else {k: w * query.factor for k, w in inner.items()}
        if isinstance(query, q.Bool) and query.clauses and all(occur == "should" for occur, _ in query.clauses):
            total: dict[tuple[str, str], float] = defaultdict(float)
            for _, part in query.clauses:
                inner = self._pure_words(part)
                if inner is None:
                    return None
                for k, w in inner.items():
                    total[k] += w
            return dict(total)
        return None

    def _words(self, words: dict[tuple[str, str], float]) -> Node:
        if not words:
            return self._nothing()
        leaf = self._leaf("sum")
        self.scored[leaf] = words
        return self._node(leaf)

    def _phrase_parts(self, name: str, words: list[tuple[str, int]]) -> list[tuple[str, str, int]]:
        """(field, term, offset) that together make a phrase: of frequent words the pairs that are kept, in steps of two
        words, all others by themselves."""
        often = self.index.paired.get(name, frozenset())
        joined = [
            i for i, ((a, at), (b, after)) in enumerate(zip(words, words[1:])) if after == at + 1 and a in often and b in often
        ]
        parts, covered = [], set()
        for i in joined:
            last = i + 1 not in joined
            if i not in covered or (last and i + 1 not in covered):
                parts.append((name + PAIRED, f"{words[i][0]} {words[i + 1][0]}", words[i][1]))
                covered |= {i, i + 1}
        return parts + [(name, w, at) for i, (w, at) in enumerate(words) if i not in covered]

    def _phrase(self, name: str, words: list[tuple[str, int]]) -> Node:
        parts, scored = self._phrase_parts(name, words), [w for w, _ in words]
        if len(parts) == 1 and len(words) == 2:
            # Its postings are those of a word.
            leaf = self._leaf("sum")
            self.pairs[leaf] = (name, parts[0][1], scored)
            return self._node(leaf)
        leaf = self._leaf("phrase")
        self.phrases[leaf] = (name, _Phrase(parts, scored, [p[:2] for p in parts], sorted({at for *_, at in parts})))
        return self._node(leaf)

    def _phrase_prefix(self, query: q.PhrasePrefix) -> Node:
        *fixed, last = [w.lower() for w in query.words]
        starts = F.col("term").startswith(last)
        if not fixed:
            return self._terms_matching(query.field, lambda t: t.startswith(last))
        leaf = self._leaf("phrase")
        words = self._phrase_parts(query.field, [(w, i) for i, w in enumerate(fixed)])
        required, at = [p[:2] for p in words], len(fixed)
        if query.max_expansions is None:
            self.patterns.append((leaf, at, query.field, starts, True, None))
        else:
            words += [(query.field, t, at) for t in self.index.first_terms(query.field, starts, query.max_expansions)]
        offsets = sorted({i for *_, i in words} | {at})
        self.phrases[leaf] = (query.field, _Phrase(words, fixed, required, offsets))
        return self._node(leaf)

    # -- the tree ----------------------------------------------------------------------------

    def add(self, query: q.Query) -> Node:
        words = self._pure_words(query)
        if words is not None:
            return self._words(words)
        match query:
            case q.Match():
                words, phrases = self._match_parts(query)
                nodes = [self._words({p: w for p, w in words.items() if not self._in_documents(p[0])})]
                nodes += [self._phrase(n, tokens) for n, tokens in phrases]
                nodes += [self._condition(F.col(f"`{f}`") == t) for f, t in words if self._in_documents(f)]
                return self._combine([("should", n) for n in nodes])
            case q.QuotedPhrase():
                nodes = []
                for name in query.fields or self.index.mapping.default_fields:
                    tokens = self.index.analyze(name, [query.text])[0]
                    if len(tokens) == 1:
                        nodes.append(self._words({(name, tokens[0][0]): 1.0}))
                    elif tokens:
                        nodes.append(self._phrase(name, tokens))
                return self._combine([("should", n) for n in nodes])
            case q.Phrase():
                self.index.field(query.field)
                lowered = [w.lower() for w in query.words]
                if len(lowered) == 1:
                    return self._words({(query.field, lowered[0]): 1.0})
                return self._phrase(query.field, [(w, i) for i, w in enumerate(lowered)])
            case q.PhrasePrefix():
                self.index.field(query.field)
                return self._phrase_prefix(query)
            case q.All():
                return self._condition(F.lit(True))
            case q.Term():
                column, kind = self._column(query.field), self.index.field(query.field).type
                value = F.lit(str(query.value)) if self._in_documents(query.field) else typed_literal(kind, query.value)
                return self._condition(column == value, (query.field, value, value))
            case q.Range():
                return self._range(query)
            case q.Regex():
                self._check_regex(query.pattern)
                self.index.field(query.field)
                whole = lambda t: t.rlike(rf"\A(?:{query.pattern})\z")
                return self._terms_matching(query.field, whole, cheap=False, pieces=grams.for_regex(query.pattern))
            case q.Prefix():
                self.index.field(query.field)
                return self._terms_matching(query.field, lambda t: t.startswith(query.prefix))
            case q.Fuzzy():
                self.index.field(query.field)
                value = query.value.lower()
                near = lambda t: within_distance(t, value, query.distance, query.transpose_costs_one)
                pieces = grams.for_fuzzy(value, query.distance, query.transpose_costs_one)
                return self._terms_matching(query.field, near, cheap=False, pieces=pieces)
            case q.Exists():
                return self._exists(query.field)
            case q.JsonPath():
                return self._condition(self._json(query))
            case q.Facet():
                path = query.path.rstrip("/")
                column = self._column(query.field)
                return self._condition((column == path) | column.startswith(path + "/"))
            case q.Boost():
                inner, factor = self.add(query.query), query.factor

                def boosted():
                    matched, score = inner.evaluate()
                    return matched, score * factor

                return Node(boosted, inner.needs)
            case q.Bool():
                return self._combine([(occur, self.add(part)) for occur, part in query.clauses])
        raise QueryError(f"not a query: {query!r}")

    def _combine(self, clauses: list[tuple[str, Node]]) -> Node:
        if not any(occur != "must_not" for occur, _ in clauses):
            return self._nothing()

        def evaluate():
            parts = {o: [n.evaluate() for occur, n in clauses if occur == o] for o in q.OCCURS}
            needed = [m for m, _ in parts["must"]]
            if not needed:
                needed = [reduce(lambda a, b: a | b, [m for m, _ in parts["should"]])]
            needed += [~F.coalesce(m, F.lit(False)) for m, _ in parts["must_not"]]
            scores = [F.when(m, s).otherwise(0.0) for m, s in parts["must"] + parts["should"]]
            return reduce(lambda a, b: a & b, needed), reduce(lambda a, b: a + b, scores)

        must = [n for occur, n in clauses if occur == "must"]
        if must:
            needs = [leaves for n in must for leaves in n.needs]
        else:
            # A hit satisfies one of the alternatives, so it has a leaf of what each of them needs.
            either = [n.needs for occur, n in clauses if occur == "should"]
            needs = [frozenset().union(*[min(n, key=len) for n in either])] if all(either) else []
        return Node(evaluate, needs)

    def _range(self, query: q.Range) -> Node:
        f = self.index.field(query.field)
        value = (lambda v: F.lit(str(v))) if f.in_postings else (lambda v: typed_literal(f.type, v))

        def inside(column: Column) -> Column:
            tests = [column.isNotNull()]
            if query.lower is not None:
                low = value(query.lower)
                tests.append(column >= low if query.include_lower else column > low)
            if query.upper is not None:
                high = value(query.upper)
                tests.append(column <= high if query.include_upper else column < high)
            return reduce(lambda a, b: a & b, tests)

        if f.in_postings:
            return self._terms_matching(query.field, inside)
        low, high = (None if v is None else value(v) for v in (query.lower, query.upper))
        return self._condition(inside(self._column(query.field)), (query.field, low, high))

    def _exists(self, name: str) -> Node:
        f = self.index.field(name)
        if not f.in_postings or (f.type == "string" and f.in_docs):
            return self._condition(F.col(f"`{name}`").isNotNull())
        if f.in_docs:
            return self._condition(has_tokens(F.col(f"`{name}`"), f.analyzer))
        leaf = self._leaf("constant")
        self.patterns.append((leaf, 0, name, F.lit(True), True, None))
        return self._node(leaf)

    def _json(self, query: q.JsonPath) -> Column:
        if self.index.field(query.field).type != "json":
            raise QueryError(f"not a json field: {query.field}")
        column, path, value = F.col(f"`{query.field}`"), f"$.{query.path}", query.value
        if isinstance(value, bool):
            return F.try_variant_get(column, path, "boolean") == value
        if isinstance(value, int):
            return F.try_variant_get(column, path, "bigint") == value
        if isinstance(value, float):
            return F.try_variant_get(column, path, "double") == value
        # Text inside json is analysed, so a value matches where its words stand side by side.
        tokens = [t for t, _ in analyze_literals(self.index.spark, [str(value)], "default")[0]]
        words = F.regexp_extract_all(F.lower(F.try_variant_get(column, path, "string")), F.lit(WORD), F.lit(0))
        spaced = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
        return spaced.contains(" " + " ".join(tokens) + " ") if tokens else F.lit(False)

    def _check_regex(self, pattern: str) -> None:
        if _UNSUPPORTED_REGEX.search(pattern):
            raise QueryError(f"invalid regex: look-around and back-references are not supported: {pattern}")
        try:
            self.index.spark.sql("SELECT t RLIKE :p FROM VALUES ('') AS q(t)", args={"p": rf"\A(?:{pattern})\z"}).collect()
        except PySparkException as error:
            raise QueryError(f"invalid regex: {pattern}") from error

    # -- rows --------------------------------------------------------------------------------

    def _literal_words(self) -> list[tuple[str, str, int, int, float, float]]:
        """(field, term, leaf, offset, weight, avgdl) of every word of the query that occurs at all."""
        pairs = {p for words in self.scored.values() for p in words}
        for name, ph in self.phrases.values():
            pairs |= {(f, t) for f, t, _ in ph.words} | {(name, w) for w in ph.scored}
        for name, pair, words in self.pairs.values():
            pairs |= {(name + PAIRED, pair)} | {(name, w) for w in words}
        self.df = self.index.doc_frequencies(pairs)
        n = self.index.n_docs
        gain = {p: scoring.idf(df, n) for p, df in self.df.items()}
        rows = []
        for leaf, words in self.scored.items():
            rows += [(f, t, leaf, 0, w * gain[f, t], self.index.avgdl(f)) for (f, t), w in words.items() if (f, t) in gain]
        for leaf, found in self.constant.items():
            rows += [(f, t, leaf, 0, 1.0, 1.0) for f, t in found]
        for leaf, (name, ph) in self.phrases.items():
            if all(p in gain for p in [(name, w) for w in ph.scored] + ph.required):
                weight = sum(gain[name, w] for w in ph.scored)
                rows += [(f, t, leaf, at, weight, self.index.avgdl(name)) for f, t, at in ph.words if (f, t) in gain]
        for leaf, (name, pair, words) in self.pairs.items():
            if (name + PAIRED, pair) in gain and all((name, w) in gain for w in words):
                weight = sum(gain[name, w] for w in words)
                rows.append((name + PAIRED, pair, leaf, 0, weight, self.index.avgdl(name)))
        return rows

    def _weighted(self, literal: list[tuple[str, str, int, int, float, float]]) -> DataFrame:
        """The postings of the query's words, each with its leaf, offset, weight and average length."""
        rows = self.index.postings_of((r[0], r[1]) for r in literal)
        if len(literal) == 1 and self.least.get(literal[0][:2], 0) > 0:
            rows = rows.filter(F.col("tier") >= self.least[literal[0][:2]])
        names = ["leaf", "at", "weight", "avgdl"]
        if len(literal) == 1:
            return rows.withColumns({n: F.lit(v) for n, v in zip(names, literal[0][2:])})
        # A local relation of the query's own words: Spark knows its size and broadcasts it.
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.float64()]
        table = pa.table({c: pa.array(v, k) for c, v, k in zip(["field", "term", *names], zip(*literal), kinds)})
        return rows.join(self.index.spark.createDataFrame(table), ["field", "term"])

    def _matching_postings(self, name: str, matches: Column, cheap: bool, pieces: grams.Filter | None) -> DataFrame:
        """The postings of a pattern. A dear one is tested on the vocabulary, whose matches are sent along if they are known
        to be few enough; a cheap one, or one with more matches than that, on the postings themselves."""
        rows = self.index.postings.filter(F.col("field") == name)
        if not cheap:
            terms = self.index.terms_matching(name, matches, pieces)
            if terms.count() <= BROADCAST_KEYS:
                return rows.join(F.broadcast(terms), "term", "left_semi")
        return rows.filter(matches)

    def _posting_rows(self, literal: list[tuple[str, str, int, int, float, float]], gate: DataFrame | None) -> DataFrame | None:
        found = [self._weighted(literal)] if literal else []
        for leaf, at, name, matches, cheap, pieces in self.patterns:
            weight = 1.0
            if leaf in self.phrases:
                weight = sum(scoring.idf(self.df[name, w], self.index.n_docs) for w in self.phrases[leaf][1].scored if (name, w) in self.df)
            rows = self._matching_postings(name, matches, cheap, pieces)
            found.append(
                rows.withColumns(
                    {"leaf": F.lit(leaf), "at": F.lit(at), "weight": F.lit(weight), "avgdl": F.lit(self.index.avgdl(name))}
                )
            )
        if not found:
            return None
        sums = [leaf for leaf, kind in enumerate(self.kinds) if kind == "sum"]
        value = F.col("weight") * scoring.tf_norm(F.col("tf"), F.col("dl"), F.col("avgdl"))
        if len(sums) < len(self.kinds):
            value = F.when(F.col("leaf").isin(sums), value).otherwise(F.lit(1.0)) if sums else F.lit(1.0)
        columns = [F.col(self.key), F.col("leaf"), value.alias("value")]
        if self.phrases:
            shifted = F.transform("positions", lambda p: p - F.col("at"))
            place = F.struct("at", shifted.alias("starts"), "weight", "dl", "avgdl")
            columns.append(F.when(F.col("leaf").isin(list(self.phrases)), place).alias("place"))
        if gate is not None:
            found = [rows.join(gate, self.key, "left_semi") for rows in found]
        return reduce(DataFrame.unionByName, [rows.select(*columns) for rows in found])

    def _condition_rows(self, gate: DataFrame | None) -> DataFrame:
        """One row per document and condition it meets."""
        leaves = list(self.conditions)
        docs = self.index.docs.filter(reduce(lambda a, b: a | b, self.conditions.values()))
        if gate is not None:
            docs = docs.join(gate, self.key, "left_semi")
        if len(leaves) == 1:
            rows = docs.select(self.key, F.lit(leaves[0]).alias("leaf"))
        else:
            met = F.array_compact(F.array(*[F.when(c, F.lit(leaf)) for leaf, c in self.conditions.items()]))
            rows = docs.select(self.key, F.explode(met).alias("leaf"))
        return rows.withColumn("value", F.lit(1.0))

    # -- bounds ------------------------------------------------------------------------------

    def _leaf_words(self, leaf: int) -> list[tuple[str, str]] | None:
        """Words of which every document of a leaf has one; None if the leaf is not about listed words."""
        if leaf in self.scored:
            return list(self.scored[leaf])
        if leaf in self.constant:
            return list(self.constant[leaf])
        if leaf in self.phrases:
            return [min(self.phrases[leaf][1].required, key=lambda p: self.df.get(p, 0))]
        if leaf in self.pairs:
            return [(self.pairs[leaf][0] + PAIRED, self.pairs[leaf][1])]
        return None

    def _needed_words(self, leaves: frozenset[int]) -> list[tuple[str, str]] | None:
        words = [self._leaf_words(leaf) for leaf in leaves]
        return None if any(w is None for w in words) else [p for w in words for p in w]

    def _fewest(self, node: Node) -> tuple[list[tuple[str, str]] | None, int | None]:
        """The required words that fewest documents have, and at most how many documents that is."""
        choices = [w for w in (self._needed_words(leaves) for leaves in node.needs) if w is not None]
        if not choices:
            return None, None
        unknown = {p for words in choices for p in words} - set(self.df)
        self.df |= self.index.doc_frequencies(unknown)
        sized = [(sum(self.df.get(p, 0) for p in words), i) for i, words in enumerate(choices)]
        size, best = min(sized)
        return choices[best], size

    def _keys_of(self, words: list[tuple[str, str]], size: int) -> DataFrame:
        """The documents with any of these words; ``size`` is their proven bound."""
        keys = self.index.postings_of(words).join(self._pairs(words), ["field", "term"], "left_semi").select(self.key).distinct()
        return F.broadcast(keys) if size <= BROADCAST_KEYS else keys

    def _pairs(self, words: list[tuple[str, str]]) -> DataFrame:
        columns = list(zip(*words))
        return self.index.spark.createDataFrame(pa.table({"field": pa.array(columns[0], pa.string()), "term": pa.array(columns[1], pa.string())}))

    def _gate(self, node: Node, literal: list) -> tuple[DataFrame | None, int | None]:
        """Keys that every hit is among, when that spares the shuffle many rows."""
        words, size = self._fewest(node)
        if words is None or not words:
            return None, size
        rows = sum(self.df.get((r[0], r[1]), 0) for r in literal)
        rows += self.index.n_docs * (len(self.conditions) + len(self.patterns))
        if size > BROADCAST_KEYS or rows - size < SPARED_ROWS:
            return None, size
        return self._keys_of(words, size), size

    def _least_tiers(self, literal: list, k: int) -> dict[tuple[str, str], int]:
        """For words whose postings have tiers, the lowest tier in at least one of which each of the best ``k`` hits has a
        word; all words of a query that is an OR of words are in ``literal``.

        Some word alone has ``k`` documents in its upper tiers, which gives the k-th best score a lower bound. Tiers are
        left out, the fullest first, while what a document could have from left out tiers alone stays below it."""
        counts = self.index.tier_counts((r[0], r[1]) for r in literal)
        if not counts or any(r[4] < 0 for r in literal):
            return {}

        def bound(row, tier: int, lower: bool) -> float:
            field_ = row[0].removesuffix(PAIRED)
            return row[4] * scoring.tier_bound(tier, self.index.lengths[field_], row[5], lower)

        worst = 0.0
        for row in literal:
            seen = 0
            for tier, n in sorted(counts.get(row[:2], {}).items(), reverse=True):
                seen += n
                if seen >= k:
                    worst = max(worst, bound(row, tier, True))
                    break
        least = {row[:2]: 0 for row in literal}
        by_word = {row[:2]: row for row in literal if row[:2] in counts}
        margin = 2 * 10.0**-scoring.SCORE_DIGITS

        def ceiling(word, tier: int) -> float:
            return sum(bound(by_word[w], tier if w == word else t, False) for w, t in least.items() if w in by_word)

        while True:
            raised = [w for w in by_word if least[w] < scoring.TIERS and ceiling(w, least[w] + 1) + margin < worst]
            if not raised:
                return {w: t for w, t in least.items() if t}
            fullest = max(raised, key=lambda w: (counts[w].get(least[w], 0), w))
            least[fullest] += 1

    def _tier_gate(self, literal: list, k: int) -> tuple[DataFrame | None, int | None]:
        """The documents that have a word in one of the tiers that the best ``k`` hits need, or None."""
        if self.index.tiers is None or len({r[:2] for r in literal}) < len(literal):
            return None, None
        least = self._least_tiers(literal, k)
        counts = self.index.tier_counts(least)
        size = sum(
            sum(n for tier, n in counts[r[:2]].items() if tier >= least[r[:2]]) if r[:2] in least else self.df[r[:2]] for r in literal
        )
        if not least or size > BROADCAST_KEYS or sum(self.df[r[:2]] for r in literal) - size < SPARED_ROWS:
            return None, None
        words = [(*r[:2], least.get(r[:2], -1)) for r in literal]
        columns = zip(("field", "term", "from_tier"), zip(*words), (pa.string(), pa.string(), pa.int32()))
        asked = self.index.spark.createDataFrame(pa.table({c: pa.array(v, kind) for c, v, kind in columns}))
        rows = self.index.postings_of((f, t) for f, t, _ in words).join(F.broadcast(asked), ["field", "term"])
        found = rows.filter(F.coalesce(F.col("tier"), F.lit(0)) >= F.col("from_tier")).select(self.key).distinct()
        return F.broadcast(found), size

    def _best_gate(self, literal: list, k: int) -> tuple[DataFrame | None, int | None]:
        """Keys that the best ``k`` hits of an OR of words are among, or None.

        The rarest words give the k-th best score a lower bound; the commonest words whose highest
        possible scores together stay below it are optional, and the others hold the best hits.
        """
        gate, size = self._tier_gate(literal, k)
        if gate is not None:
            return gate, size
        ordered = sorted(literal, key=lambda r: (self.df[r[0], r[1]], r[0], r[1]))
        reached, seeds = 0, []
        while ordered[len(seeds) :] and reached < 2 * k:
            seeds.append(ordered[len(seeds)])
            reached += self.df[seeds[-1][0], seeds[-1][1]]
        spare = sum(self.df[r[0], r[1]] for r in ordered[len(seeds) :])
        if spare < SPARED_ROWS or reached > BROADCAST_KEYS or any(r[4] < 0 for r in literal):
            return None, None
        gain = F.sum(F.col("weight") * scoring.tf_norm(F.col("tf"), F.col("dl"), F.col("avgdl")))
        best = self._weighted(seeds).groupBy(self.key).agg(gain.alias("s")).orderBy(F.desc("s")).limit(k)
        found = best.agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("worst")).first()
        if found["n"] < k:
            return None, None
        bound, ceiling, needed = found["worst"], 0.0, list(ordered)
        while needed and ceiling + needed[-1][4] * (scoring.K1 + 1.0) + 2 * 10.0**-scoring.SCORE_DIGITS < bound:
            ceiling += needed.pop()[4] * (scoring.K1 + 1.0)
        size = sum(self.df[r[0], r[1]] for r in needed)
        if len(needed) == len(ordered) or sum(self.df[r[0], r[1]] for r in ordered[len(needed) :]) < SPARED_ROWS:
            return None, None
        return self._keys_of([(r[0], r[1]) for r in needed], size), size

    def _leaf_sum(self, leaf: int) -> Column:
        mine = F.col("leaf") == leaf
        if self.kinds[leaf] == "sum":
            return F.sum(F.when(mine, F.col("value"))).alias(f"v{leaf}")
        if self.kinds[leaf] == "constant":
            return F.max(F.when(mine, F.lit(1.0))).alias(f"v{leaf}")
        return F.collect_list(F.when(mine, F.col("place"))).alias(f"p{leaf}")

    def _phrase_score(self, leaf: int) -> Column:
        """Starts common to all offsets are occurrences of the phrase."""
        places = F.col(f"p{leaf}")

        def starts(at: int) -> Column:
            return F.flatten(F.transform(F.filter(places, lambda e: e["at"] == at), lambda e: e["starts"]))

        common = reduce(F.array_intersect, [starts(at) for at in self.phrases[leaf][1].offsets])
        first = F.get(places, F.lit(0))
        score = first["weight"] * scoring.tf_norm(F.size(common), first["dl"], first["avgdl"])
        return F.when(F.size(common) > 0, score).alias(f"v{leaf}")

    # -- the whole ---------------------------------------------------------------------------

    def compile(self, query: q.Query, best: int | None = None) -> Compiled:
        """``best`` says that only so many best hits are wanted, so that others may be left out."""
        node = self.add(query)
        self._resolve()
        literal = self._literal_words()
        self.documents_only = not literal and not self.patterns
        matched, score = node.evaluate()
        at_most = None
        if self.documents_only and len(self.conditions) == len(self.between) == 1:
            hits = self.index.values_between(*next(iter(self.between.values()))).filter(matched)
        elif self.documents_only:
            hits = self.index.docs.filter(matched)
        elif self._one_word():
            at_most = sum(self.df.get((r[0], r[1]), self.index.n_docs) for r in literal)
            self.least = self._least_tiers(literal, best) if best and self.kinds == ["sum"] else {}
            hits = self._posting_rows(literal, None).select(self.key, F.col("value").alias("v0")).filter(matched)
        else:
            if best and self.kinds == ["sum"]:
                gate, at_most = self._best_gate(literal, best)
            else:
                gate, at_most = self._gate(node, literal)
            rows = self._posting_rows(literal, gate)
            if self.conditions:
                rows = rows.unionByName(self._condition_rows(gate), allowMissingColumns=True)
            sums = rows.groupBy(self.key).agg(*[self._leaf_sum(leaf) for leaf in range(len(self.kinds))])
            if self.phrases:
                plain = [F.col(f"v{leaf}") for leaf in range(len(self.kinds)) if leaf not in self.phrases]
                sums = sums.select(self.key, *plain, *[self._phrase_score(leaf) for leaf in self.phrases])
            hits = sums.filter(matched)
        condition = matched if self.documents_only else None
        patterns = [(name, test) for leaf, _, name, test, *_ in self.patterns if leaf not in self.phrases]
        return Compiled(hits.select(self.key, score.alias("score")), self._highlight_words(), at_most, condition, patterns)

    def _one_word(self) -> bool:
        """One term means one row per document already."""
        if len(self.kinds) != 1 or self.patterns or self.conditions or self.phrases:
            return False
        return len(self.pairs) + sum(map(len, self.scored.values())) + sum(map(len, self.constant.values())) == 1

    def _highlight_words(self) -> dict[str, dict[str, int]]:
        found: dict[str, dict[str, int]] = defaultdict(dict)
        for words in self.scored.values():
            for f, t in words:
                if (f, t) in self.df:
                    found[f][t] = self.df[f, t]
        for name, ph in self.phrases.values():
            for w in ph.scored:
                if (name, w) in self.df:
                    found[name][w] = self.df[name, w]
        for name, _, words in self.pairs.values():
            found[name] |= {w: self.df[name, w] for w in words if (name, w) in self.df}
        if self.highlight_expanded:
            expanded = {p for terms in self.constant.values() for p in terms}
            for (f, t), df in self.index.doc_frequencies(expanded).items():
                found[f][t] = df
        return dict(found)


def compile_query(
    query: q.Query, index: Index, highlight_expanded: bool = False, best: int | None = None, filter_only: bool = False
) -> Compiled:
    return Compiler(index, highlight_expanded, filter_only).compile(query, best)


def matches(query: q.Query, index: Index) -> DataFrame:
    """``(key, score)`` of every document the query matches, unordered and unlimited."""
    return compile_query(query, index).hits
