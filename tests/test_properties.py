"""Random queries over a small corpus against a direct evaluation in Python."""

from __future__ import annotations

import math
import random
import re

import duckdb
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.functions.distance import within_distance
from quillspark.functions.stemming import stem_english
from quillspark.mapping import Mapping
from quillspark.operators.aggs import aggregate, histogram, scope
from quillspark.operators import batch as batch_module
from quillspark.operators.batch import batch_search
from quillspark.operators.search import count_hits, top_k
from quillspark.plans import compile as compile_module
from quillspark.plans import query as q
from registry import sql
from quillspark.plans.compile import matches
from quillspark.sources.index import Index

WORDS = ["aa", "ab", "ba", "abc", "bcd", "cab", "dad", "rare"]
MAPPING = Mapping.build(
    [("text", "text", {"stored": True}), ("tag", "string", {"stored": True, "fast": True}), ("n", "i64", {"fast": True})]
)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def corpus():
    rng = random.Random(7)
    weights = [20, 10, 6, 5, 4, 3, 2, 1]
    rows = []
    for i in range(60):
        words = rng.choices(WORDS, weights, k=rng.randint(0, 14))
        rows.append((i, rng.choice([" ", ", ", "-"]).join(words), rng.choice(["x", "y", None]), rng.choice([None, 1, 5, 9])))
    return rows


ROWS = corpus()
TOKENS = {i: re.findall(r"[a-z]+", text) for i, text, _, _ in ROWS}


@pytest.fixture(scope="module")
def index(spark):
    return Index.in_memory(spark.createDataFrame(ROWS, "doc_id bigint, text string, tag string, n bigint"), MAPPING)


# -- direct evaluation -----------------------------------------------------------------------

N = len(ROWS)
AVGDL = sum(len(t) for t in TOKENS.values()) / N
DF = {w: sum(w in t for t in TOKENS.values()) for w in WORDS}


def bm25(idf, tf, dl, avgdl=AVGDL):
    return idf * 2.2 * tf / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))


def idf(df):
    return math.log(1 + (N - df + 0.5) / (df + 0.5))


def osa(a, b):
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def evaluate(asked, row):
    """Score of a row, or None when it does not match."""
    i, _, tag, n = row
    tokens = TOKENS[i]
    match asked:
        case q.Match():
            found = [bm25(idf(DF[w]), tokens.count(w), len(tokens)) for w in asked.text.split() if w in tokens]
            return sum(found) if found else None
        case q.Term():
            tagged = sum(r[2] is not None for r in ROWS) / N  # a value is one token; some rows have none
            return bm25(idf(sum(r[2] == asked.value for r in ROWS)), 1, 1, tagged) if tag == asked.value else None
        case q.Phrase():
            k = len(asked.words)
            tf = sum(tuple(tokens[p : p + k]) == asked.words for p in range(len(tokens)))
            return bm25(sum(idf(DF[w]) for w in asked.words), tf, len(tokens)) if tf else None
        case q.Range():
            return 1.0 if n is not None and asked.lower <= n <= asked.upper else None
        case q.Prefix():
            return 1.0 if any(t.startswith(asked.prefix) for t in tokens) else None
        case q.Fuzzy():
            return 1.0 if any(osa(t, asked.value) <= asked.distance for t in tokens) else None
        case q.All():
            return 1.0
        case q.Boost():
            inner = evaluate(asked.query, row)
            return None if inner is None else inner * asked.factor
        case q.Bool():
            parts = {o: [evaluate(p, row) for occur, p in asked.clauses if occur == o] for o in q.OCCURS}
            if any(s is not None for s in parts["must_not"]) or any(s is None for s in parts["must"]):
                return None
            scores = [s for s in parts["must"] + parts["should"] if s is not None]
            return sum(scores) if scores else None


def expected(asked):
    scored = {row[0]: evaluate(asked, row) for row in ROWS}
    return {i: s for i, s in scored.items() if s is not None}


LEAVES = st.one_of(
    st.lists(st.sampled_from(WORDS), min_size=1, max_size=3).map(lambda ws: q.match(" ".join(ws), "text")),
    st.lists(st.sampled_from(WORDS), min_size=2, max_size=3).map(lambda ws: q.phrase("text", *ws)),
    st.sampled_from(["x", "y"]).map(lambda v: q.Term("tag", v)),
    st.tuples(st.integers(0, 6), st.integers(0, 5)).map(lambda t: q.Range("n", t[0], t[0] + t[1])),
    st.sampled_from(["a", "ab", "c", "zz"]).map(lambda p: q.Prefix("text", p)),
    st.tuples(st.sampled_from(["abd", "cba", "da"]), st.integers(0, 2)).map(lambda t: q.Fuzzy("text", t[0], t[1])),
    st.just(q.All()),
)
QUERIES = st.recursive(
    LEAVES,
    lambda inner: st.one_of(
        st.lists(st.tuples(st.sampled_from(q.OCCURS), inner), min_size=1, max_size=3).map(lambda c: q.Bool(tuple(c))),
        st.tuples(inner, st.sampled_from([0.5, 2.0])).map(lambda t: q.Boost(*t)),
    ),
    max_leaves=6,
)


def check(index, asked):
    got = {r["doc_id"]: r["score"] for r in matches(asked, index).collect()}
    want = expected(asked)
    assert got.keys() == want.keys()
    assert all(got[i] == pytest.approx(want[i], abs=1e-9) for i in want)


@SETTINGS
@given(asked=QUERIES)
def test_any_query_equals_its_direct_evaluation(index, asked):
    check(index, asked)


@SETTINGS
@given(asked=QUERIES)
def test_gates_change_nothing(index, asked):
    compile_module.SPARED_ROWS, kept = 1, compile_module.SPARED_ROWS
    try:
        check(index, asked)
    finally:
        compile_module.SPARED_ROWS = kept


@SETTINGS
@given(asked=QUERIES)
def test_a_scope_holds_the_hits(index, asked):
    assert {r["doc_id"] for r in scope(index, asked).select("doc_id").collect()} == set(expected(asked))


@SETTINGS
@given(words=st.lists(st.sampled_from(WORDS), min_size=2, max_size=5), k=st.integers(1, 8))
def test_best_hits_with_optional_words_are_the_best_hits(index, words, k):
    asked = q.match(" ".join(words), "text")
    compile_module.SPARED_ROWS, kept = 1, compile_module.SPARED_ROWS
    try:
        got = [tuple(r) for r in top_k(index, asked, k).collect()]
    finally:
        compile_module.SPARED_ROWS = kept
    best = sorted(((-round(s, 6), i) for i, s in expected(asked).items()))[:k]
    assert [i for i, _ in got] == [i for _, i in best]
    assert [s for _, s in got] == pytest.approx([-s for s, _ in best])


def test_a_gate_spares_frequent_words_the_shuffle(index, monkeypatch):
    monkeypatch.setattr(compile_module, "SPARED_ROWS", 1)
    asked = q.all_of(q.match("aa", "text"), q.match("rare", "text"))
    plan = matches(asked, index)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "broadcast" in plan
    frequent = top_k(index, q.match("aa rare rare rare rare", "text"), 1)
    assert "LeftSemi" in frequent._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("many", [0, 10**9])
def test_batch_search_equals_one_by_one(spark, index, many, monkeypatch):
    monkeypatch.setattr(batch_module, "MANY_POSTINGS", many)
    texts = ["aa", "aa rare", "ab abc bcd", "aa ab ba abc bcd cab dad rare", "rare rare dad", "none", ""]
    table = spark.createDataFrame(list(enumerate(texts)), "query_id int, text string")
    got = {}
    for r in batch_search(index, table, 5, fields=("text",)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    for i, text in enumerate(texts):
        page = top_k(index, q.match(text, "text"), 5).collect() if text else []
        assert sorted(got.get(i, [])) == [(n + 1, r["doc_id"], r["score"]) for n, r in enumerate(page)]


def test_pages_join_up(index):
    whole = [tuple(r) for r in top_k(index, "aa ab x", 30).collect()]
    parts = [tuple(r) for o in range(0, 30, 7) for r in top_k(index, "aa ab x", min(7, 30 - o), o).collect()]
    assert parts == whole


def test_phrases_are_among_all_words_and_distance_zero_is_the_term(index):
    both = {r["doc_id"] for r in matches(q.all_of(q.match("aa", "text"), q.match("ab", "text")), index).collect()}
    assert {r["doc_id"] for r in matches(q.phrase("text", "aa", "ab"), index).collect()} <= both
    zero = {r["doc_id"] for r in matches(q.Fuzzy("text", "abc", 0), index).collect()}
    assert zero == {r["doc_id"] for r in matches(q.Term("text", "abc"), index).collect()}


def test_histogram_counts_sum_to_the_scope(index):
    asked = q.match("aa", "text")
    buckets = aggregate(index, {"n": histogram("n", 2.0)}, query=asked)["n"]
    total = buckets.agg(F.sum("doc_count").alias("s")).first()["s"]
    assert total == count_hits(index, q.all_of(asked, q.Exists("n"))).first()["hits"]


@SETTINGS
@given(words=st.lists(st.text("abcé", min_size=0, max_size=6), min_size=1, max_size=30), value=st.text("abcé", max_size=5),
       distance=st.integers(0, 2))
def test_swap_distance(spark, words, value, distance):
    rows = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r["near"] for r in rows.select(within_distance(F.col("w"), value, distance, True).alias("near")).collect()]
    assert got == [osa(w, value) <= distance for w in words]


@pytest.mark.parametrize(
    "word, stem",
    [
        # Published examples of the rules.
        ("consign", "consign"), ("consigned", "consign"), ("consigning", "consign"), ("consignment", "consign"),
        ("consist", "consist"), ("consisted", "consist"), ("consistency", "consist"), ("consistently", "consist"),
        ("consolation", "consol"), ("consolations", "consol"), ("consolatory", "consolatori"), ("console", "consol"),
        ("knack", "knack"), ("knackeries", "knackeri"), ("knaves", "knave"), ("kneel", "kneel"), ("kneeling", "kneel"),
        ("knees", "knee"), ("knightly", "knight"), ("knocked", "knock"), ("knotty", "knotti"), ("knowing", "know"),
        ("caresses", "caress"), ("ties", "tie"), ("cries", "cri"), ("gaps", "gap"), ("gas", "gas"), ("kiwis", "kiwi"),
        ("luxuriated", "luxuri"), ("hopping", "hop"), ("hoping", "hope"), ("cry", "cri"), ("by", "by"), ("say", "say"),
        ("skies", "sky"), ("dying", "die"), ("news", "news"), ("inning", "inning"), ("proceed", "proceed"),
        ("rational", "ration"), ("generously", "generous"), ("controlled", "control"), ("rolling", "roll"),
    ],
)
def test_english_stem_examples(word, stem):
    assert stem_english(word) == stem


def test_english_stems_beside_the_rules_in_sql():
    rng = random.Random(5)
    ends = sql._LONGER[::2] + sql._MIDDLE[::2] + sql._LAST + "sses ied ies us ss s eed eedly ed edly ing ingly y e ll at bl iz".split()
    made = {"".join(rng.choice("aeiouybdglnrstwxé") for _ in range(rng.randrange(0, 7))) for _ in range(3000)}
    made |= {w + rng.choice(ends) for w in made} | {w + rng.choice(ends) + rng.choice(ends) for w in made}
    made |= {p + rng.choice(ends) for p in ("gener", "commun", "arsen") for _ in range(30)} | set(sql._WHOLE) | set(sql._KEPT)
    words = sorted(made - {""})
    con = duckdb.connect()
    con.register("made", pa.table({"term": words}))
    found = dict(con.execute(f"WITH {sql.english_stems('made')} SELECT term, stem FROM english").fetchall())
    assert {w: (stem_english(w), found[w]) for w in words if stem_english(w) != found[w]} == {}
