"""Tables of queries against one query at a time."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from quillspark.mapping import Mapping
from quillspark.operators import batch, blocks
from quillspark.operators.batch import batch_hits, batch_search, batch_search_box, near_terms
from quillspark.operators.search import search, top_k
from quillspark.plans import query as q
from quillspark.sources import tables
from quillspark.sources.index import Index
from quillspark.sources.versions import build_index

WORDS = ["the", "of", "in", "engine", "engines", "enigne", "gear", "geer", "gaer", "a", "fr", "überlang", "Straße", "o'neil"]
STORED = {"stored": True}


def texts(seed: int, n: int, most: int):
    rng = random.Random(seed)
    join = lambda: rng.choice([" ", " ", "-", " <", "  "])
    return ["".join(rng.choice(WORDS) + join() for _ in range(rng.randrange(0, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    mapping = Mapping.build([("t", "text", {"stored": True, "pairs": True}), ("s", "string", STORED), ("n", "i64", {"fast": True})])
    rows = [(i, t or None, f"src{i % 7}", i) for i, t in enumerate(texts(3, 90, 30))]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tables, "PAIRED_SHARE", 4)
        made = build_index(spark.createDataFrame(rows, "doc_id long, t string, s string, n long"), mapping, str(tmp_path_factory.mktemp("b")) + "/ix")
    assert {"the", "of"} <= made.paired["t"]
    return made


ASKED = [*texts(8, 14, 6), "of-the", "in-the-of gear", "the-the-the", " ", "nowhere-the of", "src3 Engnie", "ab abcd"]


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(list(enumerate(ASKED)), "query_id long, text string")


def by_query(frame, *columns):
    found = {i: [] for i in range(len(ASKED))}
    for r in frame.orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(tuple(r[c] for c in columns))
    return found


@pytest.mark.parametrize("many", [0, 10**9])
def test_phrases_by_pairs_of_frequent_words(index, queries, many):
    found = by_query(batch_search(index, queries, 4, many_postings=many), "doc_id", "score")
    for i, text in enumerate(ASKED):
        assert found[i] == [tuple(r) for r in top_k(index, text, limit=4).collect()], text


def test_hits_with_snippets_are_those_of_single_searches(index, queries):
    found = by_query(batch_hits(index, queries, 3, highlight=("t", "s", "nowhere")), "rank", "doc_id", "score", "doc", "highlights")
    for i, text in enumerate(ASKED):
        assert found[i] == [tuple(r) for r in search(index, text, limit=3, highlight=("t", "s", "nowhere")).collect()], text
    plain = batch_hits(index, queries, 1).first()
    assert plain["highlights"] == {}


def test_snippets_of_fields_stemmed_by_a_map(spark):
    mapping = Mapping.build([("t", "text", {"stored": True, "tokenizer": "fr_stem"})])
    rows = spark.createDataFrame([(0, "les chevaux"), (1, "un cheval & un chat"), (2, "chats")], "doc_id bigint, t string")
    stems = spark.createDataFrame([("chevaux", "cheval"), ("cheval", "cheval"), ("chats", "chat")], "term string, stem string")
    index = Index.in_memory(rows, mapping, {"fr_stem": stems})
    asked = ["chat", "Chevaux", "un cheval"]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id bigint, text string")
    found = batch_hits(index, queries, highlight=("t",)).orderBy("query_id", "rank").collect()
    for i, text in enumerate(asked):
        single = search(index, text, highlight=("t",)).collect()
        assert [(r["doc_id"], r["highlights"]) for r in found if r["query_id"] == i] == [(r["doc_id"], r["highlights"]) for r in single]


def test_search_boxes_are_those_of_single_searches(index, queries):
    boosts = {"t": 1.0, "s": 2.5}
    found = by_query(batch_search_box(index, queries, boosts, 5), "doc_id", "score")
    for i, text in enumerate(ASKED):
        single = q.search_box(text, boosts)
        assert found[i] == ([tuple(r) for r in top_k(index, single, limit=5).collect()] if single else []), text


def distance(a: str, b: str) -> int:
    """Edits and swaps of neighbours, the restricted form."""
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_near_terms_by_comparing_everything(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abü") for _ in range(rng.randrange(1, 8)))
    terms, words = {word() for _ in range(250)}, {word() for _ in range(120)}
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(sorted(terms))], "doc_id long, s string")
    index = Index.in_memory(docs, Mapping.build([("s", "string", STORED)]))
    found = near_terms(index, spark.createDataFrame([(w,) for w in words], "word string"), ["s"]).collect()
    expected = {(w, t) for w in words for t in terms if (distance(w, t) <= 1 if len(w) > 3 else w == t)}
    assert {(r["word"], r["term"]) for r in found} == expected and len(found) == len(expected)


def test_no_comparison_of_everything_with_everything(index, queries):
    frame = batch_search_box(index, queries, {"t": 1.0})
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text


def test_a_search_box_deals_documents_once(index, queries, monkeypatch):
    """What is added up for a document and a text stays where the document was dealt to, in tasks of bounded size."""
    boosts = {"t": 1.0, "s": 2.0}
    few = batch_search_box(index, queries, boosts, 5)
    monkeypatch.setattr(batch, "SCORED_PAIRS", 16)
    frame = batch_search_box(index, queries, boosts, 5)
    text = frame._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "doc_id" in line]
    parts = -(-index.n_docs * sum(bool(t.strip()) for t in ASKED) // 16)
    assert len(dealt) == 1 and re.search(rf"doc_id#\d+L, {parts}\), REPARTITION_BY_NUM", dealt[0]), dealt
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, frame.collect()))


def _outputs(plan):
    """The names of the columns of every step of a plan."""
    listed = lambda rows: [rows.apply(i) for i in range(rows.length())]
    yield {a.name() for a in listed(plan.output())}
    for child in listed(plan.children()):
        yield from _outputs(child)


@pytest.mark.parametrize("many", [0, 10**9])
def test_postings_are_not_repeated_for_every_query(index, queries, many):
    frame = batch_search(index, queries, 4, many_postings=many)
    steps = list(_outputs(frame._jdf.queryExecution().optimizedPlan()))
    assert any("positions" in names for names in steps)
    assert not [names for names in steps if "query_id" in names and names & {"positions", "tf", "starts"}]


def test_several_blocks_and_parts_and_equal_scores(index, queries, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_DOCS", 7)
    monkeypatch.setattr(blocks, "ASKED_WORDS", 9)
    for many in (0, 10**9):
        found = by_query(batch_search(index, queries, 4, many_postings=many), "doc_id", "score")
        for i, text in enumerate(ASKED):
            assert found[i] == [tuple(r) for r in top_k(index, text, limit=4).collect()], text


def test_of_equal_scores_the_first_keys_are_kept():
    scores = np.array([0.0, 2.0000001, 2.0, 2.0000002, 1.0, 2.0])
    kept = blocks.first(pa.array(["a", "f", "e", "d", "b", "c"]), scores, 3)
    assert kept.tolist() == [5, 3, 2]
    assert blocks.first(pa.array([3, 1, None, 2, 0, 9]), scores, 3).tolist() == [2, 1, 3]
