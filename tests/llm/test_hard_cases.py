"""Extreme vectors, values of one repository, deep and long pages."""

from __future__ import annotations

import itertools
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.llm import ann, extraction, secrets


def test_extreme_vectors_and_repeated_ids(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((60, 8))
    rows = [(i, (v * 10.0 ** (0, 200, -200, 300)[i % 4]).tolist(), "a", 1) for i, v in enumerate(base)]
    rows += [(3, rows[3][1], "b", 2), (70, [float("inf")] + [1.0] * 7, "c", 3), (71, [0.0] * 8, None, None), (72, [5e-324] * 8, "d", 4)]
    docs = spark.createDataFrame(rows, "id long, v array<double>, t string, g int")
    found = ann.nearest(docs, docs.filter("id < 20"), 5, "id", "v").collect()
    assert all(np.isfinite(r["score"]) and abs(r["score"]) <= 1 + 1e-12 for r in found)
    unit = np.vstack([base, np.ones(8)])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    ids = [*range(60), 72]
    for i in range(20):
        scores = {c: float(unit[i] @ unit[at]) for at, c in enumerate(ids) if c != i}
        got = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == i)
        assert [g[0] for g in got] == [1, 2, 3, 4, 5]
        assert all(score == pytest.approx(scores[c]) for _, c, score in got)
        assert [g[1] for g in got] == sorted(scores, key=lambda c: -scores[c])[:5]


def test_scaling_does_not_change_a_cosine():
    import pyarrow as pa

    v = np.random.default_rng(1).standard_normal((40, 16)) * 3
    scaled = ann._matrix(pa.array(v.tolist(), pa.list_(pa.float64())), 16)
    assert np.array_equal(ann.exact_cosine(scaled[0], scaled), ann.exact_cosine(v[0], v))


def test_values_of_one_repository_are_not_shared(spark):
    value = "k3Yd" * 8
    rows = [
        (1, f"{value}x1", "ann", "r1"), (2, f"{value}x1", "bob", "r1"),  # two owners of one repository
        (3, f"{value}x2", "ann", "r1"), (4, f"{value}x2", "ann", "r2"),  # one owner of two
        (5, f"{value}x3", "ann", "r1"), (6, f"{value}x3", "bob", "r2"), (7, f"{value}x3", None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, o string, r string")
    found = {r["doc"]["doc_id"]: r["spans"][0] for r in secrets.scan(docs, "text", F.col("o"), F.col("r"), ["doc_id"]).collect()}
    assert {i: (s["n_owners"], s["n_repositories"], s["shared"]) for i, s in found.items()} == {
        1: (2, 1, False), 2: (2, 1, False), 3: (1, 2, False), 4: (1, 2, False), 5: (3, 3, True), 6: (3, 3, True), 7: (3, 3, True),
    }


def test_many_matches_in_one_text(spark):
    text = " ".join(f"token = {'ab' * 3}{i}" for i in range(3_000))
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    found = {r["doc"]["doc_id"]: len(r["spans"]) for r in secrets.scan(docs, "text", F.lit("a"), F.lit("b"), ["doc_id"]).collect()}
    assert found == {1: 3_000, 2: 0, 3: 0}


@pytest.mark.parametrize("seed", range(60))
def test_cut_is_the_smallest_of_all_labellings(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 9)
    odds = [rng.choice([0.0, rng.uniform(-4, 4)]) for _ in range(n)]
    edges = [(i, i + 1, rng.choice([0.3, 0.5, 1.0])) for i in range(n - 1)]
    edges += [(*sorted(rng.sample(range(n), 2)), 0.5) for _ in range(rng.randint(0, 3)) if n > 1]

    def cost(labels):
        own = sum(max(0.0, x) if content else max(0.0, -x) for x, content in zip(odds, labels))
        return own + sum(w for a, b, w in edges if labels[a] != labels[b])

    every = list(itertools.product([False, True], repeat=n))
    least = min(map(cost, every))
    best = [c for c in every if cost(c) <= least + 1e-9]
    found = extraction.min_cut(odds, edges)
    assert cost(found) == pytest.approx(least)
    assert sum(found) == min(map(sum, best))  # of equal cuts the one with least content


def test_text_of_formulas_and_captions_stays():
    kept = "<article><p>The formula <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds for <label>all</label> of the values that were read.</p></article>"
    assert extraction.main_text(kept) == "The formula x=2 holds for all of the values that were read."
    fallback = "<article><p>A map of the <object data='m.svg'>northern</object> coast was drawn by hand in the winter.</p></article>"
    assert extraction.main_text(fallback) == "A map of the northern coast was drawn by hand in the winter."
    form = "<article><p>A long enough paragraph of text stands here.</p><form><label>Your name</label><legend>You</legend></form></article>"
    assert extraction.main_text(form) == "A long enough paragraph of text stands here."


def test_long_and_deep_pages_take_time_in_proportion():
    blocks = "".join(f"<p>{'Words of an article that goes on for a while. ' * 2}</p><div><a href='#'>link {i}</a></div>" for i in range(50_000))
    start = time.monotonic()
    text = extraction.main_text(f"<body><article>{blocks}</article></body>")
    assert text.count("Words of an article") == 100_000
    deep = "<div>" * 60_000 + "<b>" * 60_000 + "text " + "</i>" * 60_000
    assert extraction.main_text(deep) in ("", "text")
    odds = [3.0 if i % 2 else -3.0 for i in range(100_000)]
    assert sum(extraction.min_cut(odds, [(i, i + 1, 1.0) for i in range(99_999)])) == 50_000
    halves = [4.0 if i < 50_000 else -4.0 for i in range(100_000)]
    assert sum(extraction.min_cut(halves, [(i, i + 1, 9.0) for i in range(99_999)])) in (50_000, 49_999, 50_001)
    assert time.monotonic() - start < 60


def test_unclosed_and_misnested_markup():
    assert [b.text for b in extraction.blocks_of("<p>one<p>two<div>three<p>four</div>five</p>six")] == ["one", "two", "three", "four", "five", "six"]
    assert [b.text for b in extraction.blocks_of("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e")] == ["a", "b", "c", "d", "e"]
    assert [b.text for b in extraction.blocks_of("<table><tr><td>a<td>b<tr><td>c</table></b></i>d")] == ["a", "b", "c", "d"]
