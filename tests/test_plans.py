"""What the physical plans must look like to hold at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from quillspark.mapping import Mapping
from quillspark.operators import aggs as a
from quillspark.operators.search import highlight_all, search, top_k
from quillspark.plans import query as q
from quillspark.plans.compile import compile_query, matches
from quillspark.sources import tables
from quillspark.sources.versions import build_index

MAPPING = Mapping.build(
    [("body", "text", {"stored": True}), ("kind", "string", {"stored": True, "fast": True}), ("n", "i64", {"fast": True})]
)


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rows = spark.range(200).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("common word"), F.when(F.col("id") % 20 == 0, " rare").otherwise(""), F.lit(" w"), F.col("id") % 7).alias("body"),
        F.concat(F.lit("k"), F.col("id") % 3).alias("kind"),
        F.col("id").alias("n"),
    )
    return build_index(rows, MAPPING, str(tmp_path_factory.mktemp("plans")) + "/ix")


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def exchanges(frame) -> int:
    return plan(frame).count("Exchange hashpartitioning")


def test_one_word_has_no_shuffle_and_reads_one_directory(index):
    frame = top_k(index, "rare", fields=("body",))
    text = plan(frame)
    assert exchanges(frame) == 0 and "BroadcastExchange" not in text and "TakeOrderedAndProject" in text
    assert "EqualTo(term,rare)" in text and "positions" not in text
    pruned = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "= body" in pruned and re.search(r"term_bucket#\d+ = \d", pruned)


def test_any_boolean_tree_has_one_shuffle(index):
    inner = q.boolean(("should", q.phrase("body", "common", "word")), ("should", q.match("rare", "body")), ("must_not", q.match("w3", "body")))
    frame = top_k(index, q.boolean(("must", inner), ("must", q.Range("n", 10, 90)), ("should", q.Prefix("body", "w"))))
    assert exchanges(frame) == 1
    assert "SortMergeJoin" not in plan(frame) and "CartesianProduct" not in plan(frame)


def test_conditions_reach_the_scan(index):
    frame = top_k(index, q.Range("n", 10, 90))
    text = plan(frame)
    assert exchanges(frame) == 0
    assert "GreaterThanOrEqual(n,10)" in text and "LessThanOrEqual(n,90)" in text
    assert "body" not in text.split("ReadSchema")[1]
    assert "EqualTo(n,20)" in plan(top_k(index, q.Boost(q.Term("n", 20), 2.0)))
    mixed = plan(matches(q.all_of(q.match("common", "body"), q.Range("n", 10, 90)), index))
    assert "GreaterThanOrEqual(n,10)" in mixed


def test_negated_conditions_keep_missing_values(spark):
    from quillspark.sources.index import Index

    rows = spark.createDataFrame([(0, "a", 1), (1, "a", None)], "doc_id bigint, body string, n bigint")
    index = Index.in_memory(rows, Mapping.build([("body", "text"), ("n", "i64")]))
    for positive in (q.All(), q.match("a", "body")):
        asked = q.boolean(("must", positive), ("must_not", q.Term("n", 1)))
        assert [r["doc_id"] for r in matches(asked, index).collect()] == [1]


def test_stored_fields_are_read_for_the_page_alone(index):
    frame = search(index, "common rare", limit=3, fields=("body",), highlight=("body",))
    text = plan(frame)
    assert "dynamicpruning" in text  # only the directories the page's keys hash to
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_building_postings_has_no_shuffle(spark, index):
    postings = tables.postings_table(index.docs, MAPPING)
    assert "Exchange" not in plan(postings) and "Python" not in plan(postings)


def test_a_rare_scope_is_broadcast_by_its_proven_size(index):
    compiled = compile_query(q.match("rare", "body"), index)
    assert compiled.at_most == 10
    frame = a.aggregate(index, {"n": a.avg("n")}, query="rare", fields=("body",))["metrics"]
    assert "BroadcastHashJoin" in plan(frame) and exchanges(frame) == 0
    assert compile_query(q.Range("n", 0, 5), index).at_most is None


def test_a_queried_scope_is_kept_for_several_aggregations(index):
    found = a.aggregate(index, {"k": a.terms("kind"), "h": a.histogram("n", 50.0)}, query="rare", fields=("body",))
    assert found.kept is not None and found.kept.is_cached
    assert found["k"].count() > 0 and found["h"].count() > 0
    found.release()
    assert not found.kept.is_cached


def test_gap_filling_computes_its_buckets_once(index):
    frame = a.aggregate(index, {"h": a.histogram("n", 7.0, aggs={"m": a.avg("n")})})["h"]
    frame.collect()
    text = plan(frame).split("Initial Plan")[0]
    assert text.count("FileScan") == 1 and "ReusedExchange" in text


def test_postings_are_sorted_within_files(spark, index):
    rows = index.postings.withColumn("file", F.input_file_name()).withColumn("i", F.monotonically_increasing_id())
    per_file = {}
    for r in rows.orderBy("i").collect():
        per_file.setdefault(r["file"], []).append((r["term"], r["doc_id"]))
    assert all(rows == sorted(rows) for rows in per_file.values())


def test_a_keyword_scope_is_a_filter(index):
    asked = q.boolean(("must", q.Term("kind", "k1")), ("must_not", q.Range("n", 50, None)), ("should", q.Prefix("kind", "k")))
    frame = a.aggregate(index, {"n": a.sum_("n")}, query=asked)["metrics"]
    assert "Join" not in plan(frame) and "EqualTo(kind,k1)" in plan(frame)
    assert frame.first()["n"] == sum(i for i in range(50) if i % 3 == 1)


def test_texts_that_exist_are_found_in_the_documents_without_a_shuffle(index):
    frame = matches(q.Exists("body"), index)
    assert exchanges(frame) == 0 and "positions" not in plan(frame) and frame.count() == 200


def test_hits_are_read_from_their_own_directories(index):
    for frame in (highlight_all(index, "rare", "body", ("body",)), a.scope(index, "rare", ("body",))):
        assert "dynamicpruning" in plan(frame) and frame.count() == 10


def test_patterns_of_a_query_share_one_pass(index, monkeypatch):
    asked = []
    resolve = type(index).resolve
    monkeypatch.setattr(type(index), "resolve", lambda self, patterns: asked.append(len(patterns)) or resolve(self, patterns))
    query = [("should", q.Prefix("body", "w")), ("should", q.Fuzzy("body", "rere", 1)), ("should", q.Regex("body", "com.*"))]
    found = matches(q.as_query(query), index)
    assert asked == [3] and found.count() == 200
    scores = {r["score"] for r in found.collect()}
    assert scores == {2.0, 3.0}


def test_documents_are_split_into_words_once_for_a_map_of_stems(spark):
    rows = spark.createDataFrame([(1, "walks walked a walk"), (2, ""), (3, None), (4, "b walks")], "doc_id bigint, body string")
    stems = spark.createDataFrame([("walks", "walk"), ("walked", "walk")], "term string, stem string")
    alone = Mapping.build([("body", "text", {"tokenizer": "fr_stem"})])
    found = tables.postings_table(rows, alone, {"fr_stem": stems})
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Generate inline") == 1
    groups = {(r["doc_id"], r["term"]): (r["tf"], r["dl"], r["positions"]) for r in found.collect()}
    assert groups == {(1, "walk"): (3, 4, [0, 1, 3]), (1, "a"): (1, 4, [2]), (4, "b"): (1, 2, [0]), (4, "walk"): (1, 2, [1])}
    both = Mapping.build([("body", "text", {"tokenizer": "fr_stem"}), ("kind", "string")])
    more = tables.postings_table(rows.withColumn("kind", F.lit("walks")), both, {"fr_stem": stems})
    assert {(r["doc_id"], r["term"]) for r in more.filter("field = 'kind'").collect()} == {(i, "walks") for i in (1, 2, 3, 4)}
    assert more.filter("field = 'body'").count() == 4


def test_sorted_entries_are_a_column_of_their_own(spark):
    """Array functions copy what they are given, so grouping must not hand whole documents from one to another."""
    rows = spark.createDataFrame([(1, "b a b")], "doc_id bigint, body string")
    frame = tables.postings_table(rows, Mapping.build([("body", "text")]))
    generate = next(x for x in frame._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Generate" in x)
    assert "sort_array" not in generate and "regexp_extract_all" not in generate
    assert {(r["term"], r["tf"], r["dl"], tuple(r["positions"])) for r in frame.collect()} == {("a", 1, 3, (1,)), ("b", 2, 3, (0, 2))}
