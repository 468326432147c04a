"""Summaries of fields against the fields themselves."""

from __future__ import annotations

from functools import reduce

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.errors import AggregationError, MappingError
from quillspark.mapping import Mapping
from quillspark.operators.stored import COUNT_ERROR, DISTINCT_ERROR, RANK_ERROR, stored_cardinality, stored_frequent, stored_percentiles, stored_stats
from quillspark.sources.index import Index
from quillspark.sources.tables import summary_table
from quillspark.sources.versions import IndexDirectory

KEPT = {"fast": True, "summary": True}
MAPPING = Mapping.build([("v", "f64", KEPT), ("n", "i64", KEPT), ("w", "u64", {**KEPT, "wide": True}), ("s", "string", KEPT), ("b", "bool", KEPT), ("d", "date", KEPT), ("t", "text")])
SCHEMA = "doc_id long, v double, n long, w string, s string, b boolean, d timestamp, t string"


def batch(spark, seed, first, n):
    """Numbers of a long tail, many of them equal, and nulls."""
    draw = F.rand(seed)
    return spark.range(first, first + n).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 9 > 0, F.round(-F.log(draw) * 100, 1)).alias("v"), (F.col("id") % 5003).alias("n"),
        F.format_string("18446744073709551%03d", F.col("id") % 500).alias("w"), F.concat(F.lit("k"), F.col("id") % 700).alias("s"),
        (F.col("id") % 2 == 0).alias("b"), F.timestamp_seconds(F.col("id") * 60).alias("d"), F.lit("x").alias("t"),
    )


@pytest.fixture(scope="module")
def directory(spark, tmp_path_factory):
    made = IndexDirectory(spark, str(tmp_path_factory.mktemp("stored")) + "/ix").create(MAPPING)
    for i, n in enumerate((20_000, 9_000, 3)):
        made.append(batch(spark, i, 100_000 * i, n))
    return made


def test_counts_and_extremes_are_exact(directory):
    index = directory.open()
    for name, number in (("v", F.col("v")), ("n", F.col("n").cast("double")), ("b", F.col("b").cast("int").cast("double")), ("d", F.unix_millis("d").cast("double"))):
        exact = index.docs.agg(F.count(name), F.min(number), F.max(number)).first()
        assert tuple(stored_stats(index, name).first()) == tuple(exact), name
    assert stored_stats(index, "s").first()["count"] == 29_003


def test_percentiles_have_the_ranks_they_say(directory):
    index = directory.open()
    values = sorted(r["v"] for r in index.docs.select("v").filter("v is not null").collect())
    for r in stored_percentiles(index, "v", (1.0, 10.0, 50.0, 90.0, 99.5)).collect():
        low, high = (sum(1 for x in values if test(x)) / len(values) for test in (lambda x: x < r["value"], lambda x: x <= r["value"]))
        assert low - 2 * RANK_ERROR <= r["percent"] / 100 <= high + 2 * RANK_ERROR


@pytest.mark.parametrize("name, exact", [("n", 5003), ("w", 500), ("s", 700), ("b", 2)])
def test_distinct_values_are_near(directory, name, exact):
    row = stored_cardinality(directory.open(), name).first()
    assert abs(row["value"] - exact) <= max(1, 4 * DISTINCT_ERROR * exact) and row["error"] == DISTINCT_ERROR


@pytest.mark.parametrize("name", ["v", "n", "s", "b", "d"])
def test_frequent_values_have_the_counts_they_say(directory, name):
    index = directory.open()
    text = F.unix_millis(name).cast("string") if name == "d" else F.col(name).cast("string")
    exact = {r["key"]: r["count"] for r in index.docs.filter(F.col(name).isNotNull()).groupBy(text.alias("key")).count().collect()}
    found = {r["key"]: r for r in stored_frequent(index, name, 1000).collect()}
    assert all(r["at_least"] <= exact[k] <= r["at_most"] for k, r in found.items())
    error, best = COUNT_ERROR * sum(exact.values()), sorted(exact.values(), reverse=True)[:1000]
    assert {k for k, n in exact.items() if n > 2 * error and n > best[-1]} <= set(found)
    if len(exact) <= 1000:
        assert {k: r["at_most"] for k, r in found.items()} == exact


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 40_000), st.integers(0, 3)), min_size=1, max_size=4), st.integers(1, 60))
def test_bounds_of_frequent_values_hold_for_any_batches(spark, batches, hot):
    """Batches of many distinct values and a hot one, merged: the sketch overflows, the bounds hold."""
    mapping = Mapping.build([("n", "i64", KEPT)])
    made, exact = [], {}
    for size, shift in batches:
        rows = spark.range(size).select(F.when(F.col("id") % 100 < hot, F.lit(7)).otherwise(F.col("id") * (shift + 1) + shift * 1000).alias("n"))
        made.append(summary_table(rows, mapping))
        for r in rows.groupBy("n").count().collect():
            exact[str(r["n"])] = exact.get(str(r["n"]), 0) + r["count"]
    index = Index.in_memory(spark.createDataFrame([], "doc_id long, n long"), mapping)
    index.summaries = reduce(lambda a, b: a.union(b), made)
    found = {r["key"]: (r["at_least"], r["at_most"]) for r in stored_frequent(index, "n", 50).collect()}
    assert all(low <= exact[k] <= high and high - low <= 1 + COUNT_ERROR * sum(exact.values()) for k, (low, high) in found.items())
    assert len(found) == 50 or {k for k, n in exact.items() if n > 2 * COUNT_ERROR * sum(exact.values())} <= set(found)


def test_only_summaries_are_read(directory):
    index = directory.open()
    for frame in (stored_frequent(index, "n", 5), stored_percentiles(index, "v", (50.0,)), stored_cardinality(index, "s"), stored_stats(index, "v")):
        files = {f.split("/ix/")[1].split("/")[0] for f in frame.inputFiles()}
        assert files == {"summaries"}


def test_summaries_are_refused_after_a_delete_and_made_anew(spark, tmp_path):
    made = IndexDirectory(spark, f"{tmp_path}/ix").create(MAPPING)
    made.append(batch(spark, 1, 0, 400))
    made.delete("b", True)
    for ask in (lambda x: stored_stats(x, "v"), lambda x: stored_percentiles(x, "v", (5.0,)), lambda x: stored_cardinality(x, "n"), lambda x: stored_frequent(x, "n", 3)):
        with pytest.raises(AggregationError):
            ask(made.open())
    made.rewrite()
    assert stored_stats(made.open(), "n").first()["count"] == 200 and stored_cardinality(made.open(), "b").first()["value"] == 1


def test_nothing_to_summarize(spark, tmp_path):
    made = IndexDirectory(spark, f"{tmp_path}/ix").create(MAPPING)
    assert tuple(stored_stats(made.open(), "v").first()) == (0, None, None) and stored_cardinality(made.open(), "v").first()["value"] == 0
    assert stored_frequent(made.open(), "v", 3).collect() == []
    made.append(spark.createDataFrame([(1, None, None, None, None, None, None, None)], SCHEMA))
    assert stored_frequent(made.open(), "v", 3).collect() == []
    assert stored_percentiles(made.open(), "v", (50.0,)).collect() == [] and stored_stats(made.open(), "v").first()["count"] == 0
    for bad in (("t", "text", {"summary": True, "stored": True}), ("s", "string", {"summary": True})):
        with pytest.raises(MappingError):
            Mapping.build([bad])
    with pytest.raises(AggregationError):
        stored_percentiles(made.open(), "s", (50.0,))
    with pytest.raises(AggregationError):
        stored_stats(made.open(), "t")
