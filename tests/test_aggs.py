import pytest
from pyspark.sql import functions as F

from quillspark.errors import AggregationError
from quillspark.mapping import Mapping
from quillspark.operators import aggs as a
from quillspark.plans import query as q
from quillspark.sources.index import Index


def table(frame, key="key", value="doc_count"):
    return {r[key]: r[value] for r in frame.collect()}


def test_terms(products):
    found = a.aggregate(products, {"by_category": a.terms("category")})["by_category"]
    assert table(found) == {"electronics": 3, "sports": 2, "books": 2}
    assert [r["key"] for r in found.collect()] == ["electronics", "books", "sports"]
    top = a.aggregate(products, {"c": a.terms("category", size=1)})["c"].first()
    assert (top["key"], top["sum_other_doc_count"]) == ("electronics", 4)


def test_metrics(products):
    found = a.aggregate(
        products,
        {"avg": a.avg("price"), "min": a.min_("price"), "max": a.max_("price"), "sum": a.sum_("quantity"), "s": a.stats("price"),
         "n": a.count("price"), "u": a.cardinality("category", exact=True)},
    )["metrics"].first()
    assert found["avg"] == pytest.approx(368.56, abs=0.01)
    assert (found["min"], found["max"], found["sum"], found["s_count"]) == (14.99, 999.99, 565, 7)
    assert (found["s_min"], found["s_max"], found["n"], found["u"]) == (14.99, 999.99, 7, 3)


def test_query_scope(products):
    found = a.aggregate(products, {"s": a.stats("price")}, query="laptop")["metrics"].first()
    assert (found["s_count"], found["s_min"], found["s_max"]) == (2, 499.99, 999.99)
    empty = a.aggregate(products, {"s": a.stats("price")}, query=q.match("nothing"))["metrics"].first()
    assert (empty["s_count"], empty["s_sum"], empty["s_avg"]) == (0, 0, None)


def test_histogram_fills_gaps(products):
    found = table(a.aggregate(products, {"h": a.histogram("price", 200.0)})["h"])
    assert found == {0.0: 4, 200.0: 0, 400.0: 1, 600.0: 1, 800.0: 1}
    found = table(a.aggregate(products, {"h": a.histogram("price", 200.0, min_doc_count=1)})["h"])
    assert found == {0.0: 4, 400.0: 1, 600.0: 1, 800.0: 1}


def test_histogram_of_very_many_buckets(products):
    found = a.aggregate(products, {"h": a.histogram("price", 0.01)})["h"]
    assert found.count() == 98_501 and found.agg({"doc_count": "sum"}).first()[0] == 7
    with pytest.raises(AggregationError):
        a.aggregate(products, {"h": a.histogram("price", 0)})


def test_text_that_is_only_fast(spark):
    rows = spark.createDataFrame([(0, "b c", 1), (1, "a", None), (2, "b c", 3)], "doc_id bigint, t string, n bigint")
    mapping = Mapping.build([("t", "text", {"fast": True}), ("n", "i64", {"fast": True}), ("slow", "i64", {"stored": True})])
    index = Index.in_memory(rows, mapping)
    assert table(a.aggregate(index, {"t": a.terms("t")})["t"]) == {"b c": 2, "a": 1}
    best = a.aggregate(index, {"b": a.TopHits("n", size=3, descending=False, show=("t",))})["b"].orderBy("position").collect()
    assert [tuple(r) for r in best] == [(0, 1, "b c", 1), (2, 3, "b c", 2), (1, None, "a", 3)]
    with pytest.raises(AggregationError):
        a.aggregate(index, {"b": a.TopHits("slow")})
    with a.aggregate(index, {"t": a.terms("t"), "m": a.max_("n")}, query="b", fields=("t",)) as found:
        assert found["metrics"].first()["m"] == 3 and found.kept is not None


def test_ranges(products):
    spans = [{"to": 100.0}, {"from": 100.0, "to": 500.0}, {"from": 500.0}]
    assert table(a.aggregate(products, {"r": a.ranges("price", spans)})["r"]) == {"*-100": 3, "100-500": 2, "500-*": 2}


def test_several_and_nested(products):
    found = a.aggregate(
        products,
        {
            "c": a.terms("category", aggs={"p": a.avg("price"), "h": a.histogram("price", 500.0), "best": a.TopHits("price", 1)}),
            "h": a.histogram("price", 500.0),
            "s": a.stats("price"),
        },
    )
    assert set(found) == {"metrics", "c", "c>h", "c>best", "h"}
    assert table(found["c"], value="p")["electronics"] == pytest.approx((999.99 + 499.99 + 799.99) / 3)
    assert {(r["c"], r["key"]): r["doc_count"] for r in found["c>h"].collect()} == {
        ("electronics", 0.0): 1, ("electronics", 500.0): 2, ("sports", 0.0): 2, ("books", 0.0): 2,
    }
    assert table(found["c>best"], "c", "price") == {"electronics": 999.99, "sports": 149.99, "books": 24.99}


def test_percentiles(products):
    metric = a.percentiles("price", (0.0, 50.0, 100.0))
    rows = a.percentile_rows(a.aggregate(products, {"p": metric})["metrics"], "p", metric)
    assert table(rows, "percent", "value") == {0.0: 14.99, 50.0: 149.99, 100.0: 999.99}


def test_percentiles_rank_error(spark, products):
    n = 50_000
    rows = spark.range(n).select((F.col("id") * 7919 % n).cast("double").alias("price"))
    metric = a.percentiles("price")
    found = a.percentile_rows(a.aggregate_rows(rows, products.mapping, {"p": metric})["metrics"], "p", metric)
    for percent, value in table(found, "percent", "value").items():
        assert abs(value - n * percent / 100) <= 2 * n / metric.accuracy + 1


def test_cardinality_sketch_error(spark, products):
    rows = spark.range(20_000).select(F.col("id").alias("quantity"))
    found = a.aggregate_rows(rows, products.mapping, {"u": a.cardinality("quantity")})["metrics"].first()["u"]
    assert abs(found - 20_000) < 20_000 * 0.15


def test_only_fast_fields(products):
    with pytest.raises(AggregationError, match="not a fast field"):
        a.aggregate(products, {"t": a.terms("title")})
    with pytest.raises(AggregationError, match="unknown field"):
        a.aggregate(products, {"t": a.avg("nope")})
    with pytest.raises(AggregationError, match="no numbers"):
        a.aggregate(products, {"t": a.avg("category")})
    with pytest.raises(AggregationError, match="not a date field"):
        a.aggregate(products, {"d": a.date_histogram("price", "1d")})


def test_date_histogram(spark):
    mapping = Mapping.build([("at", "date", {"fast": True})])
    rows = spark.createDataFrame(
        [(0, "2024-01-01T00:10:00Z"), (1, "2024-01-01T02:59:59Z"), (2, None)], "doc_id bigint, at string"
    )
    index = Index.in_memory(rows, mapping)
    hours = a.aggregate(index, {"h": a.date_histogram("at", "1h")})["h"]
    assert table(hours, "key_as_string") == {"2024-01-01T00:00:00Z": 1, "2024-01-01T01:00:00Z": 0, "2024-01-01T02:00:00Z": 1}
    with pytest.raises(AggregationError, match="invalid fixed interval"):
        a.aggregate(index, {"h": a.date_histogram("at", "1 week")})


def test_beside_each_other_as_alone(spark):
    """Counts made in one pass are those of a request of its own, nested ones, overlapping ranges and empty scopes included."""
    rows = spark.range(400).selectExpr(
        "id as doc_id",
        "case when id % 7 > 0 then concat('k', cast(id * id % 11 as string)) end as kind",
        "case when id % 5 > 0 then cast(id * 37 % 101 as double) end as price",
        "case when id % 6 > 0 then id * 13 % 17 end as quantity",
    )
    fast = {"stored": True, "fast": True}
    mapping = Mapping.build([("kind", "string", fast), ("price", "f64", fast), ("quantity", "i64", fast)])
    index = Index.in_memory(rows, mapping)
    spans = [{"to": 50.0}, {"from": 20.0, "to": 60.0}, {"from": 50.0, "to": 80.0}, {"from": 60.0}]
    inner = {"p": a.extended_stats("price"), "r": a.ranges("price", spans, aggs={"u": a.cardinality("kind", exact=True)}), "h": a.histogram("quantity", 5.0)}
    asked = {
        "t": a.terms("kind", size=4, aggs=inner),
        "missing": a.terms("kind", size=20, missing="none", aggs={"m": a.percentiles("quantity"), "c": a.count("price")}),
        "r": a.ranges("price", spans, aggs={"s": a.sum_("quantity")}),
        "h": a.histogram("price", 10.0, hard_bounds=(15.0, 70.0), aggs={"u": a.cardinality("quantity")}),
        "q": a.terms("quantity"),
        "s": a.stats("price"),
        "p": a.percentiles("quantity"),
        "best": a.TopHits("price", 3),
    }
    for scope in (rows, rows.limit(0)):
        together = a.aggregate_rows(Index.in_memory(scope, mapping).docs, mapping, asked)
        assert {"metrics", "t", "t>r", "t>h", "missing", "r", "h", "q", "best"} == set(together)
        same = lambda x: sorted(map(str, x.collect()))
        for name, agg in asked.items():
            alone = a.aggregate_rows(Index.in_memory(scope, mapping).docs, mapping, {name: agg})
            for n, frame in alone.items():
                if n == "metrics":
                    assert same(together[n].select(*frame.columns)) == same(frame), name
                else:
                    assert together[n].columns == frame.columns and same(together[n]) == same(frame), n
        together.release()
    with a.aggregate(index, {n: asked[n] for n in ("t", "r", "h", "s")}) as found:
        assert len(found.shared) == 2  # the counts at the top, and those inside the terms
        counts = found.shared[0]._jdf.queryExecution().analyzed().toString()
        assert counts.count("Range (") == 1 and found["r"].count() == len(spans)
