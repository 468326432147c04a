"""Aggregations: A01 to A16."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.operators import aggs as a
from quillspark.plans import query as q
from quillspark.operators.stored import stored_cardinality, stored_frequent, stored_percentiles, stored_stats
from registry import corpora, query, sql


def _rounded(df, *names: str):
    return df.withColumns({n: F.round(F.col(n), 4) for n in names})


_RED = f"""WITH {sql.index_of("part", "p_partkey", "p_name")},
found AS (SELECT * FROM part WHERE p_partkey IN (SELECT doc_id FROM post WHERE term IN ('red')))"""


@query(
    "a01_scope",
    f"{_RED} SELECT count(p_retailprice) AS price_count, min(p_retailprice) AS price_min, max(p_retailprice) AS price_max FROM found",
)
def scope(spark, sf_dir):
    """Statistics of the documents a query matches."""
    found = a.aggregate(corpora.parts_index(spark, sf_dir), {"price": a.stats("p_retailprice")}, query="red", fields=("p_name",))
    return found["metrics"].select("price_count", "price_min", "price_max")


@query(
    "a02_terms",
    """SELECT key, doc_count, CAST((SELECT count(*) FROM part) - sum(doc_count) OVER () AS BIGINT) AS sum_other_doc_count FROM (
  SELECT p_brand AS key, count(*) AS doc_count FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)""",
)
def terms(spark, sf_dir):
    return a.aggregate(corpora.parts_index(spark, sf_dir), {"brand": a.terms("p_brand")})["brand"]


@query(
    "a02_terms_by_metric",
    """SELECT key, doc_count, price, CAST((SELECT count(*) FROM part) - sum(doc_count) OVER () AS BIGINT) AS sum_other_doc_count FROM (
  SELECT p_brand AS key, count(*) AS doc_count, max(p_retailprice) AS price FROM part GROUP BY 1 ORDER BY 3 ASC, 1 LIMIT 7)""",
)
def terms_by_metric(spark, sf_dir):
    by_price = a.terms("p_brand", size=7, order=("price", "asc"), aggs={"price": a.max_("p_retailprice")})
    return a.aggregate(corpora.parts_index(spark, sf_dir), {"brand": by_price})["brand"]


@query(
    "a02_terms_by_key",
    """SELECT key, doc_count, CAST((SELECT count(*) FROM events) - sum(doc_count) OVER () AS BIGINT) AS sum_other_doc_count FROM (
  SELECT user_id AS key, count(*) AS doc_count FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 5)""",
)
def terms_by_key(spark, sf_dir):
    return a.aggregate(corpora.events_index(spark, sf_dir), {"user": a.terms("user_id", size=5, order=("_key", "desc"))})["user"]


_STEP = 100.0


@query(
    "a03_histogram",
    f"""WITH b AS (SELECT CAST(floor(o_totalprice / {_STEP}) AS BIGINT) AS i, count(*) AS c FROM orders GROUP BY 1),
grid AS (SELECT unnest(range((SELECT min(i) FROM b), (SELECT max(i) FROM b) + 1)) AS i)
SELECT CAST(i * {_STEP} AS DOUBLE) AS key, coalesce(c, 0) AS doc_count FROM grid LEFT JOIN b USING (i)""",
)
def histogram(spark, sf_dir):
    """Equal steps, gaps included."""
    return a.aggregate(corpora.orders_index(spark, sf_dir), {"price": a.histogram("o_totalprice", _STEP)})["price"]


@query(
    "a03_histogram_min_count",
    """SELECT floor((o_totalprice - 50) / 1000) * 1000 + 50.0 AS key, count(*) AS doc_count FROM orders
WHERE o_totalprice BETWEEN 10000 AND 200000 GROUP BY 1 HAVING count(*) >= 3""",
)
def histogram_min_count(spark, sf_dir):
    asked = a.histogram("o_totalprice", 1000.0, min_doc_count=3, offset=50.0, hard_bounds=(10000, 200000))
    return a.aggregate(corpora.orders_index(spark, sf_dir), {"price": asked})["price"]


_FINE = 4.0


@query(
    "a03_histogram_of_many_buckets",
    f"""WITH b AS (SELECT CAST(floor(o_totalprice / {_FINE}) AS BIGINT) AS i, count(*) AS c FROM orders GROUP BY 1),
grid AS (SELECT unnest(range((SELECT min(i) FROM b), (SELECT max(i) FROM b) + 1)) AS i)
SELECT CAST(i * {_FINE} AS DOUBLE) AS key, coalesce(c, 0) AS doc_count FROM grid LEFT JOIN b USING (i)""",
)
def histogram_of_many_buckets(spark, sf_dir):
    """More empty buckets than one array should hold."""
    return a.aggregate(corpora.orders_index(spark, sf_dir), {"price": a.histogram("o_totalprice", _FINE)})["price"]


@query(
    "a04_range",
    """SELECT k AS key, count(o_orderkey) AS doc_count, round(avg(o_totalprice), 4) AS mean FROM
  (VALUES ('*-50000', -1e30, 50000.0), ('50000-150000', 50000.0, 150000.0), ('100000.5-200000', 100000.5, 200000.0),
    ('150000-*', 150000.0, 1e30), ('none', -10.0, 0.0)) r(k, lo, hi)
LEFT JOIN orders ON o_totalprice >= lo AND o_totalprice < hi GROUP BY k""",
)
def ranges(spark, sf_dir):
    """Custom and overlapping ranges, empty ones included."""
    spans = [
        {"to": 50000}, {"from": 50000, "to": 150000}, {"from": 100000.5, "to": 200000}, {"from": 150000},
        {"from": -10, "to": 0, "key": "none"},
    ]
    asked = a.ranges("o_totalprice", spans, aggs={"mean": a.avg("o_totalprice")})
    return _rounded(a.aggregate(corpora.orders_index(spark, sf_dir), {"price": asked})["price"], "mean")


def _dates(unit_ms: int, table: str, column: str) -> str:
    return f"""WITH b AS (SELECT CAST(floor(epoch(date_trunc('second', {column})) * 1000 / {unit_ms}) AS BIGINT) AS i, count(*) AS c
  FROM {table} GROUP BY 1),
grid AS (SELECT unnest(range((SELECT min(i) FROM b), (SELECT max(i) FROM b) + 1)) AS i)
SELECT i * {unit_ms} AS key, strftime(make_timestamp(i * {unit_ms} * 1000), '%Y-%m-%dT%H:%M:%SZ') AS key_as_string,
  coalesce(c, 0) AS doc_count FROM grid LEFT JOIN b USING (i)"""


@query("a05_date_histogram", _dates(86_400_000, "orders", "o_orderdate"))
def date_histogram(spark, sf_dir):
    return a.aggregate(corpora.orders_index(spark, sf_dir), {"day": a.date_histogram("o_orderdate", "1d")})["day"]


@query("a05_date_histogram_30m", _dates(1_800_000, "events", "ts"))
def date_histogram_minutes(spark, sf_dir):
    return a.aggregate(corpora.events_index(spark, sf_dir), {"time": a.date_histogram("ts", "30m")})["time"]


@query(
    "a05_date_histogram_shifted",
    """WITH b AS (SELECT CAST(floor((epoch(date_trunc('second', o_orderdate)) - 21600) / 864000) AS BIGINT) AS i, count(*) AS c
  FROM orders WHERE epoch(date_trunc('second', o_orderdate)) BETWEEN 725846400 AND 820454400 GROUP BY 1),
grid AS (SELECT unnest(range(least((SELECT min(i) FROM b), CAST(floor((694224000 - 21600) / 864000) AS BIGINT)),
  greatest((SELECT max(i) FROM b), CAST(floor((883612800 - 21600) / 864000) AS BIGINT)) + 1)) AS i)
SELECT i * 864000000 + 21600000 AS key, strftime(make_timestamp((i * 864000000 + 21600000) * 1000), '%Y-%m-%dT%H:%M:%SZ') AS key_as_string,
  coalesce(c, 0) AS doc_count FROM grid LEFT JOIN b USING (i)""",
)
def date_histogram_shifted(spark, sf_dir):
    """Steps of ten days from six o'clock, over some years, with empty ones outside them."""
    asked = a.date_histogram(
        "o_orderdate", "10d", offset="6h", hard_bounds=(725_846_400_000, 820_454_400_000),
        extended_bounds=(694_224_000_000, 883_612_800_000),
    )
    return a.aggregate(corpora.orders_index(spark, sf_dir), {"day": asked})["day"]


def _one_metric(name: str, metric, sql_value: str):
    @query(name, f"SELECT round({sql_value}, 4) AS m FROM events")
    def run(spark, sf_dir):
        found = a.aggregate(corpora.events_index(spark, sf_dir), {"m": metric})["metrics"]
        return _rounded(found, "m")

    return run


_one_metric("a06_avg", a.avg("value"), "avg(value)")
_one_metric("a07_min", a.min_("value"), "min(value)")
_one_metric("a08_max", a.max_("value"), "max(value)")
_one_metric("a09_sum", a.sum_("value"), "sum(value)")


@query("a10_value_count", "SELECT count(value) AS m FROM events")
def value_count(spark, sf_dir):
    return a.aggregate(corpora.events_index(spark, sf_dir), {"m": a.count("value")})["metrics"]


@query("a09_sum_of_nothing", "SELECT CAST(0 AS DOUBLE) AS m")
def sum_of_nothing(spark, sf_dir):
    """The sum over no documents is zero."""
    nothing = q.Term("event_type", "no such type")
    return a.aggregate(corpora.events_index(spark, sf_dir), {"m": a.sum_("value")}, query=nothing)["metrics"]


@query(
    "a11_stats",
    """SELECT count(o_totalprice) AS s_count, min(o_totalprice) AS s_min, max(o_totalprice) AS s_max,
  round(avg(o_totalprice), 4) AS s_avg, round(sum(o_totalprice), 2) AS s_sum FROM orders""",
)
def stats(spark, sf_dir):
    found = a.aggregate(corpora.orders_index(spark, sf_dir), {"s": a.stats("o_totalprice")})["metrics"]
    return _rounded(found, "s_avg").withColumn("s_sum", F.round("s_sum", 2))


_PERCENTS = ", ".join(str(p) for p in a.PERCENTS)


@query(
    "a12_percentiles",
    f"""SELECT CAST(p AS DOUBLE) AS percent,
  list_sort(list(value))[CAST(greatest(ceil(round(p / 100.0 * count(*), 9)), 1) AS BIGINT)] AS value
FROM (SELECT unnest([{_PERCENTS}]) AS p) ps, events GROUP BY p""",
)
def percentiles(spark, sf_dir):
    """The value at each rank; at this accuracy the rank is off by at most one in a million."""
    metric = a.percentiles("value", accuracy=1_000_000)
    found = a.aggregate(corpora.events_index(spark, sf_dir), {"p": metric})["metrics"]
    return a.percentile_rows(found, "p", metric)


@query(
    "a11_stored_stats",
    """SELECT 'value' AS field, count(value) AS count, min(value) AS min, max(value) AS max FROM events
UNION ALL SELECT 'user_id', count(user_id), CAST(min(user_id) AS DOUBLE), CAST(max(user_id) AS DOUBLE) FROM events
UNION ALL SELECT 'ts', count(ts), CAST(min(epoch_ms(date_trunc('second', ts))) AS DOUBLE), CAST(max(epoch_ms(date_trunc('second', ts))) AS DOUBLE) FROM events""",
)
def stats_from_summaries(spark, sf_dir):
    """Counts and extremes of two batches, from their summaries alone."""
    index = corpora.measures_index(spark, sf_dir)
    value, user, ts = (stored_stats(index, n).withColumn("field", F.lit(n)) for n in ("value", "user_id", "ts"))
    return value.unionByName(user).unionByName(ts)


@query("a12_stored_percentiles")
def percentiles_from_summaries(spark, sf_dir):
    """By merged sketches, so the error is tested rather than the value."""
    return stored_percentiles(corpora.measures_index(spark, sf_dir), "value", a.PERCENTS)


@query(
    "a02_stored_frequent",
    """SELECT event_type AS key, count(*) AS at_most, greatest(1, count(*) - CAST(ceil((SELECT count(event_type) FROM events) * 3.5 / 16384) AS BIGINT)) AS at_least
FROM events WHERE event_type IS NOT NULL GROUP BY 1""",
)
def frequent_from_summaries(spark, sf_dir):
    """The values of a field with few of them, by merged sketches: their counts are exact, their bounds those of the sketch."""
    return stored_frequent(corpora.measures_index(spark, sf_dir), "event_type", 1000)


@query("a16_stored_cardinality")
def cardinality_from_summaries(spark, sf_dir):
    """By merged sketches, so the error is tested rather than the value."""
    index = corpora.measures_index(spark, sf_dir)
    users, kinds = (stored_cardinality(index, n).withColumn("field", F.lit(n)) for n in ("user_id", "event_type"))
    return users.unionByName(kinds)


@query(
    "a13_several_at_once",
    """SELECT count(value) AS n, round(avg(value), 4) AS mean, min(user_id) AS low_user, max(value) AS top,
  count(*) FILTER (WHERE value >= 20) AS big FROM events""",
)
def several(spark, sf_dir):
    """Several metrics share one pass."""
    asked = {"n": a.count("value"), "mean": a.avg("value"), "low_user": a.min_("user_id"), "top": a.max_("value"), "big": a.sum_("big")}
    return _rounded(a.aggregate(corpora.events_index(spark, sf_dir), asked)["metrics"], "mean")


_FOUND = """found AS (SELECT * FROM part WHERE p_partkey IN (SELECT doc_id FROM post WHERE term IN ('red', 'bolt')))"""


@query(
    "a13_several_buckets_of_a_query",
    f"""WITH {sql.index_of("part", "p_partkey", "p_name")}, {_FOUND},
brand AS (SELECT p_brand AS key, count(*) AS n FROM found GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 4),
size AS (SELECT floor(p_size / 10.0) * 10 AS key, count(*) AS n FROM found GROUP BY 1)
SELECT 'brand' AS of, key, n FROM brand UNION ALL SELECT 'size', CAST(CAST(key AS BIGINT) AS VARCHAR), n FROM size
UNION ALL SELECT 'all', 'n', count(p_size) FROM found""",
)
def several_buckets(spark, sf_dir):
    """Two bucket aggregations and a metric over one query, in one request."""
    asked = {
        "brand": a.terms("p_brand", size=4), "size": a.histogram("p_size", 10.0, min_doc_count=1), "n": a.count("p_size")
    }
    found = a.aggregate(corpora.parts_index(spark, sf_dir), asked, query="red bolt", fields=("p_name",))
    part = lambda rows, of, key, n: rows.select(F.lit(of).alias("of"), key.alias("key"), F.col(n).alias("n"))
    rows = part(found["brand"], "brand", F.col("key"), "doc_count")
    rows = rows.unionByName(part(found["size"], "size", F.col("key").cast("bigint").cast("string"), "doc_count"))
    return rows.unionByName(part(found["metrics"], "all", F.lit("n"), "n"))


@query(
    "a14_metrics_in_buckets",
    """SELECT event_type AS key, count(*) AS doc_count, round(avg(value), 4) AS mean, max(value) AS top,
  CAST(0 AS BIGINT) AS sum_other_doc_count FROM events GROUP BY 1""",
)
def metrics_in_buckets(spark, sf_dir):
    asked = a.terms("event_type", aggs={"mean": a.avg("value"), "top": a.max_("value")})
    return _rounded(a.aggregate(corpora.events_index(spark, sf_dir), {"type": asked})["type"], "mean")


@query(
    "a15_buckets_in_buckets",
    """WITH g AS (SELECT p_type AS type, p_brand AS key, count(*) AS doc_count, min(p_retailprice) AS low FROM part GROUP BY 1, 2),
outer_top AS (SELECT p_type AS type FROM part GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3),
r AS (SELECT *, row_number() OVER (PARTITION BY type ORDER BY doc_count DESC, key) AS rn FROM g JOIN outer_top USING (type))
SELECT type, key, doc_count, low FROM r WHERE rn <= 4""",
)
def nested(spark, sf_dir):
    inner = a.terms("p_brand", size=4, aggs={"low": a.min_("p_retailprice")})
    asked = a.terms("p_type", size=3, aggs={"brand": inner})
    return a.aggregate(corpora.parts_index(spark, sf_dir), {"type": asked})["type>brand"]


@query(
    "a15_three_levels",
    """WITH b AS (SELECT p_type AS type, CAST(floor(p_size / 10.0) AS BIGINT) AS i,
  CASE WHEN p_retailprice < 950 THEN '*-950' ELSE '950-*' END AS k FROM part),
ends AS (SELECT type, i, count(*) AS n FROM b GROUP BY 1, 2),
grid AS (SELECT type, i, k FROM ends, (VALUES ('*-950'), ('950-*')) v(k))
SELECT grid.type, CAST(grid.i * 10 AS DOUBLE) AS size, grid.k AS key, count(b.type) AS doc_count
FROM grid LEFT JOIN b ON b.type = grid.type AND b.i = grid.i AND b.k = grid.k GROUP BY 1, 2, 3""",
)
def three_levels(spark, sf_dir):
    """Ranges inside a histogram inside terms."""
    price = a.ranges("p_retailprice", [{"to": 950}, {"from": 950}])
    asked = a.terms("p_type", aggs={"size": a.histogram("p_size", 10.0, aggs={"price": price})})
    found = a.aggregate(corpora.parts_index(spark, sf_dir), {"type": asked})
    return found["type>size>price"]


@query(
    "a16_extended_stats",
    """SELECT round(sum(value * value), 2) AS e_sum_of_squares, round(var_pop(value), 4) AS e_variance_population,
  round(var_samp(value), 4) AS e_variance_sampling, round(stddev_pop(value), 4) AS e_std_deviation_population,
  round(stddev_samp(value), 4) AS e_std_deviation_sampling FROM events""",
)
def extended(spark, sf_dir):
    found = a.aggregate(corpora.events_index(spark, sf_dir), {"e": a.extended_stats("value")})["metrics"]
    parts = ["e_variance_population", "e_variance_sampling", "e_std_deviation_population", "e_std_deviation_sampling"]
    return _rounded(found, *parts).select(F.round("e_sum_of_squares", 2).alias("e_sum_of_squares"), *parts)


@query("a16_cardinality", "SELECT count(DISTINCT user_id) AS users FROM events")
def cardinality(spark, sf_dir):
    return a.aggregate(corpora.events_index(spark, sf_dir), {"users": a.cardinality("user_id", exact=True)})["metrics"]


@query("a16_cardinality_sketch")
def cardinality_sketch(spark, sf_dir):
    """A sketch, so its error is tested rather than its value."""
    return a.aggregate(corpora.events_index(spark, sf_dir), {"users": a.cardinality("user_id")})["metrics"]


@query(
    "a16_top_hits",
    """SELECT event_type AS type, event_id, value, CAST(rn AS INTEGER) AS position FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rn FROM events) WHERE rn <= 3""",
)
def top_hits(spark, sf_dir):
    asked = a.terms("event_type", aggs={"best": a.TopHits("value", size=3)})
    return a.aggregate(corpora.events_index(spark, sf_dir), {"type": asked})["type>best"]


@query(
    "a16_extended_bounds",
    """WITH b AS (SELECT CAST(floor(p_size / 10.0) AS BIGINT) AS i, count(*) AS c, sum(p_size) AS s FROM part GROUP BY 1)
SELECT CAST(i * 10 AS DOUBLE) AS key, coalesce(c, 0) AS doc_count, CAST(coalesce(s, 0) AS BIGINT) AS total
FROM (SELECT unnest(range(-2, 9)) AS i) LEFT JOIN b USING (i)""",
)
def extended_bounds(spark, sf_dir):
    asked = a.histogram("p_size", 10.0, extended_bounds=(-20, 80), aggs={"total": a.sum_("p_size")})
    return a.aggregate(corpora.parts_index(spark, sf_dir), {"size": asked})["size"]


@query(
    "a16_terms_missing",
    """SELECT coalesce(flag, 'none') AS key, count(*) AS doc_count, CAST(0 AS BIGINT) AS sum_other_doc_count
FROM (SELECT CASE WHEN p_size < 20 THEN p_type END AS flag FROM part) GROUP BY 1""",
)
def terms_missing(spark, sf_dir):
    """Documents without the field count under a stand-in value."""
    index = corpora.parts_index(spark, sf_dir)
    rows = index.docs.withColumn("p_type", F.when(F.col("p_size") < 20, F.col("p_type")))
    return a.aggregate_rows(rows, index.mapping, {"type": a.terms("p_type", missing="none")})["type"]


@query(
    "a16_metric_missing",
    """SELECT round(avg(coalesce(v, -5.0)), 4) AS mean, round(sum(coalesce(v, 2)), 2) AS total, min(coalesce(v, 7)) AS low
FROM (SELECT CASE WHEN p_size < 20 THEN p_retailprice END AS v FROM part)""",
)
def metric_missing(spark, sf_dir):
    """Documents without the field take part with a stand-in value."""
    index = corpora.parts_index(spark, sf_dir)
    rows = index.docs.withColumn("p_retailprice", F.when(F.col("p_size") < 20, F.col("p_retailprice")))
    price = "p_retailprice"
    asked = {"mean": a.avg(price, missing=-5.0), "total": a.sum_(price, missing=2.0), "low": a.min_(price, missing=7.0)}
    found = _rounded(a.aggregate_rows(rows, index.mapping, asked)["metrics"], "mean")
    return found.withColumn("total", F.round("total", 2))


@query(
    "a16_terms_min_count",
    """SELECT key, doc_count, CAST((SELECT count(*) FROM part) - sum(doc_count) OVER () AS BIGINT) AS sum_other_doc_count FROM (
  SELECT CAST(p_size AS BIGINT) AS key, count(*) AS doc_count FROM part GROUP BY 1 HAVING count(*) >= (SELECT count(*) // 40 FROM part))""",
)
def terms_min_count(spark, sf_dir):
    """Only buckets with enough documents."""
    index = corpora.parts_index(spark, sf_dir)
    asked = a.terms("p_size", size=1000, min_doc_count=index.n_docs // 40)
    return a.aggregate(index, {"size": asked})["size"]


@query(
    "a16_top_hits_of_all",
    """SELECT event_id, event_type, value, user_id, CAST(rn AS INTEGER) AS position FROM (
  SELECT *, row_number() OVER (ORDER BY event_type ASC, value DESC, event_id) AS rn FROM events) WHERE rn <= 20""",
)
def top_hits_of_all(spark, sf_dir):
    """The first documents of all, by two fields."""
    asked = a.TopHits((("event_type", "asc"), ("value", "desc")), size=20, show=("user_id",))
    return a.aggregate(corpora.events_index(spark, sf_dir), {"best": asked})["best"]
