"""Answers from summaries that a batch writes of its fields, merged over the batches of a version.

A summary of a field is its count, its extremes, and three sketches of fixed size, of quantiles, of distinct values and of
frequent ones. A query reads a row per batch and field, however many documents there are. Summaries know nothing of deletes: while a
version has any, these questions are refused, and the aggregations over documents answer them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.errors import AggregationError
from quillspark.sources.index import Index
from quillspark.sources.tables import DISTINCT_BITS, QUANTILE_SIZE, TRACKED

#: A value at a percent has a rank within this share of all of the percent's, with a chance of 99 in 100.
RANK_ERROR = 2.446 / QUANTILE_SIZE**0.9433
#: The standard error of a number of distinct values, as a share of it.
DISTINCT_ERROR = 1.04 / 2 ** (DISTINCT_BITS / 2)

#: A counted value occurs less often than said by at most this share of all values: 3.5 parts of the sketch's table, which is
#: the power of two that is three quarters full with ``TRACKED`` values.
COUNT_ERROR = 3.5 / 2 ** (TRACKED * 4 // 3 - 1).bit_length()


def _summaries(index: Index, field: str) -> DataFrame:
    if not index.field(field).summary:
        raise AggregationError(f"field {field} has no stored summary")
    if index.summaries is None:
        raise AggregationError("documents were deleted since summaries were stored; rewrite the index or aggregate its documents")
    return index.summaries.filter(F.col("field") == field)


def stored_stats(index: Index, field: str) -> DataFrame:
    """``count``, ``min`` and ``max`` of a field, exact; numbers, and dates as milliseconds."""
    return _summaries(index, field).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("count"), F.min("low").alias("min"), F.max("high").alias("max"))


def stored_percentiles(index: Index, field: str, percents: tuple[float, ...]) -> DataFrame:
    """``percent``, ``value`` and ``rank_error``; no values where the field has none."""
    if not index.field(field).numeric:
        raise AggregationError(f"field {field} has no numbers to aggregate")
    merged = _summaries(index, field).filter("quantiles is not null").agg(F.kll_merge_agg_double("quantiles", F.lit(QUANTILE_SIZE)).alias("s"), F.sum("n").alias("n"))
    at = [F.struct(F.lit(float(p)).alias("percent"), _quantile("s", p).alias("value")) for p in percents]
    rows = merged.filter("n > 0").select(F.inline(F.array(*at)))
    return rows.withColumn("rank_error", F.lit(RANK_ERROR))


def _quantile(sketch: str, percent: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(percent / 100.0))


def stored_cardinality(index: Index, field: str) -> DataFrame:
    """``value``, about how many distinct values a field has, and ``error``, the standard error of that as a share."""
    merged = _summaries(index, field).filter("distinct_values is not null").agg(F.hll_union_agg("distinct_values").alias("s"))
    return merged.select(F.coalesce(F.hll_sketch_estimate("s"), F.lit(0)).alias("value"), F.lit(DISTINCT_ERROR).alias("error"))


def stored_frequent(index: Index, field: str, size: int) -> DataFrame:
    """``key``, ``at_most`` and ``at_least``: at most ``size`` frequent values as texts, the most frequent first by ``at_most``.

    The exact count lies between the two. They differ by ``COUNT_ERROR`` of all values of the field, and a value that occurs
    over twice as often as that is found unless ``size`` others are. Dates are milliseconds. Counts of a field with few
    values are exact, and ``at_most`` tells them; the terms aggregation gives them for any field."""
    found = _summaries(index, field).filter("n > 0").groupBy("field").agg(F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("s"), F.sum("n").alias("n"))
    rows = found.select("n", F.expr(f"inline(approx_top_k_estimate(s, {int(size)}))"))
    error = F.ceil(F.col("n") * COUNT_ERROR)
    least = F.greatest(F.lit(1).cast("bigint"), F.col("count") - error)
    return rows.select(F.col("item").alias("key"), F.col("count").alias("at_most"), least.alias("at_least"))
