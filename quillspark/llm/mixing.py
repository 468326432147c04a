"""Mixing sources to target weights.

Targets share a budget by weight, none above a multiple of its source. Within a source, documents are counted by exact
size; whole passes over the source come first, then the same share of every size, and what remains of the budget is
fitted by a bounded knapsack over the sizes left. Which documents of a size are taken follows a seeded order.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.common import written

#: Parts into which the documents of one source and size are dealt to be numbered.
SALTS = 64


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """One row per source (``key``, ``source``, ``source_size``, ``target``) from rows (``key``, ``source``, ``size``).

    Sources by code point, null last, weigh ``weights``, repeating. They share ``share`` times all sizes by weight; a
    target stops at ``most`` times its source, and the excess is shared again, until none is above: that is the level at
    which the capped targets use up the budget, found by one running sum over sources in the order in which they reach
    their cap. Sources are few rows beside documents, and only they meet in one window."""
    by_source = sizes.groupBy("key", "source").agg(F.sum("size").cast("double").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    n = F.row_number().over(order) - 1
    weighed = by_source.withColumn("weight", F.get(cycle, F.pmod(n, F.lit(len(weights)))))
    weighed = weighed.withColumn("cap", F.col("source_size") * most)
    filling = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = W.partitionBy()
    before = filling.rowsBetween(W.unboundedPreceding, -1)
    budget = F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # The level rises while the next source is capped and falls after that: its peak is the level of all.
    levels = weighed.withColumn("level", F.greatest(budget, F.lit(0.0)) / weight_left)
    target = F.least(F.col("cap"), F.col("weight") * F.max("level").over(everything))
    return levels.select("key", "source", F.col("source_size").cast("long").alias("source_size"), target.alias("target"))


def fit(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many of each size to take so that the sum comes as near to ``budget`` as sizes allow; bounded subset sums.

    Every size first gives its even share. What remains is less than the sum of the sizes; the largest sizes that fit
    shrink it below twice the largest size, and a bounded knapsack over the documents left fits the rest."""
    total = sum(s * n for s, n in counts.items())
    if budget <= 0 or not total:
        return {}
    if budget >= total:
        return dict(counts)
    take = {s: n * budget // total for s, n in counts.items()}
    rest = budget - sum(s * n for s, n in take.items())
    largest = max(counts)
    by_size = sorted((s for s in counts if s > 0), reverse=True)
    for s in by_size:
        if rest <= 2 * largest:
            break
        more = min(counts[s] - take[s], (rest - largest) // s)
        if more > 0:
            take[s] += more
            rest -= more * s
    for s, n in best_sum({s: counts[s] - take[s] for s in by_size if counts[s] > take[s]}, rest).items():
        take[s] += n
    return take


def best_sum(counts: dict[int, int], budget: int) -> dict[int, int]:
    """A bounded knapsack: how many of each size give the largest sum up to ``budget``. Sums that can be reached are
    bits of one number; multiples are split into powers of two, and the bits after each step lead the way back."""
    reached, steps = 1, []
    mask = (1 << (budget + 1)) - 1
    for s in sorted(counts, reverse=True):
        left, part = min(counts[s], budget // s if s else 0), 1
        while left > 0:
            n = min(part, left)
            grown = (reached | reached << s * n) & mask
            if grown != reached:
                steps.append((s, n, reached))
                reached = grown
            left -= n
            part *= 2
        if reached >> budget & 1:
            break
    at, out = reached.bit_length() - 1, {}
    for s, n, before in reversed(steps):
        if not before >> at & 1:
            out[s] = out.get(s, 0) + n
            at -= s * n
    return out


def mix(
    docs: DataFrame,
    size: Column,
    source: Column,
    order: Column,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: int = 17,
) -> DataFrame:
    """Rows of ``docs`` as ``doc`` (a struct of all columns) with ``size``, ``source_size``, ``target`` and ``copies``, how
    often the mix takes the row: 0 to ``most``.

    ``order`` names the row in the seeded order (an id); rows equal in it are taken in any order, which gives the same
    numbers by size. A null source is a source of its own; a null size counts 0 and such rows are never taken. Empty
    table: empty. The seeded order is kept in parts of each (source, size), so that no group meets in one task; the
    histogram of one source, a row per size, is fitted in one task."""
    rows = docs.select(
        F.struct(*docs.columns).alias("doc"),
        source.cast("string").alias("source"),
        F.coalesce(size.cast("long"), F.lit(0)).cast("long").alias("size"),
        F.coalesce(order.cast("string"), F.lit("")).alias("name"),
    )
    rows = rows.withColumn("key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")))
    rows = rows.withColumn("draw", F.xxhash64(F.lit(seed), "name")).withColumn("part", F.pmod("draw", F.lit(SALTS)).cast("int"))
    sizes = written(rows.select("key", "source", "size", "part"), "mix-sizes")  # without the documents themselves
    counted = sizes.groupBy("key", "size", "part").agg(F.count("*").alias("n"))
    wanted = targets(sizes, weights, share, most)

    def choose(histogram: pa.Table) -> pa.Table:
        pairs = zip(histogram["size"].to_pylist(), histogram["n"].to_pylist(), strict=True)
        counts = {s: n for s, n in pairs if s > 0}
        total, target = sum(s * n for s, n in counts.items()), histogram["target"][0].as_py()
        passes = min(most, int(target // total)) if total else 0
        extra = fit(counts, round(target) - passes * total) if passes < most else {}
        columns = ([histogram["key"][0].as_py()] * len(counts), list(counts), [passes] * len(counts), [extra.get(s, 0) for s in counts])
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "size", "passes", "extra"])

    histogram = counted.groupBy("key", "size").agg(F.sum("n").alias("n")).join(wanted, "key")
    chosen = histogram.groupBy("key").applyInArrow(choose, "key string, size long, passes int, extra long")
    earlier = W.partitionBy("key", "size").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = counted.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    plan = parts.join(chosen, ["key", "size"], "left").join(wanted.drop("source"), "key")
    first = F.greatest(F.coalesce("extra", F.lit(0)) - F.col("earlier"), F.lit(0))
    plan = plan.select("key", "size", "part", "source_size", "target", F.coalesce("passes", F.lit(0)).alias("passes"), first.alias("first"))
    numbered = rows.withColumn("rank", F.row_number().over(W.partitionBy("key", "size", "part").orderBy("draw", "name")))
    copies = F.col("passes") + F.when(F.col("rank") <= F.col("first"), 1).otherwise(0)
    return numbered.join(plan, ["key", "size", "part"]).select(
        "doc", "size", "source_size", "target", copies.cast("int").alias("copies")
    )


def taken(docs: DataFrame, size: Column, source: Column, order: Column, **settings) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; the columns stay."""
    chosen = mix(docs, size, source, order, **settings).filter("copies > 0")
    return chosen.select(F.explode(F.sequence(F.lit(1), "copies")).alias("copy"), "doc").select("doc.*")
