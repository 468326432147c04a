"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to length 1, so that the order by distance is the order by cosine. A table hashes a vector by a few
random projections, cut into slots; a bucket is a combination of slots. A query visits, in every table, its own bucket
and perturbed ones, in the order of their estimated success: the squared distances from its projections to the edges it
would cross. Buckets meet their queries in groups of about equal size; each group gives its best few per query, by exact
cosine, and these are merged.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.common import written

#: Rows of the index that one group holds, about; larger buckets are split among several groups.
GROUP_ROWS = 4096
#: About so many queries, at most, meet a group in one task.
ASKED_ROWS = 4096
#: Visits are listed for about so many queries in a task, by at most so many tasks.
PROBED_ROWS, MOST_TASKS = 64, 4096
#: Buckets that are split are at most so many; groups grow where there would be more.
MOST_SPLIT = 200_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """The defaults find over 0.9 of the 5 nearest even among unclustered vectors of 64 dimensions."""

    tables: int = 4
    projections: int = 6
    width: float = 1.5
    probes: int = 320
    seed: int = 11


class Hashing:
    """The projections of all tables."""

    def __init__(self, settings: Settings, dimension: int):
        rng = np.random.default_rng(settings.seed)
        self.settings = settings
        self.a = rng.standard_normal((settings.tables, dimension, settings.projections))
        self.b = rng.uniform(0, settings.width, (settings.tables, settings.projections))

    def positions(self, vectors: np.ndarray, table: int) -> np.ndarray:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return (unit @ self.a[table] + self.b[table]) / self.settings.width

    @staticmethod
    def codes(slots: np.ndarray) -> np.ndarray:
        """One 64-bit number for each row of slots."""
        code = np.zeros(len(slots), np.uint64)
        for column in slots.astype(np.int64).astype(np.uint64).T:
            code = (code ^ column) * _MULTIPLIER
            code ^= code >> np.uint64(29)
        return code.view(np.int64)

    def probes(self, position: np.ndarray) -> np.ndarray:
        """Codes of the buckets to visit for one query in one table, the most promising first."""
        own = np.floor(position)
        inside = position - own
        moves = [
            sorted([(0.0, 0), (x * x, -1), ((1 - x) ** 2, 1), ((1 + x) ** 2, -2), ((2 - x) ** 2, 2)]) for x in inside
        ]
        first = (0,) * len(moves)
        heap, seen, steps = [(0.0, first)], {first}, []
        while heap and len(steps) < self.settings.probes:
            cost, at = heapq.heappop(heap)
            steps.append([moves[m][i][1] for m, i in enumerate(at)])
            for m, i in enumerate(at):
                if i + 1 < len(moves[m]):
                    then = (*at[:m], i + 1, *at[m + 1 :])
                    if then not in seen:
                        seen.add(then)
                        heapq.heappush(heap, (cost - moves[m][i][0] + moves[m][i + 1][0], then))
        return self.codes(own + np.array(steps))


def usable(vector: str, dimension: int | None = None) -> Column:
    """Vectors that take part: no null, zero or non-finite ones, and of the index's dimension."""
    real = F.forall(vector, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    test = F.col(vector).isNotNull() & real & F.exists(vector, lambda x: x != 0)
    return F.coalesce(test if dimension is None else test & (F.size(vector) == dimension), F.lit(False))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """Rows of doubles, each times a power of two that brings its largest component near 1: directions and cosines are
    exactly the same, and no square is too large or too small for a double."""
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
    _, exponents = np.frexp(np.abs(rows).max(axis=1, keepdims=True, initial=0.0))
    return np.ldexp(rows, -exponents)


def exact_cosine(query: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """The cosine with each candidate; equal vectors give equal numbers, whatever stands beside them."""
    dots = (candidates * query).sum(axis=1)
    return dots / (np.sqrt((candidates * candidates).sum(axis=1)) * np.sqrt((query * query).sum()))


class Best:
    """The k nearest of each query so far."""

    def __init__(self, k: int, ids: np.ndarray, vectors: np.ndarray):
        self.k, self.ids, self.vectors = k, ids, vectors
        self.unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        self.found: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def see(self, queries: list[int], names: np.ndarray, vectors: np.ndarray, rows: np.ndarray) -> None:
        """Queries (places in ``names`` and ``vectors``) against rows of the group."""
        lengths = np.linalg.norm(vectors[queries], axis=1, keepdims=True)
        near = (vectors[queries] / lengths) @ self.unit[rows].T
        for place, about in zip(queries, near, strict=True):
            own = self.ids[rows] != names[place]
            candidates, about = rows[own], about[own]
            if len(candidates) > self.k:
                least = np.partition(about, len(about) - self.k)[len(about) - self.k]
                candidates = candidates[about >= least - 1e-9]  # rounding may not decide
            if not len(candidates):
                continue
            scores, ids = exact_cosine(vectors[place], self.vectors[candidates]), self.ids[candidates]
            if place in self.found:
                ids = np.concatenate([self.found[place][0], ids])
                scores = np.concatenate([self.found[place][1], scores])
            first = np.lexsort((ids, -scores))[: self.k]
            self.found[place] = ids[first], scores[first]

    def table(self, names: np.ndarray) -> pa.Table:
        sizes = [len(ids) for ids, _ in self.found.values()]
        none = np.zeros(0)
        return pa.table(
            {
                "query_id": pa.array(np.repeat(names[list(self.found)], sizes) if sizes else none.astype(np.int64), pa.int64()),
                "vec_id": pa.array(np.concatenate([none.astype(np.int64), *(i for i, _ in self.found.values())]), pa.int64()),
                "score": pa.array(np.concatenate([none, *(s for _, s in self.found.values())]), pa.float64()),
            }
        )


RESULT = "query_id long, vec_id long, score double"


def nearest(vectors: DataFrame, queries: DataFrame, k: int, id_col: str, vector_col: str, settings: Settings = Settings()) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score``: the ``k`` nearest found for each query, by cosine.

    Ids are whole numbers; a query's own id is no candidate. Ties go to the smaller id. Vectors that are null, zero, of
    another than the most frequent dimension, or hold null or non-finite components take no part, nor do null ids; very
    large and very small finite components do.
    Repeated ids count once, with their best score. A query that finds fewer than ``k`` is compared with all vectors.
    Empty tables give an empty one. Every vector is in every table; buckets are dealt to groups of about
    ``GROUP_ROWS`` rows, and buckets larger than that are split, so a vector that a third of all rows share is spread. Queries
    are dealt to parts of about ``ASKED_ROWS``, each of which meets a group in a task of its own."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).filter(F.col("id").isNotNull())
    asked = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).filter(F.col("id").isNotNull())
    by_size = rows.filter(usable("v")).groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
    most = by_size.orderBy(F.col("n").desc(), "d").limit(1).collect()
    if not most:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimension, n = most[0]["d"], most[0]["n"]
    rows, asked = rows.filter(usable("v", dimension)), asked.filter(usable("v", dimension)).dropDuplicates(["id"])
    hashing = Hashing(settings, dimension)
    group_rows = max(GROUP_ROWS, settings.tables * n // MOST_SPLIT)
    groups = max(1, -(-n // group_rows))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(1), dimension)
            for t in range(settings.tables):
                codes = hashing.codes(np.floor(hashing.positions(v, t)))
                at = pa.array(np.full(len(v), t), pa.int32())
                yield pa.RecordBatch.from_arrays([at, pa.array(codes), *batch.columns], names=["t", "code", "id", "v"])

    kind = vectors.schema[vector_col].dataType.simpleString()
    index = rows.mapInArrow(coded, f"t int, code long, id long, v {kind}")
    large = index.groupBy("t", "code").agg(F.count("*").alias("n")).filter(F.col("n") > group_rows).collect()
    split, next_group = {}, groups
    for r in sorted(large, key=lambda r: (r["t"], r["code"])):
        split[r["t"], r["code"]] = (next_group, -(-r["n"] // group_rows))
        next_group += split[r["t"], r["code"]][1]
    parts = spark.sparkContext.broadcast(split)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # each of one table
            t, codes, ids = (batch.column(i).to_numpy() for i in range(3))
            group = (codes.view(np.uint64) % np.uint64(groups)).astype(np.int64)
            for code in np.unique(codes) if parts.value else ():
                own = np.flatnonzero(codes == code)
                if (place := parts.value.get((int(t[own[0]]), int(code)))) is not None:
                    group[own] = place[0] + (Hashing.codes(ids[own][:, None]).view(np.uint64) % np.uint64(place[1])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(group), *batch.columns[1:]], names=["t", "g", "code", "id", "v"])

    def probing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(1), dimension)
            for t in range(settings.tables):
                positions = hashing.positions(v, t)
                row, group, codes = [], [], []
                for i in range(len(v)):
                    visits: dict[int, list[int]] = {}
                    for code in hashing.probes(positions[i]):
                        code = int(code)
                        first, count = parts.value.get((t, code), (int(np.int64(code).view(np.uint64)) % groups, 1))
                        for g in range(first, first + count):
                            visits.setdefault(g, []).append(code)
                    row += [i] * len(visits)
                    group += visits.keys()
                    codes += visits.values()
                taken = pa.array(row, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(row), t), pa.int32()),
                        pa.array(group, pa.int64()),
                        batch.column(0).take(taken),
                        batch.column(1).take(taken),
                        pa.array(codes, pa.list_(pa.int64())),
                    ],
                    names=["t", "g", "id", "v", "codes"],
                )

    def search(index: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(index) or not len(asked):
            return Best(k, np.zeros(0, np.int64), np.ones((0, dimension))).table(np.zeros(0, np.int64))
        index, asked = index.combine_chunks(), asked.combine_chunks()
        names = asked["id"].to_numpy()
        vectors = _matrix(asked["v"].combine_chunks(), dimension)
        best = Best(k, index["id"].to_numpy(), _matrix(index["v"].combine_chunks(), dimension))
        if "codes" not in asked.column_names:
            best.see(list(range(len(names))), names, vectors, np.arange(len(index)))
            return best.table(names)
        codes = index["code"].to_numpy()
        order = np.argsort(codes, kind="stable")
        edges = np.flatnonzero(np.diff(codes[order], prepend=codes[order[0]] ^ 1, append=codes[order[-1]] ^ 1))
        buckets = {int(codes[order[a]]): order[a:b] for a, b in zip(edges, edges[1:])}
        visitors: dict[int, list[int]] = {}
        for i, own in enumerate(asked["codes"].to_pylist()):
            for code in own:
                if code in buckets:
                    visitors.setdefault(code, []).append(i)
        for code, places in visitors.items():
            best.see(places, names, vectors, buckets[code])
        return best.table(names)

    dealt_index = index.mapInArrow(dealt, f"t int, g long, code long, id long, v {kind}")
    n_asked = asked.count()
    tasks = max(1, min(MOST_TASKS, -(-n_asked // PROBED_ROWS)))
    visits = asked.repartition(tasks, "id").mapInArrow(probing, f"t int, g long, id long, v {kind}, codes array<long>")
    asked_parts = max(1, -(-n_asked // ASKED_ROWS))
    part = F.pmod(F.xxhash64("id"), F.lit(asked_parts)).cast("int").alias("part")
    every_part = F.explode(F.sequence(F.lit(0), F.lit(asked_parts - 1))).alias("part")
    met = dealt_index.select("*", every_part).groupBy("t", "g", "part").cogroup(visits.select("*", part).groupBy("t", "g", "part"))
    found = met.applyInArrow(search, RESULT)
    found = written(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), "ann-found")
    enough = found.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= k)
    short = asked.join(enough, asked["id"] == enough["query_id"], "left_anti")
    if not short.isEmpty():
        block = F.pmod(F.xxhash64("id"), F.lit(groups))
        blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
        everywhere = short.select(blocks.alias("g"), part, "id", "v").groupBy("g", "part")
        whole = rows.select(block.alias("g"), every_part, "id", "v").groupBy("g", "part").cogroup(everywhere).applyInArrow(search, RESULT)
        found = found.union(whole).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
