"""The best documents of many queries, block of documents by block.

Postings of the words that are asked for are dealt to blocks of documents once, however many queries have a word. A block
meets the queries, adds up its documents' scores for one query at a time, and gives its best ``k`` of each: what is
shuffled grows with postings, never with queries times documents.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions import scoring
from quillspark.plans.compile import BROADCAST_KEYS
from quillspark.sources import tables
from quillspark.sources.index import Index

#: A block has about so many postings and positions, and about so many documents, at most.
BLOCK_ROWS, BLOCK_DOCS = 1 << 19, 1 << 16
#: About so many words of queries, at most, meet a block in one task.
ASKED_WORDS = 1 << 16
# Room for rounding when a bound is compared with a score.
MARGIN = 2 * 10.0**-scoring.SCORE_DIGITS

_PLACE = 1 << 32


def best_in_blocks(
    index: Index, words: DataFrame, chunks: DataFrame | None, query_id: str, k: int, keep: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``(query_id, key, score)``: of every query the best ``k`` documents of every block, by all its words and phrases.

    ``words`` has ``query_id``, ``field``, ``term``, ``weight``, ``avgdl`` and ``optional``, words that bring in no document
    by themselves. ``chunks`` has the parts of each phrase: its place in the query (``of_field``, ``chunk``), ``field``,
    ``term``, ``pos``, ``gain`` and ``avgdl``."""
    key = index.mapping.key
    found = words.select(query_id, "field", "term", F.lit(False).alias("_placed"))
    if chunks is not None:
        found = found.unionByName(chunks.select(query_id, "field", "term", (F.col("parts") > 1).alias("_placed")))
    parts = max(1, -(-found.count() // ASKED_WORDS))
    part = F.pmod(F.xxhash64(query_id), F.lit(parts)).cast("int").alias("_part")
    named = found.groupBy(part, "field", "term").agg(F.max("_placed").alias("_placed"))
    named = named.withColumn("_word", F.row_number().over(Window.partitionBy("_part").orderBy("field", "term")))
    on = ["field", "term"]
    if index.term_buckets:
        named, on = named.withColumn("term_bucket", tables.bucket_of(F.col("term"), index.term_buckets)), [*on, "term_bucket"]
    named = keep(named.join(index.statistics.select(*on, "df", "cf"), on))
    counts = named.agg(F.count(F.lit(1)), F.sum("df"), F.sum(F.when(F.col("_placed"), F.col("cf")))).first()
    blocks = max(1, -(-((counts[1] or 0) + (counts[2] or 0)) // BLOCK_ROWS), -(-index.n_docs // BLOCK_DOCS))

    number = named.select("_part", "field", "term", "_word")
    single = words.select(part, "*").join(number, ["_part", "field", "term"])
    unit = lambda words, places, weight: F.struct(
        words.alias("words"), places.alias("places"), F.col(weight).alias("weight"), F.col("avgdl").alias("avgdl"), F.col("optional").alias("optional")
    )
    units = single.select("_part", query_id, unit(F.array("_word"), F.array(F.lit(0)), "weight").alias("_unit"))
    if chunks is not None:
        placed = chunks.select(part, "*").join(number, ["_part", "field", "term"])
        whole = placed.groupBy("_part", query_id, "of_field", "chunk").agg(
            F.sort_array(F.collect_list(F.struct("pos", "_word"))).alias("_at"), *[F.first(c).alias(c) for c in ("parts", "gain", "avgdl")]
        )
        whole = whole.filter(F.size("_at") == F.col("parts")).withColumn("optional", F.lit(False))
        phrase = unit(F.col("_at")["_word"], F.col("_at")["pos"], "gain")
        units = units.unionByName(whole.select("_part", query_id, phrase.alias("_unit")))
    asked = units.groupBy("_part", query_id).agg(F.collect_list("_unit").alias("_units"))
    asked = asked.select("_part", F.col(query_id).alias("_query"), "_units", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"))

    known = F.broadcast(named) if counts[0] <= BROADCAST_KEYS else named
    postings = _postings_of(index, named).join(known.select(*on, "_part", "_word", "_placed"), on)
    dealt = postings.select(
        F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("_block"), "_part", "_word", F.col(key).alias("_key"), "tf", "dl",
        F.when(F.col("_placed"), F.col("positions")).alias("_at"),
    )
    schema = T.StructType(
        [T.StructField(query_id, asked.schema["_query"].dataType), T.StructField(key, dealt.schema["_key"].dataType), T.StructField("score", T.DoubleType())]
    )
    place = ["_block", "_part"]
    return dealt.groupBy(*place).cogroup(asked.groupBy(*place)).applyInArrow(_best_of_block(k, [query_id, key, "score"]), schema)


def _postings_of(index: Index, named: DataFrame) -> DataFrame:
    """The postings of the directories the words live in: at most one row per directory comes back to plan with."""
    if not index.term_buckets:
        return index.everything
    places = named.select("field", "term_bucket").distinct().collect()
    return index.everything.filter(
        F.col("field").isin({r["field"] for r in places}) & F.col("term_bucket").isin({r["term_bucket"] for r in places})
    )


class _Block:
    """The postings of one block, by word and then by document."""

    def __init__(self, rows: pa.Table):
        keys = rows["_key"].combine_chunks().dictionary_encode(null_encoding="encode")
        self.keys = keys.dictionary
        docs, words = keys.indices.to_numpy().astype(np.int64), rows["_word"].to_numpy()
        order = np.lexsort((docs, words))
        self.docs, words = docs[order], words[order]
        self.tf, self.dl = (rows[c].to_numpy()[order].astype(np.float64) for c in ("tf", "dl"))
        starts = np.flatnonzero(np.r_[True, words[1:] != words[:-1]]) if len(words) else np.zeros(0, np.int64)
        ends = np.r_[starts[1:], len(words)]
        self.runs = {int(words[a]): slice(int(a), int(b)) for a, b in zip(starts, ends)}
        at = rows["_at"].combine_chunks().take(pa.array(order))
        sizes = at.value_lengths().fill_null(0).to_numpy()
        self.places = np.repeat(self.docs, sizes) * _PLACE + at.flatten().to_numpy()
        self.bounds = np.r_[0, np.cumsum(sizes)]
        self.known: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}

    def _starts(self, word: int, place: int) -> np.ndarray:
        run = self.runs[word]
        return self.places[self.bounds[run.start] : self.bounds[run.stop]] - place

    def gains(self, words: tuple[int, ...], places: tuple[int, ...], avgdl: float) -> tuple[np.ndarray, np.ndarray]:
        """The documents that have a word, or words side by side, and how much of its weight it adds to each."""
        asked = (words, places, avgdl)
        if asked not in self.known:
            self.known[asked] = self._gains(*asked)
        return self.known[asked]

    def _gains(self, words, places, avgdl):
        if any(w not in self.runs for w in words):
            return np.zeros(0, np.int64), np.zeros(0)
        run = self.runs[words[0]]
        docs, tf, dl = self.docs[run], self.tf[run], self.dl[run]
        if len(words) > 1:
            sets = sorted((self._starts(w, p) for w, p in zip(words, places)), key=len)
            common = sets[0]
            for other in sets[1:]:
                at = np.searchsorted(other, common)
                at[at == len(other)] = 0
                common = common[other[at] == common]
            # A document's first word is before all its places, so the division finds the document.
            hits, tf = np.unique((common + places[0]) // _PLACE, return_counts=True)
            dl = dl[np.searchsorted(docs, hits)]
            docs = hits
        length = (1.0 - scoring.B) + scoring.B * dl / avgdl
        return docs, (scoring.K1 + 1.0) * tf / (tf + scoring.K1 * length)


def _best_of_block(k: int, names: list[str]):
    def best(postings: pa.Table, asked: pa.Table) -> pa.Table:
        block = _Block(postings)
        asked_by, rows, scores = [], [], []
        for i, units in enumerate(asked["_units"].to_pylist()):
            total = np.zeros(len(block.keys))
            for late in (False, True):
                mine = [u for u in units if u["optional"] == late]
                reached = total > 0 if late and mine else None
                for u in mine:
                    docs, norm = block.gains(tuple(u["words"]), tuple(u["places"]), u["avgdl"])
                    gain = u["weight"] * norm
                    if reached is not None:
                        docs, gain = docs[reached[docs]], gain[reached[docs]]
                    np.add.at(total, docs, gain)
            found = first(block.keys, total, k)
            asked_by.append(np.full(len(found), i))
            rows.append(found)
            scores.append(total[found])
        whole = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        columns = [asked["_query"].combine_chunks().take(pa.array(whole(asked_by))), block.keys.take(pa.array(whole(rows)))]
        return pa.table(dict(zip(names, [*columns, pa.array(whole(scores), pa.float64())])))

    return best


def first(keys: pa.Array, scores: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` best of the documents with a score, by rounded score and then by key."""
    found = np.flatnonzero(scores > 0)
    if len(found) <= k or not k:
        return found[: max(k, 0)]
    own = scores[found]
    found = found[own >= np.partition(own, -k)[-k] - MARGIN]
    if len(found) <= k:
        return found
    digits = Decimal(1).scaleb(-scoring.SCORE_DIGITS)
    values, which = np.unique(scores[found], return_inverse=True)
    shown = [Decimal(repr(float(v))).quantize(digits, ROUND_HALF_UP) for v in values]
    listed = zip(found, which, keys.take(pa.array(found)).to_pylist())
    order = sorted(((-shown[w], key is not None, key), at) for at, w, key in listed)
    return np.array([at for _, at in order[:k]])
