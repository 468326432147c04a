"""Best-two-fit packing of documents into sequences of a fixed length.

Lengths are at most the sequence length, so their counts are a small table whatever the corpus is. The packing is done
on that table: a bin is filled greedily, each time with the longest document that fits; then its smallest document
gives way to two that fill the widened gap more tightly. The same filling is repeated as often as the counts allow, so
the plan is a short list of patterns with multiplicities. Documents then take their places by their rank within their
length, in parallel.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.common import shipped_file, text_of, written
from quillspark.llm.tokens import ids_of

#: Rows in one batch: bounds the memory of a worker.
BATCH_ROWS = 256
#: Parts into which the pieces of one length are dealt to be numbered.
SALTS = 64


def pieces(
    docs: DataFrame, tokenizer_path: str, most: int, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece of each document: the id, ``piece``, ``start``, ``length``, ``ids_crc32``.

    A document's ids are its text's (null: empty) and ``end_id``. A longer one is cut into pieces of ``most`` ids, of
    which the first may be shorter. Repeated rows give repeated pieces; other columns have no effect."""
    shipped = shipped_file(docs.sparkSession, tokenizer_path)
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ids_of(shipped)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                rows, piece, start, length, crc = [], [], [], [], []
                for row, ids in enumerate(table.of(t) for t in batch.column(1).to_pylist()):
                    ids += end
                    n = len(ids) // 4
                    first = n % most or min(n, most)
                    edges = [0, *range(first, n + 1, most)]
                    for p, (a, b) in enumerate(zip(edges, edges[1:])):
                        rows.append(row)
                        piece.append(p)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(memoryview(ids)[4 * a : 4 * b]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows, pa.int32())),
                        pa.array(piece, pa.int32()),
                        *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                    ],
                    names=[id_col, "piece", "start", "length", "ids_crc32"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col(id_col), text_of(text_col)).mapInArrow(cut, schema)


def best_two_fit(counts: dict[int, int], most: int) -> list[tuple[int, list[int]]]:
    """Patterns (how often, the lengths of one sequence) that use up ``counts`` of lengths 1 to ``most``.

    Every sequence starts with the longest document left and takes the longest that fits until none does. Then its
    smallest document is replaced by the two left that together come nearest to the space it would free, if they fill
    more of it. Repeating a filling while every length it used is there gives the same sequences as one at a time."""
    left = Counter({s: n for s, n in counts.items() if n > 0})
    lengths = sorted(left)
    plan: list[tuple[int, list[int]]] = []

    def longest(limit: int, used: Counter) -> int:
        at = bisect_right(lengths, limit) - 1
        while at >= 0 and left[lengths[at]] <= used[lengths[at]]:
            at -= 1
        return lengths[at] if at >= 0 else 0

    def best_pair(space: int, above: int, used: Counter) -> tuple[int, int]:
        """The two lengths with the largest sum over ``above`` and up to ``space``: one pointer goes up, one down."""
        best, pair, lo, hi = above, (0, 0), 0, bisect_right(lengths, space) - 1
        there = lambda s, n=1: left[s] - used[s] >= n
        while lo <= hi:
            a, b = lengths[lo], lengths[hi]
            if a + b > space or not there(b):
                hi -= 1
            else:
                if there(a, 2 if a == b else 1) and a + b > best:
                    best, pair = a + b, (a, b)
                lo += 1
        return pair

    while lengths:
        if not left[lengths[-1]]:
            lengths.pop()
            continue
        used: Counter = Counter()
        bin_, gap = [], most
        while gap and (s := longest(gap, used)):
            bin_.append(s)
            used[s] += 1
            gap -= s
        if gap and len(bin_) > 1:
            smallest = bin_[-1]
            used[smallest] -= 1
            a, b = best_pair(gap + smallest, smallest, used)
            if a:
                bin_[-1:] = [b, a]
                used.update((a, b))
            else:
                used[smallest] += 1
        used = +used
        times = min(left[s] // n for s, n in used.items())
        plan.append((times, sorted(bin_, reverse=True)))
        for s, n in used.items():
            left[s] -= n * times
        lengths = [s for s in lengths if left[s]]
    return plan


class Places:
    """Where the document of a rank within its length goes."""

    def __init__(self, plan: list[tuple[int, list[int]]]):
        runs: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        seen: Counter = Counter()
        base = 0
        for times, lengths in plan:
            offset = 0
            for s in lengths:
                runs[s].append((seen[s], base, offset))
                seen[s] += times
                offset += s
            base += times
        self.n_sequences = base
        self.runs = {s: np.array(r, np.int64) for s, r in runs.items()}

    def of(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for s in np.unique(lengths):
            own = lengths == s
            runs = self.runs[int(s)]
            at = np.searchsorted(runs[:, 0], ranks[own], side="right") - 1
            sequence[own] = runs[at, 1] + ranks[own] - runs[at, 0]
            offset[own] = runs[at, 2]
        return sequence, offset


def pack(cut: DataFrame, most: int, order: list[str]) -> DataFrame:
    """``cut``, whose rows have a ``length`` of 1 to ``most``, with ``sequence_id`` and ``offset``: its place in a sequence of
    at most ``most`` ids, without gaps from 0.

    Rows are numbered within their length by ``order``, in parts, so that a length that a third of all rows has is still
    dealt to many tasks; rows equal in ``order`` (repeated ones) take any of their places. The driver holds a count per
    length and part and the plan, both bounded by ``most``. An empty table gives an empty one."""
    part = F.pmod(F.xxhash64(*order), F.lit(SALTS)).cast("int")
    cut = written(cut.withColumn("_part", part), "pack-pieces")
    counted = cut.groupBy("length", "_part").agg(F.count("*").alias("n")).collect()
    totals: Counter = Counter()
    before = np.zeros((most + 1, SALTS), np.int64)
    for r in sorted(counted, key=lambda r: (r["length"], r["_part"])):
        before[r["length"], r["_part"]] = totals[r["length"]]
        totals[r["length"]] += r["n"]
    shipped = cut.sparkSession.sparkContext.broadcast((before, Places(best_two_fit(totals, most))))
    names = [c for c in cut.columns if c != "_part"]
    place_at, part_at, rank_at = names.index("length"), len(names), len(names) + 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        earlier, places = shipped.value
        for batch in batches:
            lengths, parts, ranks = (batch.column(i).to_numpy() for i in (place_at, part_at, rank_at))
            sequence, offset = places.of(lengths, earlier[lengths, parts] + ranks - 1)
            columns = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    rank = F.row_number().over(W.partitionBy("length", "_part").orderBy(*order)).cast("long")
    numbered = cut.select(*names, "_part", rank.alias("_rank"))
    schema = ", ".join(f"`{c}` {cut.schema[c].dataType.simpleString()}" for c in names)
    return numbered.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, most: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents, cut into pieces and packed: the columns of ``pieces`` with ``sequence_id`` and ``offset``."""
    return pack(pieces(docs, tokenizer_path, most, end_id, id_col, text_col), most, [id_col, "piece"])
