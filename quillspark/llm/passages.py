"""Removal of passages that occur more than once.

A window is a number of consecutive words. Windows are found to recur without listing them all: each text is cut into
runs of windows that share an anchor, the group of words in them with the smallest hash, so that equal windows have
equal anchors wherever they stand. Runs whose anchor occurs once hold no recurring window. Runs that are equal as a whole
recur as a whole. Only what is left, different runs around one anchor, is compared window by window, once per distinct
run. So passages are confirmed. Documents are dealt to shards of a bounded number of words, and each shard is given every
confirmed passage that it holds once, from the first document of the shard that has it. A shard's passages are compiled
into one Aho-Corasick automaton, through which all its documents are streamed: where they occur is known from its matches
alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import written

#: Words of an anchor.
ANCHOR = 8
#: Words of the documents of one shard, on average, and so behind one automaton.
SHARD_WORDS = 1 << 18
#: Rows of windows in one output batch.
WINDOW_ROWS = 200_000

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACE = np.uint64((1 << 24) - 1)
_LETTERS = [chr(c) for c in range(48, 112)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _A
    h = (h ^ (h >> np.uint64(29))) * _B
    return h ^ (h >> np.uint64(32))


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, as far as a text has needed them."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 2 * len(cls.up), 4096)
            cls.up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, _A)]))
            cls.down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, _INVERSE)]))
        return cls.up[:n], cls.down[:n]


class Hashes:
    """64-bit hashes of any stretch of words of a text."""

    def __init__(self, words: list[bytes]):
        n = len(words)
        up, self.down = _Powers.to(n + 1)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up[:n])])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def runs_of(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First windows, numbers of windows, anchors and hashes of the runs of a text, in order."""
    n = len(words)
    anchor = min(ANCHOR, window)
    hashes = Hashes(words)
    at = np.arange(n - anchor + 1)
    groups = hashes.of(at, at + anchor)
    least = (groups & ~_PLACE) | (at.astype(np.uint64) & _PLACE)  # the leftmost of equal ones
    span, width = window - anchor + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    edges = np.flatnonzero(np.diff(least)) + 1
    starts = np.concatenate([[0], edges])
    ends = np.concatenate([edges, [len(least)]])
    base = starts & ~np.int64(_PLACE)
    place = base + (least[starts] & _PLACE).astype(np.int64)
    place += np.where(place < starts, np.int64(_PLACE) + 1, 0)
    return starts, ends - starts, groups[place].view(np.int64), hashes.of(starts, ends + window - 1).view(np.int64)


def _based(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row`` (a number of the row), the id, ``z``, the words of the text, compressed, and ``words``, their number."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            split = [(text.as_py() or b"").split() for text in batch.column(2)]
            z = pa.array([squeeze(b" ".join(words)) for words in split], pa.binary())
            sizes = pa.array([len(words) for words in split], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), z, sizes], names=["row", "id", "z", "words"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("binary"))
    return rows.mapInArrow(each, f"row long, id {docs.schema[id_col].dataType.simpleString()}, z binary, words long")


def _runs(base: DataFrame, window: int) -> DataFrame:
    """``row``, ``start``, ``n``, ``anchor`` and ``run`` (its hash) for each run of each text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            found = []
            for row, z in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = open_(z.as_py()).split()
                if len(words) >= window:
                    starts, counts, anchors, runs = runs_of(words, window)
                    found.append((np.full(len(starts), row), starts, counts, anchors, runs))
            if found:
                columns = [np.concatenate(c) for c in zip(*found)]
                kinds = (np.int64, np.int32, np.int32, np.int64, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.astype(k)) for c, k in zip(columns, kinds)], names=["row", "start", "n", "anchor", "run"]
                )

    return base.select("row", "z").mapInArrow(each, "row long, start int, n int, anchor long, run long")


def _windows(reps: DataFrame, window: int) -> DataFrame:
    """``anchor``, ``hash``, ``weight``, ``row`` and ``start`` for each window of the runs of ``reps``."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows, zs, runs = (batch.column(i) for i in range(3))
            out: list[list[np.ndarray]] = []
            size = 0
            for row, z, own in zip(rows.to_pylist(), zs, runs.to_pylist()):
                hashes = Hashes(open_(z.as_py()).split())
                for run in own:
                    at = np.arange(run["start"], run["start"] + run["n"])
                    wide = [np.full(len(at), run[c]) for c in ("anchor", "weight")]
                    out.append([wide[0], hashes.of(at, at + window).view(np.int64), wide[1], np.full(len(at), row), at])
                    size += len(at)
                if size > WINDOW_ROWS:
                    yield _batch(out)
                    out, size = [], 0
            if out:
                yield _batch(out)

    def _batch(out: list[list[np.ndarray]]) -> pa.RecordBatch:
        columns = [np.concatenate(c).astype(np.int64) for c in zip(*out)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor", "hash", "weight", "row", "start"])

    return reps.select("row", "z", "runs").mapInArrow(each, "anchor long, hash long, weight long, row long, start long")


def confirmed(base: DataFrame, window: int, shard: Column) -> DataFrame:
    """``shard``, ``row``, ``start``, ``n`` and ``once``: stretches of windows that recur, each distinct one once per shard.

    A run that recurs as a whole is there for one place of each shard that has it; recurring windows of a run that is found
    once (``once``) are there for this run."""
    runs = written(_runs(base, window), "passage-runs")
    anchors = written(runs.groupBy("anchor").agg(F.count("*").alias("times")).filter("times > 1").select("anchor"), "passage-anchors")
    shared = written(runs.join(anchors, "anchor"), "passage-shared")
    place = F.min(F.struct("row", "start", "n")).alias("rep")
    held = shared.groupBy(shard.alias("shard"), "anchor", "run").agg(F.count("*").alias("times"), place)
    held = written(held, "passage-held")
    kinds = held.groupBy("anchor", "run").agg(F.sum("times").alias("weight"), F.min("rep").alias("rep"))
    kinds = written(kinds, "passage-kinds")
    mixed = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("weight").alias("least"))
    mixed = written(mixed.filter("kinds > 1 and least = 1").select("anchor"), "passage-mixed")
    open_runs = kinds.join(mixed, "anchor").select("rep.row", F.struct("rep.start", "rep.n", "anchor", "weight").alias("r"))
    reps = open_runs.groupBy("row").agg(F.collect_list("r").alias("runs"))
    windows = written(_windows(base.join(reps, "row"), window), "passage-windows")
    twice = windows.groupBy("anchor", "hash").agg(F.sum("weight").alias("times")).filter("times > 1").select("anchor", "hash")
    alone = windows.filter("weight = 1").join(written(twice, "passage-twice"), ["anchor", "hash"])
    alone = alone.select(shard.alias("shard"), "row", F.col("start").cast("int"), F.lit(1).alias("n"), F.lit(True).alias("once"))
    whole = held.join(kinds.filter("weight > 1").select("anchor", "run"), ["anchor", "run"])
    return whole.select("shard", "rep.row", "rep.start", "rep.n", F.lit(False).alias("once")).union(alone)


def covered(n: int, spans: list[tuple[int, int]]) -> np.ndarray:
    """The words that stretches (first, after the last) cover."""
    edges = np.zeros(n + 1, np.int64)
    for a, b in spans:
        edges[a] += 1
        edges[b] -= 1
    return np.cumsum(edges[:-1]) > 0


def passages_of(spans: list[tuple[int, int, bool]], window: int) -> list[tuple[int, int]]:
    """Passages (first word, after the last) of spans (first window, number of windows, whether of a run found once).

    Spans of runs found once are put together where they meet; runs that recur stay as they are, as elsewhere one may
    stand without the next."""
    out = [(a, a + n + window - 1) for a, n, once in spans if not once]
    joined: list[list[int]] = []
    for a, n in sorted((a, n) for a, n, once in spans if once):
        if joined and joined[-1][1] >= a:
            joined[-1][1] = max(joined[-1][1], a + n)
        else:
            joined.append([a, a + n])
    return out + [(a, b + window - 1) for a, b in joined]


def occurrences(texts: list[list[bytes]], passages: list[tuple[int, int, int]]) -> list[list[tuple[int, int]]]:
    """Where any of the passages (text, first word, after the last) occurs in each text, by one automaton.

    Words become numbers of a shard-wide table, written with a fixed number of letters each, so that the automaton's
    alphabet is small; a match counts where it starts at a word."""
    numbers: dict[bytes, int] = {}
    for words in texts:
        for w in words:
            numbers.setdefault(w, len(numbers))
    digits = 1
    while 64**digits < len(numbers):
        digits += 1
    code = {w: "".join(_LETTERS[i >> 6 * d & 63] for d in range(digits)) for w, i in numbers.items()}
    coded = ["".join(map(code.__getitem__, words)) for words in texts]
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for text, a, b in passages:
        automaton.add_word(coded[text][a * digits : b * digits], b - a)
    automaton.make_automaton()
    out: list[list[tuple[int, int]]] = []
    for line in coded:
        found: dict[int, int] = {}
        for end, size in automaton.iter(line):
            if (end + 1) % digits == 0 and size > found.get((end + 1) // digits, 0):
                found[(end + 1) // digits] = size
        out.append([(end - size, end) for end, size in found.items()])
    return out


def remove_recurring(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words``, ``n_removed``, ``kept_sha256`` of the words left, joined by one
    space, and with ``with_text`` these themselves as ``text``.

    A word goes if a window of ``window`` words covers it whose words also start anywhere else, in the same text or
    another; repeated rows count as texts of their own. A null or empty text has no words. Null ids and other columns
    have no effect, an empty table gives an empty one.

    Hashes are 64 bits of an anchor together with 64 bits of a run or window. Rows that are shuffled are runs, about
    two in 29 words, those that share an anchor, the windows of unequal runs, and the texts once, compressed. Counts of
    anchors, runs and windows are written before they are joined, so that both sides of a join are plain shuffles and AQE
    splits a hot anchor. Shards are dealt by row, so none holds more of a group of copies than its share."""
    base = written(_based(docs, id_col, text_col), "passage-texts")
    total = base.agg(F.sum("words")).first()[0] or 0
    shard = F.pmod(F.xxhash64("row"), F.lit(1 + total // SHARD_WORDS))

    def cut(texts: pa.Table, passages: pa.Table) -> pa.Table:
        open_ = zstandard.ZstdDecompressor().decompress
        words = [open_(z.as_py()).split() for z in texts["z"]]
        own: dict[int, list[tuple[int, int, bool]]] = {}
        for row, *span in zip(*(passages[c].to_pylist() for c in ("row", "start", "n", "once"))):
            own.setdefault(row, []).append(tuple(span))
        at = {row: i for i, row in enumerate(texts["row"].to_pylist())}
        compiled = [(at[row], a, b) for row, spans in own.items() for a, b in passages_of(spans, window)]
        places = occurrences(words, compiled) if compiled else [[]] * len(words)
        removed, digest, left = [], [], []
        for text, found in zip(words, places, strict=True):
            gone = covered(len(text), found) if found else ()
            kept = b" ".join([w for w, g in zip(text, gone) if not g] if found else text)
            removed.append(int(np.sum(gone)))
            digest.append(hashlib.sha256(kept).hexdigest())
            left.append(kept.decode() if with_text else None)
        columns = [texts["id"], texts["words"], pa.array(removed, pa.int64()), pa.array(digest, pa.string())]
        names = [id_col, "n_words", "n_removed", "kept_sha256"]
        if with_text:
            columns.append(pa.array(left, pa.string()))
            names.append("text")
        return pa.table(columns, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_words long, n_removed long, kept_sha256 string" + ", text string" * with_text
    passages = written(confirmed(base, window, shard), "passage-confirmed")
    shards = base.select(shard.alias("shard"), "row", "id", "z", "words").groupBy("shard")
    return shards.cogroup(passages.groupBy("shard")).applyInArrow(cut, schema)
