"""Quality of documents by a linear-chain conditional random field over their lines.

A line is good or bad. What speaks for either are measures of the line itself, of the lines before and after it, and of
the whole text, each cut into bins that have a weight, and how well neighbouring labels go together. Forward and backward
messages give every line's chance of being good; their mean, weighted by length, is the document's quality, through a
logistic curve fitted on texts that the field has not seen. Labels are known for documents only: all lines of a good one
are good; which lines of a bad one are bad is learned first without neighbours' labels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: About so many labelled documents, chosen by a hash of the id, teach field and curve, ...
LABELLED_SAMPLE = 8_000
#: ... each with at most so many consecutive lines, from a place given by a hash. Scoring reads every line.
TAUGHT_LINES = 48
#: Bins of a measure besides the one of exact zero.
BINS = 7
STEPS = 150
#: Strength of the shrinkage of weights, in lines.
SHRINK = 2.0
#: Bytes of text that are measured together; lines are not cut.
BLOCK_BYTES = 1 << 20

MEASURES = (
    "bytes", "words", "bytes a word", "capitals", "digits", "marks", "stops", "bangs", "bars", "high bytes", "capital words",
    "marked ends", "words without letters", "repeats of the word before", "repeated words", "short words", "ends in a stop",
    "starts with a capital", "copies in the text", "lines of the text", "words of the text", "repeats in the text",
)
_N = len(MEASURES)
#: The first so many look at nothing but the line.
_LINE_MEASURES = MEASURES.index("copies in the text")
#: Where a measure is looked up: the line, the one before, the one after.
PLACES = 3

# Kinds of bytes.
_SPACE, _LOWER, _UPPER, _DIGIT, _MARK, _STOP, _BANG, _BAR, _HIGH, _OTHER = range(10)
_KIND = np.full(256, _OTHER, np.uint8)
for _chars, _kind in ((b" \t\n\v\f\r", _SPACE), (b"#*$%&<>=+~^_\\/@{}[]", _MARK), (b".,;:", _STOP), (b"!?", _BANG), (b"|", _BAR)):
    _KIND[list(_chars)] = _kind
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = _LOWER, _UPPER, _DIGIT, _HIGH
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)
_POWERS = np.cumprod(np.full(256, _BASE, np.uint64))
_LETTER = np.zeros(10, np.int64)
_LETTER[[_LOWER, _UPPER, _HIGH]] = 1
_MARKED = np.zeros(10, bool)
_MARKED[[_MARK, _BANG, _BAR]] = True


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[ends] - total[starts]


def _repeats(line: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
    """How many words of each line stand in it before."""
    order = np.lexsort((words, line))
    groups, hashes = line[order], words[order]
    same = (groups[1:] == groups[:-1]) & (hashes[1:] == hashes[:-1])
    return np.bincount(groups[1:][same], minlength=n)


def _lines_of(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Measures of the lines of a block (each ended by a line feed), their hashes, and those of all words."""
    raw = np.frombuffer(block, np.uint8)
    kind = _KIND[raw]
    ends = np.flatnonzero(raw == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(ends)
    out = np.zeros((n, _N))
    out[:, 0] = ends - starts
    inside = kind != _SPACE
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    first, after = edges[::2], edges[1::2]
    if not len(first):
        return out, np.zeros(n, np.uint64), np.zeros(0, np.uint64)
    lengths = after - first
    line = np.searchsorted(ends, first)
    before = np.cumsum(lengths) - lengths
    place = np.arange(before[-1] + lengths[-1]) - np.repeat(before, lengths)
    words = _mixed(np.add.reduceat((raw[inside].astype(np.uint64) + np.uint64(1)) * _POWERS[place & 255], before))
    per_line = np.bincount(line, minlength=n)
    spans = np.concatenate([[0], np.cumsum(per_line)])
    order = (np.arange(len(words)) - spans[line]).astype(np.uint64)
    hashes = _mixed(_sums(_mixed(words + order * _BASE), spans[:-1], spans[1:]) + per_line.astype(np.uint64))

    used = np.maximum(_sums(inside.astype(np.int64), starts, ends), 1)
    some = np.maximum(per_line, 1)
    out[:, 1], out[:, 2] = per_line, np.where(per_line > 0, used / some, 0)
    for i, k in ((3, _UPPER), (4, _DIGIT), (5, _MARK), (6, _STOP), (7, _BANG), (8, _BAR), (9, _HIGH)):
        out[:, i] = _sums((kind == k).astype(np.int64), starts, ends) / used
    last, letters = kind[after - 1], _LETTER[kind]
    flags = (
        kind[first] == _UPPER,
        _MARKED[last],
        np.add.reduceat(letters[inside], before) == 0,
        np.concatenate([[False], (words[1:] == words[:-1]) & (line[1:] == line[:-1])]),
    )
    for i, f in enumerate(flags, 10):
        out[:, i] = np.bincount(line, weights=f, minlength=n) / some
    out[:, 14] = _repeats(line, words, n) / some
    out[:, 15] = np.bincount(line, weights=lengths <= 3, minlength=n) / some
    out[:, 16] = (per_line > 0) & (last[np.maximum(spans[1:] - 1, 0)] == _STOP)
    out[:, 17] = (per_line > 0) & (kind[first[np.minimum(spans[:-1], len(first) - 1)]] == _UPPER)
    return out, hashes, words


def measures(text: str | bytes | None) -> np.ndarray:
    """The measures of all lines of a text, one row per line; a text without any, or null, is one empty line."""
    data = text.encode() if isinstance(text, str) else text or b""
    parts, hashes, words = [], [], []
    at = 0
    while at <= len(data):
        end = data.find(b"\n", at + BLOCK_BYTES)
        end = len(data) if end < 0 else end
        rows, own, used = _lines_of(data[at:end] + b"\n")
        parts.append(rows)
        hashes.append(own)
        words.append(used)
        at = end + 1
    out, lines, used = np.concatenate(parts), np.concatenate(hashes), np.concatenate(words)
    filled = out[:, 1] > 0
    _, which, times = np.unique(lines, return_inverse=True, return_counts=True)
    out[:, 18] = np.where(filled, times[which] - 1, 0)
    out[:, 19], out[:, 20] = len(out), len(used)
    out[:, 21] = 1 - len(np.unique(used)) / len(used) if len(used) else 0
    return out


def with_neighbours(bins: np.ndarray) -> np.ndarray:
    """Indexes of weights, one row per line: of the line's own bins, of those before and after; -1 beyond the text."""
    n = len(bins)
    wide = np.full((n, PLACES * _N), -1, np.int32)
    wide[:, :_N] = bins
    wide[1:, _N : 2 * _N] = bins[:-1]
    wide[:-1, 2 * _N :] = bins[1:]
    columns = np.arange(PLACES * _N, dtype=np.int32) * (BINS + 2)
    return columns + wide + 1  # the first weight of a column stands for "no such line"


def _lone(wide: np.ndarray) -> np.ndarray:
    """The same without what is not in the line itself."""
    out = wide.copy()
    out[:, _LINE_MEASURES:] = np.arange(_LINE_MEASURES, PLACES * _N) * (BINS + 2)
    return out


@dataclass
class Field:
    """Upper ends of bins by measure, weights by place, measure and bin, weights of pairs of labels, the curve."""

    edges: np.ndarray
    weights: np.ndarray
    pairs: np.ndarray
    curve: tuple[float, float] = (0.0, 1.0)

    def binned(self, rows: np.ndarray) -> np.ndarray:
        out = np.empty(rows.shape, np.int32)
        for j in range(_N):
            out[:, j] = np.searchsorted(self.edges[j], rows[:, j], side="left")
        return out

    def odds(self, wide: np.ndarray) -> np.ndarray:
        """What a line's neighbourhood says for good."""
        return self.weights[wide].sum(axis=1)

    def quality(self, text: str | bytes | None) -> tuple[float, np.ndarray]:
        """The chance that a text is good, and that each of its lines is."""
        rows = measures(text)
        own = self.odds(with_neighbours(self.binned(rows)))
        good = marginals(own, self.pairs)
        a, b = self.curve
        return float(_logistic(a + b * _aggregate(good, rows[:, 0]))), good


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _aggregate(good: np.ndarray, lengths: np.ndarray) -> float:
    """Log-odds of the mean chance, weighted by length; an empty line counts as one byte."""
    p = np.clip(np.average(good, weights=lengths + 1), 1e-4, 1 - 1e-4)
    return float(np.log(p / (1 - p)))


def _turned(x: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Log-odds of a message from odds of its sender; ``pairs[i, j]`` is sender i, receiver j."""
    return np.logaddexp(pairs[0, 1], x + pairs[1, 1]) - np.logaddexp(pairs[0, 0], x + pairs[1, 0])


def messages(odds: list[np.ndarray], pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded odds, forward odds (the line included) and backward odds of many texts, longest text first."""
    n, longest = len(odds), max(map(len, odds))
    own = np.zeros((longest, n))
    sizes = np.array([len(o) for o in odds])
    for i, o in enumerate(odds):
        own[: len(o), i] = o
    forward, backward = own.copy(), np.zeros_like(own)
    live = [int(np.count_nonzero(sizes > t)) for t in range(longest)]
    for t in range(1, longest):
        k = live[t]
        forward[t, :k] += _turned(forward[t - 1, :k], pairs)
    for t in range(longest - 2, -1, -1):
        k = live[t + 1]
        backward[t, :k] = _turned(own[t + 1, :k] + backward[t + 1, :k], pairs.T)
    return own, forward, backward


def marginals(odds: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The chance of each line of one text to be good."""

    def passed(x: list[float], p00: float, p01: float, p10: float, p11: float) -> list[float]:
        """Odds that come along the chain to each line; ``p01`` is from bad to good."""
        out, came = [], 0.0
        for own in x:
            out.append(came)
            m = min(max(came + own, -500.0), 500.0)
            came = math.log(math.exp(p01) + math.exp(m + p11)) - math.log(math.exp(p00) + math.exp(m + p10))
        return out

    (p00, p01), (p10, p11) = pairs.tolist()
    x = odds.tolist()
    ahead = passed(x, p00, p01, p10, p11)
    back = passed(x[::-1], p00, p10, p01, p11)[::-1]
    return _logistic(odds + np.array(ahead) + np.array(back))


def _fit(texts: list[np.ndarray], labels: list[np.ndarray], start: Field, chained: bool) -> Field:
    """Weights of highest likelihood with shrinkage, by gradient steps of adapted size. ``texts`` fall in length."""
    sizes = np.array(list(map(len, texts)))
    wide, good = np.concatenate(texts), np.concatenate(labels).astype(float)
    bounds = np.cumsum(sizes)[:-1]
    longest = sizes[0]
    grid = np.arange(longest)[:, None] < sizes[None, :]
    slot = np.full(grid.shape, -1)
    slot[tuple(np.concatenate([np.stack([np.arange(s), np.full(s, i)]) for i, s in enumerate(sizes)], axis=1))] = np.arange(len(wide))
    weights, pairs = start.weights.copy(), start.pairs.copy()
    # Labels of neighbours, counted once.
    inner = grid[1:]
    seen = np.zeros((2, 2))
    y = np.where(grid, good[np.maximum(slot, 0)], 0)
    if longest > 1:
        for i in (0, 1):
            for j in (0, 1):
                seen[i, j] = np.count_nonzero(inner & (y[:-1] == i) & (y[1:] == j))
    truth = np.bincount(wide.ravel(), weights=np.repeat(good, wide.shape[1]), minlength=len(weights))
    moment, square = np.zeros(len(weights) + 4), np.zeros(len(weights) + 4)
    for step in range(1, STEPS + 1):
        odds = weights[wide].sum(axis=1)
        expected = np.zeros((2, 2))
        if chained and longest > 1:
            own, forward, backward = messages(np.split(odds, bounds), pairs)
            chance = _logistic(forward + backward)
            p = np.empty(len(wide))
            p[slot[grid]] = chance[grid]
            after = own[1:] + backward[1:]
            cells = np.stack([pairs[i, j] + i * forward[:-1] + j * after for i in (0, 1) for j in (0, 1)])
            cells = np.exp(cells - cells.max(axis=0))
            expected = ((cells / cells.sum(axis=0)) * inner).sum(axis=(1, 2)).reshape(2, 2)
        else:
            p = _logistic(odds)
        pull = np.bincount(wide.ravel(), weights=np.repeat(p, wide.shape[1]), minlength=len(weights))
        gradient = np.concatenate([truth - pull - SHRINK * weights, (seen - expected - SHRINK * pairs).ravel() if chained else np.zeros(4)])
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        change = 0.06 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        change *= min(1.0, 2 * (1 - step / (STEPS + 1)))
        weights += change[:-4]
        pairs += change[-4:].reshape(2, 2)
    return Field(start.edges, weights, pairs)


def teach(taught: list[tuple[np.ndarray, int]], curve: list[tuple[np.ndarray, int]]) -> Field:
    """A field from (measures of lines, label) of texts, and its curve from those of others."""
    blank = Field(np.zeros((_N, BINS)), np.zeros(PLACES * _N * (BINS + 2)), np.zeros((2, 2)))
    taught = sorted(taught, key=lambda x: -len(x[0]))
    if len({label for _, label in taught}) < 2:
        share = np.mean([label for _, label in [*taught, *curve]]) if taught or curve else 0.5
        return Field(blank.edges, blank.weights, blank.pairs, (float(np.log((share + 0.01) / (1.01 - share))), 0.0))
    rows = np.concatenate([x for x, _ in taught])
    for j in range(_N):
        some = rows[:, j][rows[:, j] > 0]
        cuts = np.quantile(some, np.linspace(0, 1, BINS + 1)[1:-1]) if len(some) else np.zeros(BINS - 1)
        blank.edges[j] = np.concatenate([[0.0], cuts])
    wide = [with_neighbours(blank.binned(x)) for x, _ in taught]
    labels = [np.full(len(x), label) for x, label in taught]
    lone = [_lone(x) for x in wide]
    alone = _fit(lone, labels, blank, chained=False)
    for i, (x, label) in enumerate(taught):
        if not label:
            odds = alone.odds(lone[i])
            labels[i] = ((odds > 0) & (odds > odds.min())).astype(int)
    field = _fit(wide, labels, blank, chained=True)
    seen = curve or taught
    goods = [marginals(field.odds(with_neighbours(field.binned(x))), field.pairs) for x, _ in seen]
    z = np.array([_aggregate(good, x[:, 0]) for good, (x, _) in zip(goods, seen)])
    y = np.array([float(label) for _, label in seen])
    a, b = 0.0, 1.0
    for _ in range(100):  # Newton's method, drawn to the field's own chances
        p = _logistic(a + b * z)
        g = np.array([np.sum(p - y) + 0.1 * a, np.sum((p - y) * z) + 1.0 * (b - 1)])
        w = p * (1 - p)
        h = np.array([[np.sum(w) + 0.1, np.sum(w * z)], [np.sum(w * z), np.sum(w * z * z) + 1.0]])
        a, b = np.array([a, b]) - np.clip(np.linalg.solve(h, g), -1, 1)
    return Field(field.edges, field.weights, field.pairs, (float(a), float(max(b, 0.0))))


def fold_of(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 5


def learn(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label: str = "quality", sample: int = LABELLED_SAMPLE) -> Field:
    """A field from labelled texts whose fold is not 0: folds 1 to 3 teach it, fold 4 the curve.

    About ``sample`` labelled rows, chosen by a hash of their id, are read; they are broadcast as ids and labels, and
    measured by the tasks; at most ``TAUGHT_LINES`` rows of numbers a text come to the driver. Null ids and labels take
    no part. An id with both labels takes none. Without labels, or with one kind, every text gets the same score."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("good")).filter("id is not null and good is not null")
    known = known.withColumn("fold", fold_of("id")).filter("fold != 0")
    known = known.groupBy("id", "fold").agg(F.max("good").alias("good"), F.min("good").alias("least")).filter("good = least")
    share = min(1.0, sample / max(1, known.count()))
    known = known.filter((F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000)) | F.lit(share >= 1))
    chosen = known.select("id", "good", "fold", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 20)).alias("place"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t")).join(F.broadcast(chosen), "id")
    # Equal texts teach once, so that a large group of copies does not outweigh the rest.
    texts = texts.withColumn("key", F.sha2("t", 256)).dropDuplicates(["key", "good"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for text, place in zip(batch.column(0), batch.column(3).to_pylist()):
                rows = measures(text.as_py())
                start = place % max(1, len(rows) - TAUGHT_LINES + 1)
                packed.append(rows[start : start + TAUGHT_LINES].astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(packed, pa.binary())], names=["good", "fold", "rows"])

    got = texts.select("t", "good", "fold", "place").mapInArrow(each, "good int, fold long, rows binary").collect()
    pairs = sorted(((r["good"], r["fold"], bytes(r["rows"])) for r in got), key=lambda x: (x[1], x[2], x[0]))
    ready = [(fold, np.frombuffer(rows, "<f4").reshape(-1, _N).astype(float), int(good > 0)) for good, fold, rows in pairs]
    return teach([(x, y) for fold, x, y in ready if fold != 4], [(x, y) for fold, x, y in ready if fold == 4])


def score(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``score`` between 0 and 1, ``n_lines`` and ``n_bad_lines``, those more likely
    bad than good.

    Whole texts are read in one pass without a shuffle; a null or empty text is one empty line. Null ids, repeated rows
    and other columns have no effect; an empty table gives no rows."""
    shipped = docs.sparkSession.sparkContext.broadcast(field)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            judged = [own.quality(t.as_py()) for t in batch.column(1)]
            numbers = [[q for q, _ in judged], [len(g) for _, g in judged], [int(np.count_nonzero(g < 0.5)) for _, g in judged]]
            columns = [pa.array(v, k) for v, k in zip(numbers, (pa.float64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_col, "score", "n_lines", "n_bad_lines"])

    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, score double, n_lines long, n_bad_lines long"
    return docs.select(id_col, F.col(text_col).cast("binary").alias("_text")).mapInArrow(each, schema)
