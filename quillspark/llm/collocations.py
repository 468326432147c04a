"""Phrases whose words come together more often than each for itself.

Texts are cut into shards of words, each with a vocabulary of its own. Frequent words get numbers, and a phrase is its
numbers, packed. The phrases of a shard are counted in a counting quotient filter: an invertible permutation spreads the
packed numbers evenly, the first bits of the result are the quotient, all other bits are kept as the remainder, so nothing
is lost and equal entries are equal phrases. Filters are sorted, hence merged across shards range by range of quotients.
Longer phrases are only counted where both shorter ones in them are frequent; the frequent ones are handed down as marks
in a bitmap of bounded size, in which strangers may be marked too: these are counted and then found to be rare.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import written
from quillspark.llm.merkle import placed

#: Words of a shard, about; a shard ends with a text.
SHARD_WORDS = 1_000_000
#: Longest phrase.
WORDS = 4
#: Filters that are merged at a time, and ranges of quotients they are cut into: this power of two.
FAN_BITS = 8
#: Bits of the marks that are sent to all tasks, as a power of two: 16 MB, at any number of phrases.
MARK_BITS = 27
#: Parts that the phrases of a language are ranked in before they are ranked together.
RANKED_PARTS = 32
#: Numbers of words have so many bits at least and at most.
LEAST_BITS, MOST_BITS = 16, 32

_CUT = bytes.maketrans(b".,;:!?\n\v\f\r\t", b"\n\n\n\n\n\n\n\n\n\n ")
_U = np.uint64
_KEYS = [_U(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


# The filter


def _ones(bits: int) -> np.uint64:
    return _U((1 << bits) - 1)


def _stirred(x: np.ndarray, key: np.uint64, bits: int) -> np.ndarray:
    h = (x + key) * _KEYS[0]
    h = (h ^ (h >> _U(32))) * _KEYS[1]
    return (h ^ (h >> _U(29))) & _ones(bits)


class Permutation:
    """A bijection of pairs of numbers of ``left`` and ``right`` bits, by rounds that change one of them by the other."""

    def __init__(self, left: int, right: int):
        self.left, self.right = left, right

    def of(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for i, key in enumerate(_KEYS):
            if i % 2:
                b = b ^ _stirred(a, key, self.right)
            else:
                a = a ^ _stirred(b, key, self.left)
        return a, b

    def back(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for i, key in reversed(list(enumerate(_KEYS))):
            if i % 2:
                b = b ^ _stirred(a, key, self.right)
            else:
                a = a ^ _stirred(b, key, self.left)
        return a, b


def _as_bytes(values: np.ndarray, bits: int) -> bytes:
    """Numbers of so many bits, in whole bytes each."""
    wide = -(-bits // 8)
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide]).tobytes()


def _as_numbers(data: memoryview, n: int, bits: int) -> tuple[np.ndarray, memoryview]:
    wide = -(-bits // 8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :wide] = np.frombuffer(data[: n * wide], np.uint8).reshape(n, wide)
    return out.view("<u8").ravel().astype(_U), data[n * wide :]


def summed(a: np.ndarray, b: np.ndarray, counts: np.ndarray | None, right: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries in order, each once, with their counts added up. Sorted stretches are merged, not sorted again."""
    if not len(a):
        return a, b, np.zeros(0, np.int64)
    if int(a.max()).bit_length() + right <= 64:
        whole = (a << _U(right)) | b if right < 64 else b
        if counts is None:
            whole = np.sort(whole)
        else:
            order = np.argsort(whole, kind="stable")
            whole, counts = whole[order], counts[order]
        at = np.flatnonzero(np.concatenate([[True], whole[1:] != whole[:-1]]))
        a, b = (whole[at] >> _U(right)) if right < 64 else np.zeros(len(at), _U), whole[at] & _ones(right)
    else:
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        counts = None if counts is None else counts[order]
        at = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        n = len(a)
        a, b = a[at], b[at]
        return a, b, np.diff(np.append(at, n)) if counts is None else np.add.reduceat(counts, at)
    return a, b, np.diff(np.append(at, len(whole))) if counts is None else np.add.reduceat(counts, at)


class Filter:
    """A counting quotient filter of one range of quotients, as bytes.

    Entries (``a``, ``b``, sorted) are pairs of ``left`` and ``right`` bits whose first ``known`` bits are the range. The
    next bits are the quotient: of every quotient one bit says whether it occurs, of every entry one bit whether it is
    the last with its quotient. Remainders stand in full, counts in one byte, larger ones apart."""

    @staticmethod
    def pack(a: np.ndarray, b: np.ndarray, counts: np.ndarray, left: int, right: int, known: int) -> bytes:
        n = len(a)
        q = min(left - known, max(0, n - 1).bit_length())
        rest = left - known - q
        quotients = (a & _ones(left - known)) >> _U(rest)
        occupied = np.zeros(1 << q, bool)
        occupied[quotients.astype(np.int64)] = True
        last = np.append(quotients[1:] != quotients[:-1], True)
        small = np.minimum(counts, 255).astype(np.uint8)
        large = counts[counts >= 255].astype("<i8")
        parts = [np.array([n, q], "<u4").tobytes(), np.packbits(occupied).tobytes(), np.packbits(last).tobytes()]
        parts += [_as_bytes(a & _ones(rest), rest), _as_bytes(b, right), small.tobytes(), large.tobytes()]
        return b"".join(parts)

    @staticmethod
    def unpack(data: bytes, left: int, right: int, known: int, range_: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, q = (int(x) for x in np.frombuffer(data[:8], "<u4"))
        view = memoryview(data)[8:]
        rest = left - known - q
        size = -(-(1 << q) // 8)
        occupied = np.flatnonzero(np.unpackbits(np.frombuffer(view[:size], np.uint8), count=1 << q))
        view = view[size:]
        size = -(-n // 8)
        last = np.unpackbits(np.frombuffer(view[:size], np.uint8), count=n)
        quotients = occupied[np.cumsum(last) - last].astype(_U)
        low, view = _as_numbers(view[size:], n, rest)
        b, view = _as_numbers(view, n, right)
        counts = np.frombuffer(view[:n], np.uint8).astype(np.int64)
        counts[counts == 255] = np.frombuffer(view[n:], "<i8")
        return (_U(range_) << _U(left - known)) | (quotients << _U(rest)) | low, b, counts


def _cut(a: np.ndarray, b: np.ndarray, counts: np.ndarray, left: int, right: int, known: int) -> Iterator[tuple[int, bytes]]:
    """Sorted entries as filters, one for each range of the first ``known`` bits that occurs."""
    ranges = (a >> _U(left - known)).astype(np.int64)
    edges = np.flatnonzero(np.concatenate([[True], ranges[1:] != ranges[:-1], [True]])) if len(a) else np.zeros(1, np.int64)
    for s, e in zip(edges[:-1], edges[1:]):
        yield int(ranges[s]), Filter.pack(a[s:e], b[s:e], counts[s:e], left, right, known)


# Shards


class _Own(dict):
    """Numbers of a shard's words, in order of appearance."""

    def __init__(self, lang: str | None, owner: _Shard):
        super().__init__({b"": -2, b"\n": -1})
        self.lang, self.owner = lang, owner

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.owner.words)
        self.owner.words.append(word)
        self.owner.langs.append(self.lang)
        return n


class _Shard:
    def __init__(self) -> None:
        self.words: list[bytes] = []
        self.langs: list[str | None] = []
        self.tables: dict[str | None, _Own] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes, lang: str | None) -> None:
        table = self.tables.get(lang)
        if table is None:
            table = self.tables[lang] = _Own(lang, self)
        pieces = text.lower().translate(_CUT).replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter(map(table.__getitem__, pieces), np.int32, len(pieces))
        self.parts += [ids[ids > -2], np.array([-1], np.int32)]
        self.size += len(ids)


def _shards(docs: DataFrame, text_col: str, lang: Column) -> DataFrame:
    """``shard``, its ``words`` (``lang``, ``word``, ``n``) and ``ids``: places of words in ``words``, -1 between pieces."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 32, 0
        shard = _Shard()

        def done() -> pa.RecordBatch:
            ids = np.concatenate(shard.parts)
            counts = np.bincount(ids[ids >= 0], minlength=len(shard.words))
            kinds = pa.struct([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])
            words = pa.StructArray.from_arrays(
                [pa.array(shard.langs, pa.string()), pa.array(shard.words, pa.binary()), pa.array(counts, pa.int64())], fields=list(kinds)
            )
            listed = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
            z = zstandard.ZstdCompressor(level=1).compress(ids.tobytes())
            return pa.RecordBatch.from_arrays([pa.array([base + made], pa.int64()), listed, pa.array([z], pa.binary())], names=["shard", "words", "ids"])

        for batch in batches:
            for text, own in zip(batch.column(0), batch.column(1).to_pylist()):
                shard.add(text.as_py() or b"", own)
                if shard.size >= SHARD_WORDS:
                    yield done()
                    shard, made = _Shard(), made + 1
        if shard.size:
            yield done()

    rows = docs.select(F.col(text_col).cast("binary").alias("t"), lang.cast("string").alias("l"))
    return rows.mapInArrow(each, "shard long, words array<struct<lang:string,word:binary,n:long>>, ids binary")


def _coded(shards: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``shard`` and ``ids``: numbers of frequent words, one more than in ``vocabulary``; 0 for others and between pieces."""
    own = shards.select("shard", F.posexplode("words").alias("i", "w")).select("shard", "i", "w.lang", "w.word")
    known = own.join(vocabulary.select("lang", "word", "id"), ["lang", "word"])
    tables = known.groupBy("shard").agg(F.collect_list(F.struct("i", "id")).alias("table"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, close = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            out = []
            for size, z, table in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                numbers = np.zeros(size + 1, np.uint32)
                pairs = table.values.flatten() if table.values is not None else ()
                if pairs:
                    numbers[pairs[0].to_numpy()] = pairs[1].to_numpy() + 1
                out.append(close(numbers[np.frombuffer(open_(z.as_py()), np.int32)].tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["shard", "ids"])

    rows = shards.select("shard", F.size("words").alias("size"), "ids").join(tables, "shard", "left")
    return rows.select("shard", "size", "ids", "table").mapInArrow(each, "shard long, ids binary")


# Phrases


def _halves(n: int, bits: int) -> tuple[int, int]:
    """Bits of the two halves of a packed phrase of n words."""
    return bits * (n - n // 2), bits * (n // 2)


def packed(ids: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The phrases of n words at each place (ids are numbers of words), packed into two halves."""
    size = len(ids) - n + 1
    halves = []
    for first, after in ((0, n - n // 2), (n - n // 2, n)):
        half = ids[first : first + size].astype(_U)
        for k in range(first + 1, after):
            half = (half << _U(bits)) | ids[k : k + size].astype(_U)
        halves.append(half)
    return halves[0], halves[1]


def unpacked(a: np.ndarray, b: np.ndarray, n: int, bits: int) -> list[np.ndarray]:
    """The numbers of the words of packed phrases."""
    out = []
    for half, k in ((a, n - n // 2), (b, n // 2)):
        out += [(half >> _U(bits * (k - 1 - i))) & _ones(bits) for i in range(k)]
    return out


def _mark(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The place of a permuted phrase among the marks."""
    return (_stirred(a, _KEYS[2], 64) ^ _stirred(b, _KEYS[3], 64)) >> _U(64 - MARK_BITS)


def _filters(coded: DataFrame, n: int, bits: int, marks) -> DataFrame:
    """``source`` (the shard), ``range`` and ``filter``: the phrases of n words of each shard, counted."""
    left, right = _halves(n, bits)
    turn, known = Permutation(left, right), min(FAN_BITS, left)
    shorter = Permutation(*_halves(n - 1, bits)) if n > 2 else None

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor().decompress
        marked = np.frombuffer(marks.value, np.uint8) if shorter else None
        for batch in batches:
            for shard, z in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(open_(z.as_py()), np.uint32)
                if len(ids) < n:
                    continue
                size = len(ids) - n + 1
                whole = np.ones(size, bool)
                for k in range(n):
                    whole &= ids[k : k + size] > 0
                if shorter:
                    place = _mark(*shorter.of(*packed(ids - np.uint32(1), n - 1, bits)))
                    frequent = (marked[(place >> _U(3)).astype(np.int64)] >> (place & _U(7)).astype(np.uint8)) & 1 > 0
                    whole &= frequent[:-1] & frequent[1:]
                at = np.flatnonzero(whole)
                a, b = packed(ids - np.uint32(1), n, bits)
                entries = list(_cut(*summed(*turn.of(a[at], b[at]), None, right), left, right, known))
                if entries:
                    ranges, blobs = zip(*entries)
                    columns = [np.full(len(ranges), shard), np.array(ranges, np.int64)]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(blobs, pa.binary())], names=["source", "range", "filter"])

    return coded.mapInArrow(each, "source long, range long, filter binary")


def _merged(filters: DataFrame, n: int, bits: int, sources: int, least: int) -> DataFrame:
    """``ids`` (numbers of the words) and ``f`` of all phrases that occur ``least`` times.

    A group takes some 256 filters of one range of quotients. While more sources are left, its result is cut into
    narrower ranges and merged again, so groups stay as large as a shard's whole filter at any number of shards."""
    left, right = _halves(n, bits)

    def merge(known: int, narrower: int, last: bool):
        def each(group: pa.Table) -> pa.Table:
            range_ = group.column("range")[0].as_py()
            parts = [Filter.unpack(x.as_py(), left, right, known, range_) for x in group.column("filter")]
            a, b, counts = summed(*(np.concatenate(p) for p in zip(*parts)), right)
            if not last:
                ranges, blobs = zip(*_cut(a, b, counts, left, right, narrower))
                columns = [pa.array([group.column("source")[0].as_py()] * len(ranges), pa.int64()), pa.array(ranges, pa.int64())]
                return pa.table([*columns, pa.array(blobs, pa.binary())], names=["source", "range", "filter"])
            often = counts >= least
            words = unpacked(*Permutation(left, right).back(a[often], b[often]), n, bits)
            flat = np.stack(words, axis=1).astype(np.int64).ravel() if len(words) else np.zeros(0, np.int64)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, n), pa.int32()), pa.array(flat))
            mark = _mark(a[often], b[often]).astype(np.int64)
            return pa.table([listed, pa.array(counts[often]), pa.array(mark)], names=["ids", "f", "mark"])

        return each

    known = min(FAN_BITS, left)
    while True:
        groups = max(1, -(-sources >> FAN_BITS))
        last, narrower = groups == 1, min(known + FAN_BITS, left)
        dealt = filters.withColumn("source", F.pmod(F.xxhash64("source"), F.lit(groups)))
        schema = "ids array<long>, f long, mark long" if last else "source long, range long, filter binary"
        merged = written(dealt.groupBy("source", "range").applyInArrow(merge(known, narrower, last), schema), f"collocation-{n}")
        if last:
            return merged
        filters, sources, known = merged, groups, narrower


def _marks(grams: DataFrame) -> bytes:
    """A bitmap of the marks of all phrases; its size does not depend on them."""
    place = F.col("mark") + 1  # the functions count places from 1, in chunks of 4096 bytes
    chunks = grams.groupBy(F.bitmap_bucket_number(place).alias("c"))
    out = bytearray(1 << (MARK_BITS - 3))
    for row in chunks.agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).toLocalIterator():
        at = (row["c"] - 1) * 4096
        out[at : at + 4096] = row["bits"]
    return bytes(out)


def _scored(grams: DataFrame, known: DataFrame) -> DataFrame:
    """``ids``, ``f`` and of the lowest-scoring cut ``score``, ``k``, ``l``, ``r``; ``known`` has ``ids``, ``f`` of all phrases
    and words that are frequent."""
    n = F.size("ids")
    cuts = grams.select("ids", "f", F.explode(F.sequence(F.lit(1), n - 1)).alias("k"))
    cuts = cuts.withColumns({"head": F.slice("ids", F.lit(1), F.col("k")), "tail": F.slice("ids", F.col("k") + 1, n - F.col("k"))})
    parts = known.select(F.col("ids").alias("part"), F.col("f").alias("of_part"))
    with_l = cuts.join(parts, F.col("head") == F.col("part")).select("ids", "f", "k", "tail", F.col("of_part").alias("l"))
    both = with_l.join(parts, F.col("tail") == F.col("part")).select("ids", "f", "k", "l", F.col("of_part").alias("r"))
    score = F.expr("CAST(CAST(2000000 AS DECIMAL(7,0)) * CAST(f AS DECIMAL(19,0)) DIV CAST(l + r AS DECIMAL(19,0)) AS BIGINT)")
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return both.groupBy("ids", "f").agg(least).select("ids", "f", "best.*")


def _contained(grams: DataFrame) -> DataFrame:
    """``ids`` of shorter phrases and ``longest``, how often the most frequent longer one with them occurs."""
    n = F.size("ids")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), n - 1),
            lambda size: F.transform(F.sequence(F.lit(1), n - size + 1), lambda at: F.slice("ids", at, size)),
        )
    )
    return grams.filter(n > 2).select(F.explode(inner).alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("longest"))


def mine(docs: DataFrame, text_col: str, lang: Column, least: int = 30, most: int = 2000) -> DataFrame:
    """The best phrases of each language: ``lang``, ``rank`` (from 1), ``phrase``, ``a`` (how often it occurs), ``l`` and
    ``r`` (how often the parts of its lowest-scoring cut do), ``n`` (words of the language) and ``score``.

    Phrases have two to four words of one piece of text and occur ``least`` times; those that mostly occur inside a
    longer one are left out; ``most`` are reported per language. Null and empty texts have no words, repeated rows count
    again, ids and other columns have no effect, an empty table gives no rows. A null language is not reported.

    Texts are read once. Shuffled are a shard's distinct words, its coded text once, and its distinct phrases of frequent
    shorter ones, a few bytes each. Nothing of the vocabulary or the phrases is sent to all tasks but the marks."""
    shards = written(_shards(docs, text_col, lang), "collocation-shards")
    n_shards = shards.count()
    listed = shards.select(F.explode("words").alias("w")).groupBy("w.lang", "w.word").agg(F.sum("w.n").alias("f"))
    listed = written(listed.filter("lang is not null"), "collocation-words")
    totals = listed.groupBy("lang").agg(F.sum("f").alias("n"))
    often = listed.filter(F.col("f") >= least).withColumn("g", F.lit(""))
    vocabulary = placed(often, "g", [F.col("lang"), F.col("word")]).select("lang", "word", "f", F.col("pos").alias("id"))
    vocabulary = written(vocabulary, "collocation-vocabulary")
    bits = max(LEAST_BITS, (vocabulary.count() + 1).bit_length())
    if bits > MOST_BITS:
        raise ValueError(f"more than 2^{MOST_BITS} words occur {least} times")
    coded = written(_coded(shards, vocabulary), "collocation-texts")
    grams, marks = [], None
    for n in range(2, WORDS + 1):
        grams.append(_merged(written(_filters(coded, n, bits, marks), "collocation-filters"), n, bits, n_shards, least))
        if n < WORDS:
            marks = docs.sparkSession.sparkContext.broadcast(_marks(grams[-1]))
    phrases = grams[0].select("ids", "f")
    for more in grams[1:]:
        phrases = phrases.union(more.select("ids", "f"))
    known = phrases.union(vocabulary.select(F.array("id").alias("ids"), "f"))
    inside = _contained(phrases)
    kept = phrases.join(inside, "ids", "left").filter(
        "longest is null or CAST(100 AS DECIMAL(3,0)) * longest < CAST(80 AS DECIMAL(2,0)) * f"
    )
    scored = written(_scored(kept.select("ids", "f"), known), "collocation-scored")
    spelled = scored.select("ids", F.posexplode("ids").alias("i", "id")).join(vocabulary.select("id", "lang", "word"), "id")
    spelled = spelled.groupBy("ids").agg(
        F.first("lang").alias("lang"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "word"))), lambda w: w["word"].cast("string")), " ").alias("phrase")
    )
    rows = scored.join(spelled, "ids").join(totals, "lang")
    best = (F.desc("score"), F.desc("f"), F.col("phrase"))
    # The best of each of some parts of a language first, so that the last task of a language has few rows at any size.
    part = Window.partitionBy("lang", "part").orderBy(*best)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(RANKED_PARTS)))
    rows = rows.withColumn("place", F.row_number().over(part)).filter(F.col("place") <= most)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best))
    ranked = rows.withColumn("rank", rank).filter(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("f").alias("a"), "l", "r", "n", "score")
