"""Near-duplicate documents by one-permutation MinHash.

Every shingle of a text is hashed once; the hash's first bits choose a bin and the bin keeps its smallest hash. Empty
bins are filled by optimal densification: each asks other bins, in an order of its own, until one has a value. Bands of
bins are bucket keys. In a bucket every text is a candidate of one hub only, and of its hubs it takes the one it meets
in most buckets, so there is at most one star edge per text. Links are confirmed on full shingle sets. Where a bucket
still holds several components after that, its texts outside the largest one are compared with all its texts, again on
full sets and inside the task, so that no link in a bucket is lost and no pairs are listed. Both sides are dealt to
blocks, and each two blocks meet once. In a bucket of more than one block, texts that cannot be linked with any other
are known before by their rarest shingles, and stay out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import written
from quillspark.llm.graph import components

BATCH_ROWS = 500
#: Texts of one bucket that meet in one task, on either side; larger buckets are dealt to several.
BLOCK_ROWS = 2048
#: About so many texts, and at most so many of their shingles, tell which shingles are frequent. Results do not depend on it.
ORDERING_TEXTS, ORDERING_SHINGLES = 1024, 1 << 18

BINS_LOG = 7
BINS = 1 << BINS_LOG
_STARTS = (np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS_LOG))
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Bins that an empty bin asks, in order.
_ASKS = np.random.default_rng(7).integers(0, BINS, (64 * BINS, BINS))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _A
    h = (h ^ (h >> np.uint64(29))) * _B
    return h ^ (h >> np.uint64(32))


@dataclass(frozen=True)
class Settings:
    """Shingles of ``words`` words; links where ``100 * intersection >= percent * union``. With 32 bands of 4 bins a pair
    at 85 percent shares no bucket with a chance of 5e-11, a pair at 80 percent of 5e-8."""

    words: int = 5
    percent: int = 80
    bands: int = 32


def normalised(text: str | bytes | None) -> bytes:
    """The words with A-Z in lower case, one space between."""
    data = text.encode() if isinstance(text, str) else text or b""
    return b" ".join(data.lower().split())


def shingle_set(normal: bytes, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a shorter text is one shingle, an empty one has none."""
    words = normal.split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(n, len(h))
    s = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        s = _mixed(s * _B + h[i : len(h) - k + 1 + i])
    return np.unique(s)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest hash of each bin, densified; for sets with at least one shingle."""
    at = np.searchsorted(shingles, _STARTS)
    ends = np.append(at[1:], len(shingles))
    full = at < ends
    values = shingles[np.minimum(at, len(shingles) - 1)]
    empty = np.flatnonzero(~full)
    if len(empty):
        asked = _ASKS[:64, empty]
        hit = full[asked]
        first = hit.argmax(axis=0)
        source = asked[first, np.arange(len(empty))]
        for i in np.flatnonzero(~hit.any(axis=0)):  # very few bins are full: ask on
            source[i] = next((b for b in _ASKS[64:, empty[i]] if full[b]), np.flatnonzero(full)[0])
        values[empty] = values[source]
    return values


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    """One bucket key per band; a key tells its band."""
    rows = sig.reshape(bands, -1)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for column in rows.T:
        keys = _mixed(keys * _B + column)
    return keys.view(np.int64)


def similar(common: np.ndarray, a: np.ndarray | int, b: np.ndarray | int, percent: int) -> np.ndarray:
    return 100 * common >= percent * (a + b - common)


def _digested(docs: DataFrame, settings: Settings) -> DataFrame:
    """``id``, ``n_shingles``, ``key`` (of the text) and ``bands`` for rows ``id`` and ``text``."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                sizes, keys, bands = [], [], []
                for text in batch.column(1):
                    normal = normalised(text.as_py())
                    shingles = shingle_set(normal, settings.words)
                    sizes.append(len(shingles))
                    keys.append(xxhash.xxh3_128_digest(normal) if len(shingles) else None)
                    bands.append(band_keys(signature(shingles), settings.bands) if len(shingles) else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["id", "n_shingles", "key", "bands"],
                )

    rows = docs.select("id", F.col("text").cast("binary"))
    return rows.mapInArrow(each, "id long, n_shingles long, key binary, bands array<long>")


def _compressed(docs: DataFrame) -> DataFrame:
    """``id`` and ``z``, the normalised text, compressed for shuffles."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                z = pa.array([squeeze(normalised(t.as_py())) for t in batch.column(1)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), z], names=["id", "z"])

    return docs.select("id", F.col("text").cast("binary")).mapInArrow(each, "id long, z binary")


def _confirmed(pairs: DataFrame, settings: Settings) -> DataFrame:
    """Rows (``a``, ``b``) of ``pairs`` (``a``, ``za``, ``b``, ``zb``) that are similar enough on full sets."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor().decompress
        last, of_last = None, np.zeros(0, np.uint64)
        for batch in batches:
            kept = []
            for za, b, zb in zip(*(batch.column(i) for i in (1, 2, 3)), strict=True):
                if b.as_py() != last:
                    last, of_last = b.as_py(), shingle_set(open_(zb.as_py()), settings.words)
                mine = shingle_set(open_(za.as_py()), settings.words)
                common = np.intersect1d(mine, of_last, assume_unique=True).size
                kept.append(bool(similar(common, len(mine), len(of_last), settings.percent)))
            linked = batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))
            yield linked

    return pairs.select("a", "za", "b", "zb").mapInArrow(each, "a long, b long")


def _shingles(texts: DataFrame, settings: Settings) -> DataFrame:
    """``shingle``, once for every text that has it, for rows ``z``."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for z in batch.column(0):
                shingles = shingle_set(open_(z.as_py()), settings.words)
                yield pa.RecordBatch.from_arrays([pa.array(shingles.view(np.int64))], names=["shingle"])

    return texts.select("z").mapInArrow(each, "shingle long")


def _prefixes(texts: DataFrame, frequent, settings: Settings) -> DataFrame:
    """The rarest shingles of each text (``id``, ``root``, ``z``), in one order for all texts: ``shingle``, ``id``,
    ``root``, ``size`` of the set, shingles ``left`` from here on, and ``short``, whether it is in the shorter prefix.

    Let a link be of x and y, x not larger, and w their first common shingle. All they have in common lies in what is
    left of each from w on, and is at least percent of y and 2 percent / (100 + percent) of x; so w is in the longer
    prefix of y and in the shorter one of x."""
    percent = settings.percent

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor().decompress
        known, counts = frequent.value
        for batch in batches:
            for id_, root, z in zip(*batch.columns, strict=True):
                shingles = shingle_set(open_(z.as_py()), settings.words)
                size = len(shingles)
                weight = np.zeros(size, np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
                    weight = np.where(known[at] == shingles, counts[at], 0)
                long = size + percent * size // -100 + 1
                short = size + 2 * percent * size // -(100 + percent) + 1
                taken = shingles[np.lexsort((shingles, weight))[:long]]
                places = np.arange(len(taken))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(taken.view(np.int64)),
                        pa.array(np.full(len(taken), id_.as_py())),
                        pa.array(np.full(len(taken), root.as_py())),
                        pa.array(np.full(len(taken), size)),
                        pa.array(size - places),
                        pa.array(places < short),
                    ],
                    names=["shingle", "id", "root", "size", "left", "short"],
                )

    schema = "shingle long, id long, root long, size long, left long, short boolean"
    return texts.select("id", "root", "z").mapInArrow(each, schema)


def _linkable(members: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """``id`` of all ``members`` (``id``, ``root``) that may be linked with one of another root; the others are not."""
    spark = members.sparkSession
    own = written(members.join(texts, "id"), "neardup-crowded")
    step = -(-own.count() // ORDERING_TEXTS)
    some = _shingles(own.filter(F.pmod(F.xxhash64("id"), F.lit(max(1, step))) == 0), settings)
    often = some.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1")
    often = often.orderBy(F.col("n").desc(), "shingle").limit(ORDERING_SHINGLES).collect()
    known = np.array([r["shingle"] for r in often], np.int64).view(np.uint64)
    order = np.argsort(known)
    frequent = spark.sparkContext.broadcast((known[order], np.array([r["n"] for r in often], np.int64)[order]))
    rows = written(_prefixes(own, frequent, settings), "neardup-prefixes")
    short = F.when(F.col("short"), F.struct("root", "size"))
    groups = rows.groupBy("shingle").agg(
        F.min("root").alias("lowest"),
        F.max("root").alias("highest"),
        F.min(short["root"]).alias("short_lowest"),
        F.max(short["root"]).alias("short_highest"),
        F.min(short["size"]).alias("smallest"),
        F.max(short["size"]).alias("largest"),
    )
    groups = written(groups.filter("lowest < highest and short_lowest is not null"), "neardup-shared")
    p = settings.percent
    as_smaller = "short and (root != lowest or root != highest)"
    as_larger = (
        f"(root != short_lowest or root != short_highest) and smallest <= size and 100 * largest >= {p} * size "
        f"and 100 * {100 + p} * left >= {p} * (greatest(100 * smallest, {p} * size) + 100 * size)"
    )
    return written(rows.join(groups, "shingle").filter(f"({as_smaller}) or ({as_larger})").select("id").distinct(), "neardup-linkable")


def _dealt(unsettled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of the comparisons in buckets (``bucket``, ``id``, ``root``, ``largest``, ``z``; ``n`` texts, ``outside``
    of them not in the largest component), by ``bucket``, ``block`` and ``part``.

    Texts outside the largest component are dealt to the first blocks and the others to further ones, of about
    ``BLOCK_ROWS``; a small bucket is one block. A part asks its own block and all that follow."""
    parts, blocks = (F.ceil(c / BLOCK_ROWS).cast("int") for c in (F.col("outside"), F.col("n") - F.col("outside")))
    single, outside = F.col("n") <= BLOCK_ROWS, F.col("root") != F.col("largest")
    hashed = F.xxhash64("id")
    block = F.when(single, 0).when(outside, F.pmod(hashed, parts)).otherwise(parts + F.pmod(hashed, blocks)).cast("int")
    rows = unsettled.select("bucket", "id", "root", "z", outside.alias("outside"), block.alias("block"),
                            F.when(single, 0).otherwise(parts - 1).alias("last_part"),
                            F.when(single, 0).otherwise(parts + blocks - 1).alias("last_block"))
    meets = F.explode(F.sequence(F.lit(0), F.least("block", "last_part"))).alias("part")
    index = rows.filter("last_part >= 0").select("bucket", "block", meets, "id", "root", "outside", "z")
    asked = rows.filter("outside").select(
        F.col("bucket").alias("of_bucket"),
        F.explode(F.sequence("block", "last_block")).alias("of_block"),
        F.col("block").alias("of_part"),
        *(F.col(c).alias(f"asked_{c}") for c in ("id", "root", "z")),
    )
    return index, asked


def _resolve(settings: Settings):
    """Links between texts of one bucket in different components: every asked text against every text of the block. Where
    a part meets its own block, of two asked texts the one with the larger id asks."""

    def search(key: tuple, block: pa.Table, asked: pa.Table) -> pa.Table:
        links_a, links_b = [], []
        if len(block) and len(asked):
            open_ = zstandard.ZstdDecompressor().decompress
            sets = [shingle_set(open_(z), settings.words) for z in block["z"].to_pylist()]
            ids, roots = block["id"].to_numpy(), block["root"].to_numpy()
            once = block["outside"].to_numpy(zero_copy_only=False) if key[1] == key[2] else np.zeros(len(ids), bool)
            sizes = np.array([len(s) for s in sets])
            everything = np.concatenate(sets)
            order = np.argsort(everything, kind="stable")
            owner = np.repeat(np.arange(len(sets)), sizes)[order]
            everything = everything[order]
            leader: dict[int, int] = {}

            def lead(root: int) -> int:
                while root in leader:
                    root = leader[root]
                return root

            for a, root, z in zip(*(asked[f"asked_{c}"].to_pylist() for c in ("id", "root", "z")), strict=True):
                mine = shingle_set(open_(z), settings.words)
                lo, hi = np.searchsorted(everything, mine), np.searchsorted(everything, mine, side="right")
                length = hi - lo
                # all places lo..hi of all shingles in a row
                places = np.repeat(hi - np.cumsum(length), length) + np.arange(length.sum())
                common = np.bincount(owner[places], minlength=len(sets))
                other = (roots != root) & (~once | (ids < a))
                near = np.flatnonzero(similar(common, sizes, len(mine), settings.percent) & other)
                for i in near:
                    one, two = lead(root), lead(int(roots[i]))
                    if one != two:
                        leader[max(one, two)] = min(one, two)
                        links_a.append(a)
                        links_b.append(int(ids[i]))
        return pa.table({"a": pa.array(links_a, pa.int64()), "b": pa.array(links_b, pa.int64())})

    return search


def near_duplicates(docs: DataFrame, id_col: str, text_col: str, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_shingles``, ``component_id`` (the smallest id reachable over links) and
    ``kept`` (whether that is its own).

    Ids are whole numbers. A null or empty text, or one of white space, has no shingles and is linked with nothing. Rows
    with a null id come back with a null component, and kept. Rows that repeat an id each come back. Other columns have
    no effect, an empty table gives an empty one.

    Equal texts are one text from the start, with the smallest id; only distinct texts are hashed into buckets. Sums
    are partial before each shuffle, large buckets are dealt to blocks, and texts travel compressed, and only those
    that share a bucket with another one."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    digests = written(_digested(rows, settings), "neardup-digests")
    named = digests.filter("id is not null and key is not null")
    classes = written(
        named.groupBy("key").agg(F.min("id").alias("rep"), F.first("bands").alias("bands")), "neardup-classes"
    )
    memberships = classes.select("rep", F.explode("bands").alias("bucket"))
    buckets = memberships.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    members = written(memberships.join(buckets, "bucket").select("bucket", "rep", "hub", "n"), "neardup-members")

    needed = members.select(F.col("rep").alias("id")).distinct()
    texts = written(_compressed(rows.filter("id is not null")).join(needed, "id", "left_semi").dropDuplicates(["id"]), "neardup-texts")
    votes = members.filter("rep != hub").groupBy("rep", "hub").agg(F.count("*").alias("votes"))
    best = votes.groupBy("rep").agg(F.max(F.struct("votes", (-F.col("hub")).alias("hub"))).alias("best"))
    edges = best.select(F.col("rep").alias("a"), (-F.col("best.hub")).alias("b"))
    pairs = edges.join(texts.select(F.col("id").alias("a"), F.col("z").alias("za")), "a")
    pairs = pairs.join(texts.select(F.col("id").alias("b"), F.col("z").alias("zb")), "b")
    star = written(_confirmed(pairs, settings), "neardup-links")
    roots = components(star)

    labelled = members.join(roots, members["rep"] == roots["node"], "left")
    labelled = labelled.select("bucket", "n", F.col("rep").alias("id"), F.coalesce("root", "rep").alias("root"))
    by_root = labelled.groupBy("bucket", "root").agg(F.count("*").alias("size"))
    open_buckets = by_root.groupBy("bucket").agg(F.count("*").alias("roots"), F.max(F.struct("size", "root")).alias("top"))
    open_buckets = open_buckets.filter("roots > 1").select("bucket", F.col("top.root").alias("largest"), F.col("top.size").alias("size"))
    unsettled = labelled.join(open_buckets, "bucket").withColumn("outside", F.col("n") - F.col("size")).drop("size")
    unsettled = written(unsettled, "neardup-unsettled")
    crowded = unsettled.filter(F.col("n") > BLOCK_ROWS)
    if not crowded.isEmpty():
        linkable = _linkable(crowded.select("id", "root").distinct(), texts, settings)
        crowded = written(crowded.drop("n", "outside").join(linkable, "id", "left_semi"), "neardup-crowded")
        sizes = crowded.groupBy("bucket").agg(F.count("*").alias("n"), F.count_if(F.col("root") != F.col("largest")).alias("outside"))
        unsettled = unsettled.filter(F.col("n") <= BLOCK_ROWS).unionByName(crowded.join(sizes, "bucket"))
    index, asked = _dealt(unsettled.join(texts, "id"))
    found = index.groupBy("bucket", "block", "part").cogroup(asked.groupBy("of_bucket", "of_block", "of_part"))
    more = written(found.applyInArrow(_resolve(settings), "a long, b long"), "neardup-links")
    final = components(star.union(more))

    of_class = classes.join(final, classes["rep"] == final["node"], "left")
    of_class = of_class.select("key", F.coalesce("root", "rep").alias("component"))
    out = digests.join(of_class, "key", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def kept_documents(docs: DataFrame, id_col: str, text_col: str, settings: Settings = Settings()) -> DataFrame:
    """One row of ``docs`` for each component; the columns stay. Rows without an id stay, and of rows that repeat id and
    text one does."""
    kept = near_duplicates(docs, id_col, text_col, settings).filter("kept").select(F.col(id_col).alias("_kept_id"))
    ids = kept.filter("_kept_id is not null").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text"))
    named = rows.join(ids, rows["id"] == ids["_kept_id"], "left_semi").dropDuplicates(["id", "text"])
    return named.unionByName(rows.filter("id is null")).select("doc.*")
