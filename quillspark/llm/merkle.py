"""A manifest of a data set: every row is a leaf of a hash tree, and a short proof ties it to the root.

Leaves of a source form a tree, the roots of the sources form another. Of a tree only every second level is stored
(leaves, then nodes over 256 of them, over 65,536, ...). A proof needs all levels: the aligned subtree between two stored
levels is put together from its stored descendants, its missing nodes are hashed again, the siblings are emitted, and the
nodes are forgotten. No subtree has more than 256 stored descendants, so no row, group or task grows with a source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import bind, written

#: Nodes that are hashed into one.
ARITY = 16
#: Stored descendants of an aligned subtree: two levels of them.
SUBTREE = ARITY * ARITY

_LEVEL = "struct<left:string,right:string>"
_NO_LEVELS = f"CAST(array() AS array<{_LEVEL}>)"


def digest(value: Column) -> Column:
    """Lowercase hex sha256 of a text."""
    return F.sha2(value.cast("binary"), 256)


def leaf_of(*fields: Column) -> Column:
    """The digest of a row: each field as its length in bytes, a colon and its text, or ``-`` where it is null."""
    texts = [f.cast("string") for f in fields]
    return digest(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda node, level: digest(F.concat(level["left"], node, level["right"])))


def siblings_digest(proof: Column) -> Column:
    """The digest of all siblings of a proof, from the leaf's to the root's."""
    return digest(F.array_join(F.transform(proof, lambda level: F.concat(level["left"], level["right"])), ""))


def height_of(total: Column) -> Column:
    """How often runs must be hashed until ``total`` nodes are one."""
    return F.size(F.filter(F.array(*(F.lit(ARITY**i) for i in range(15))), lambda p: p < total))


def placed(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``rows`` with ``pos``, from 0 in each group of ``group`` (without nulls) by ``order``, and ``total`` of the group.

    Rows are dealt by ranges of group and order and numbered within a part; only one row per part and group is added up,
    so a group may be as large as the table."""
    sorted_ = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    numbered = written(sorted_.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "placed")
    firsts = numbered.groupBy("part", group).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    own = Window.partitionBy(group)
    before = F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = firsts.select("part", group, (before - F.col("first")).alias("shift"), F.sum("n").over(own).alias("total"))
    return numbered.join(starts, ["part", group]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _joined(nodes: Column, start: Column, n: Column) -> Column:
    return F.array_join(F.slice(nodes, start + 1, n), "")


def _runs(nodes: Column) -> Column:
    """The nodes over each run of nodes."""
    each = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / ARITY).cast("int"))
    return F.transform(each, lambda i: digest(_joined(nodes, i * ARITY, F.lit(ARITY))))


def _level(nodes: Column, i: Column) -> Column:
    """The siblings of the i-th node in its run."""
    inside = i % ARITY
    return F.struct(_joined(nodes, i - inside, inside).alias("left"), _joined(nodes, i + 1, ARITY - 1 - inside).alias("right"))


def _with_levels(nodes: Column, columns: list[str]):
    """``items``, the entries of an aligned subtree, each with its siblings below the subtree's root, from the nodes over
    its runs."""

    def of(runs: Column) -> Column:
        def each(item: Column, i: Column) -> Column:
            one = F.array(_level(nodes, i))
            two = F.concat(one, F.array(_level(runs, F.floor(i / ARITY).cast("int"))))
            own = F.when(F.col("todo") == 0, F.expr(_NO_LEVELS)).when(F.col("todo") == 1, one).otherwise(two)
            return F.struct(item["pos"].alias("pos"), *(item[c].alias(c) for c in columns), own.alias("own"))

        return F.transform(F.col("items"), each)

    return of


@dataclass
class Tree:
    """Stored levels of the trees of all groups, from the leaves on: ``g``, ``pos``, ``digest``, ``height``.

    A group whose tree ends below a stored level stands there with its root. The last level has one row per group."""

    levels: list[DataFrame]

    @classmethod
    def build(cls, leaves: DataFrame) -> Tree:
        """Trees over ``leaves``: ``g``, ``pos``, ``total``, ``digest`` and whatever else shall come with a proof."""
        levels = [written(leaves.withColumn("height", height_of(F.col("total"))).drop("total"), "merkle-leaves")]
        highest = levels[0].agg(F.max("height")).first()[0] or 0
        while 2 * len(levels) - 2 < highest:
            blocks = cls._blocks(levels[-1], len(levels) - 1, ["digest"])
            nodes = F.col("items.digest")
            top = F.when(F.col("todo") == 0, F.element_at(nodes, 1)).otherwise(
                bind(_runs(nodes), lambda runs: F.when(F.col("todo") == 1, F.element_at(runs, 1)).otherwise(digest(F.array_join(runs, ""))))
            )
            levels.append(written(blocks.select("g", F.col("block").alias("pos"), top.alias("digest"), "height"), "merkle-level"))
        return cls(levels)

    @staticmethod
    def _blocks(level: DataFrame, k: int, columns: list[str]) -> DataFrame:
        """One row per aligned subtree over the k-th stored level; ``todo`` levels lie above it, two at most."""
        items = F.sort_array(F.collect_list(F.struct("pos", *columns))).alias("items")
        blocks = level.groupBy("g", F.floor(F.col("pos") / SUBTREE).alias("block")).agg(items, F.first("height").alias("height"))
        return blocks.withColumn("todo", F.greatest(F.lit(0), F.least(F.lit(2), F.col("height") - 2 * k)))

    def roots(self) -> DataFrame:
        """``g`` and ``digest`` of each group."""
        return self.levels[-1].select("g", "digest")

    def proofs(self, above: DataFrame) -> DataFrame:
        """A row per leaf: its columns, ``proof`` (an array of left and right siblings, from the leaf's run on) and the
        columns of ``above``, which has a row per group: ``g``, ``proof`` from the group's root on, and others."""
        found = self.levels[-1].select("g", "pos").join(above, "g")
        carried = [c for c in above.columns if c not in ("g", "proof")]
        for k in range(len(self.levels) - 2, -1, -1):
            columns = [c for c in self.levels[k].columns if c not in ("g", "pos", "height")]
            blocks = self._blocks(self.levels[k], k, columns)
            upper = found.select("g", F.col("pos").alias("block"), F.col("proof").alias("upper"), *carried)
            nodes = F.col("items.digest")
            rows = blocks.join(upper, ["g", "block"]).select("g", "upper", *carried, F.inline(bind(_runs(nodes), _with_levels(nodes, columns))))
            found = rows.select("g", "pos", *columns, *carried, F.concat("own", "upper").alias("proof"))
        if len(self.levels) == 1:  # every group is a single leaf
            return self.levels[0].drop("height").join(found.drop("pos"), "g")
        return found


@dataclass
class Manifest:
    """The trees of the sources, and the tree over their roots."""

    sources: Tree
    whole: Tree

    @classmethod
    def build(cls, docs: DataFrame, source: Column, order: Column, leaf: Column, keep: dict[str, Column]) -> Manifest:
        """``leaf`` is a digest per row; rows of a source ascend by ``order`` (nulls first, ties by leaf), sources by
        their bytes (null first). ``keep`` are further columns, by new names, that come with the proofs."""
        g = F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))
        rows = docs.select(g.alias("g"), order.alias("o"), leaf.alias("digest"), *(c.alias(n) for n, c in keep.items()))
        rows = rows.withColumn("row", F.monotonically_increasing_id())
        leaves = placed(rows, "g", [F.col("o").asc_nulls_first(), F.col("digest"), F.col("row")]).drop("o", "row")
        sources = Tree.build(leaves)
        roots = sources.roots().select(F.lit("").alias("g"), F.col("g").alias("source"), "digest")
        return cls(sources, Tree.build(placed(roots, "g", [F.col("source")])))

    def root(self) -> DataFrame:
        """One row, ``digest``; none for an empty table."""
        return self.whole.roots().select("digest")

    def proofs(self) -> DataFrame:
        """A row per document: ``digest`` (the leaf), the columns kept, ``subroot``, ``root`` and ``proof``."""
        top = self.whole.roots().select("g", F.col("digest").alias("root"), F.expr(_NO_LEVELS).alias("proof"))
        above = self.whole.proofs(top).select(F.col("source").alias("g"), F.col("digest").alias("subroot"), "root", "proof")
        return self.sources.proofs(above).drop("g", "pos")


def document_leaf(text: Column) -> Column:
    """The leaf of a row of ``documents`` whose text is ``text``."""
    return leaf_of(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)


def verified(docs: DataFrame, tampered: Column, text: Column) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root and proof_sha256 as the table is, ``folded_root`` from the
    proof and the leaf with ``text`` where ``tampered``, and whether that is the root.

    Nulls are values of their own in a leaf, null sources a source, null ids come first. Rows that repeat an id are
    leaves of their own, ordered by digest; equal rows are interchangeable. Texts are read once, and only digests are
    shuffled. Columns that are not part of a leaf have no effect. An empty table gives no rows."""
    plain = document_leaf(F.col("text"))
    seen = F.when(F.coalesce(tampered, F.lit(False)), document_leaf(text)).otherwise(plain)
    manifest = Manifest.build(docs, F.col("source"), F.col("doc_id"), plain, {"doc_id": F.col("doc_id"), "seen": seen})
    rows = manifest.proofs().withColumn("folded_root", folded(F.col("seen"), F.col("proof")))
    return rows.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", siblings_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
