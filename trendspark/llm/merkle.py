"""Merkle manifest of a dataset: checkpoint every few levels, recompute the rest for proofs.

Each row of documents is a leaf. Leaves of a source, in order of doc_id, form a tree whose nodes hash 16 neighbours;
the tops of the sources' trees, in order of source, form one more tree. Every second level is stored. A stored node
and the (at most 256) stored nodes under it are an aligned subtree: a proof hashes the level between them again from
the stored descendants, takes the siblings it needs and drops it.

Places in a tree are counted in ranges of (source, doc_id) that all tasks share, so a source with most of the rows
is numbered, hashed and proven by many tasks; no group holds more than 256 nodes.

Defined cases: a null in any of the five columns hashes as ``-``, so it differs from an empty text; null doc_ids come
first, rows of one doc_id go by their leaf; a null source is a tree of its own, the first; an empty table has no root
and no proofs; other columns are not part of a leaf.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, stored

FAN = 16
#: Levels from one stored level to the next.
KEPT_EVERY = 2
BLOCK = FAN**KEPT_EVERY

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def leaf(text: Column) -> Column:
    """The hash of a row with ``text`` in the place of its text."""
    values = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]

    def field(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[field(value) for value in values]), 256)


def tampered(text: Column) -> Column:
    """The text with A-Z lower-cased where 5 divides the crc32 of the doc_id (never where that is null)."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return F.when(hit, F.translate(text, _UPPER, _UPPER.lower())).otherwise(text)


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``pos`` of each row in its ``tree`` by ``order``, from 0, and ``n``, the rows of that tree."""
    ranges = partitions(nodes.sparkSession)
    dealt = stored(
        nodes.repartitionByRange(ranges, "tree", *order).withColumn("part", F.spark_partition_id()), "ranges"
    )
    sizes = dealt.groupBy("part", "tree").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "part",
        "tree",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"),
        F.sum("size").over(Window.partitionBy("tree")).alias("n"),
    )
    within = F.row_number().over(Window.partitionBy("part", "tree").orderBy(*order))
    placed = dealt.withColumn("within", within).join(starts, ["part", "tree"])
    return placed.withColumn("pos", F.col("start") + F.col("within") - 1).drop("part", "start", "within")


def _runs(nodes: Column) -> Column:
    """The hashes of 16 neighbours each."""
    firsts = F.sequence(F.lit(1), F.size(nodes), F.lit(FAN))
    return F.transform(firsts, lambda first: F.sha2(F.array_join(F.slice(nodes, first, F.lit(FAN)), ""), 256))


def _subtrees(level: DataFrame, *carried: str) -> DataFrame:
    """One row for each aligned subtree under a stored node, with the levels between in ``level_0`` and on.

    A level is null where the tree has reached its top below it.
    """
    row = F.struct("pos", "node", *carried)
    grouped = level.groupBy("tree", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(row)).alias("rows")
    )
    out = grouped.withColumn("level_0", F.col("rows.node"))
    for k in range(KEPT_EVERY):
        up = F.when(F.col("n") > FAN**k, _runs(F.col(f"level_{k}")))
        out = out.withColumn(f"level_{k + 1}", up)
    return out


def _raised(level: DataFrame) -> DataFrame:
    """The next stored level."""
    tops = [F.element_at(f"level_{k}", 1) for k in range(KEPT_EVERY, -1, -1)]
    return _subtrees(level).select(
        "tree",
        F.col("block").alias("pos"),
        F.ceil(F.col("n") / BLOCK).alias("n"),
        F.coalesce(*tops).alias("node"),
    )


def checkpoints(leaves: DataFrame) -> list[DataFrame]:
    """The stored levels over ``leaves`` (tree, pos, n, node); the last has one node for each tree."""
    levels = [leaves]
    while (levels[-1].agg(F.max("n")).first()[0] or 0) > 1:
        levels.append(stored(_raised(levels[-1]), f"level_{len(levels) * KEPT_EVERY}"))
    return levels


def _siblings(at: Column) -> Column:
    """What stands left and right of node ``at`` (from 0) of a subtree in its run, on each level."""

    def of(k: int) -> Column:
        place = F.floor(at / FAN**k).cast("int")
        nodes, inside = F.col(f"level_{k}"), place % FAN
        left = F.array_join(F.slice(nodes, place - inside + 1, inside), "")
        right = F.array_join(F.slice(nodes, place + 2, F.lit(FAN - 1) - inside), "")
        return F.struct(left.alias("left"), right.alias("right"))

    steps = [F.when(F.col("n") > FAN**k, of(k)) for k in range(KEPT_EVERY)]
    return F.filter(F.array(*steps), lambda step: step.isNotNull())


def _below(level: DataFrame, above: DataFrame, *carried: str) -> DataFrame:
    """The proofs of a stored level's nodes from those of the next one (tree, pos, path, and what goes down)."""
    blocks = _subtrees(level, *carried).join(above.withColumnRenamed("pos", "block"), ["tree", "block"])
    kept = [c for c in above.columns if c not in ("tree", "pos", "path")]
    opened = blocks.select("*", F.posexplode("rows").alias("at", "row"))
    return opened.select(
        "tree",
        F.col("row.pos").alias("pos"),
        F.col("row.node").alias("node"),
        *[F.col(f"row.{c}").alias(c) for c in carried],
        F.concat(_siblings(F.col("at")), "path").alias("path"),
        *kept,
    )


@dataclass
class Manifest:
    """The stored levels of the sources' trees and of the tree over them."""

    documents: list[DataFrame]
    sources: list[DataFrame]

    def root(self) -> str | None:
        found = self.sources[-1].first()
        return found and found["node"]

    def proofs(self) -> DataFrame:
        """doc_id, node (its leaf), seen, path (left, right from the leaf up), subroot, root of every row."""
        none = F.array().cast("array<struct<left: string, right: string>>")
        paths = self.sources[-1].select("tree", "pos", F.col("node").alias("root"), none.alias("path"))
        for level in self.sources[-2:0:-1]:
            paths = stored(_below(level, paths).drop("node"), "proofs")
        if len(self.sources) > 1:
            paths = _below(self.sources[0], paths, "name")
        else:
            paths = paths.join(self.sources[0].select("tree", "pos", "node", "name"), ["tree", "pos"])
        paths = paths.select(
            F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), F.col("node").alias("subroot"), "root", "path"
        )
        for level in self.documents[-2:0:-1]:
            paths = stored(_below(level, paths).drop("node"), "proofs")
        if len(self.documents) > 1:
            return _below(self.documents[0], paths, "doc_id", "seen")
        return self.documents[0].join(paths, ["tree", "pos"]).drop("n")


def manifest(docs: DataFrame, presented: Column | None = None) -> Manifest:
    """Hash every row and store the checkpoints.

    ``presented`` is the text that a reader was given; the leaf over it is kept as ``seen`` for the check.
    """
    text = F.col("text")
    own = leaf(text)
    other = own if presented is None else F.when(presented.eqNullSafe(text), own).otherwise(leaf(presented))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("1"), F.col("source")), F.lit("0")).alias("tree"),
        own.alias("node"),
        other.alias("seen"),
    )
    # Stored before it is dealt out: finding the ranges would read and hash the texts once more.
    leaves = stored(numbered(stored(rows, "leaves"), ["doc_id", "node"]), "level_0")
    levels = checkpoints(leaves)
    tops = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node")
    return Manifest(levels, checkpoints(stored(numbered(tops, ["name"]), "subroots")))


def folded(proofs: DataFrame) -> DataFrame:
    """``proofs`` with the root that the seen leaf and the path give."""
    up = F.aggregate(
        "path", F.col("seen"), lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256)
    )
    return proofs.withColumn("folded_root", up)


def verified(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row, a fifth of them tampered with."""
    proofs = folded(manifest(docs, tampered(F.col("text"))).proofs())
    siblings = F.array_join(F.transform("path", lambda step: F.concat(step["left"], step["right"])), "")
    return proofs.select(
        "doc_id",
        F.col("node").alias("leaf"),
        "subroot",
        "root",
        F.sha2(siblings, 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
