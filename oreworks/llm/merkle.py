"""Merkle manifest of a table: a tree for every group of rows, and a tree over the groups' roots.

A leaf is the SHA-256 of a row's fields; `FAN` consecutive nodes become the SHA-256 of their digests
(as hexadecimal text) until one is left. Only every `KEPT`-th level is stored. What lies between is
made again when proofs are extracted: the stored nodes of one aligned subtree (at most FAN ** KEPT)
come together, the levels above them are recomputed, every node takes its siblings from them, and they
are dropped. Proofs come from the top down: a subtree's proofs end in that of its root.

A row's place in its tree is found without sorting a tree in one task: rows are sorted by ranges over
all trees, counted by range and tree, and a row's place is its place in its range plus the counts
before. A tree that holds a third of all rows is many ranges and many subtrees.

Defined cases: a null field is `-`, so it differs from an empty one. A tree's name is null, empty or
any text; null comes first, the others in bytewise order. Rows ascend by the order columns, null
first, equal ones by digest; rows equal in both are interchangeable. A tree of one leaf has that leaf
as its root. A table without rows has no root and no proofs. Columns beyond those named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreworks.llm.storage import cut

FAN = 8
KEPT = 3
DEEPEST = 21  # FAN ** DEEPEST places are beyond 64 bits
_RANGE_BITS = 33  # monotonically_increasing_id: the partition's number lies above


def leaf(*fields: Column) -> Column:
    """The digest of a row: every field as its length in bytes, a colon and its text, or `-`."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def tree_name(group: Column) -> Column:
    """A group as text that sorts null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def _up(digests: Column) -> Column:
    """The level above consecutive digests."""
    runs = F.sequence(F.lit(0), F.ceil(F.size(digests) / FAN).cast("int") - 1)
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(digests, i * FAN + 1, FAN), ""), 256))


def _height(size: Column) -> Column:
    return sum((F.when(size > FAN**h, 1).otherwise(0) for h in range(DEEPEST)), F.lit(0))


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows (tree, digest and others) with their place in their tree, and the tree's height."""
    by = ["tree", *order, "digest"]
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*by, "row")
    placed = cut(dealt.sortWithinPartitions(*by).withColumn("row", F.monotonically_increasing_id()))
    placed = placed.withColumn("range", F.shiftright("row", _RANGE_BITS))
    counts = placed.groupBy("tree", "range").agg(F.min("row").alias("first"), F.count("*").alias("rows"))
    whole = Window.partitionBy("tree")
    before = F.coalesce(F.sum("rows").over(whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("tree", "range", (before - F.col("first")).alias("shift"), _height(F.sum("rows").over(whole)).alias("height"))
    found = placed.join(starts, ["tree", "range"]).withColumn("place", F.col("row") + F.col("shift"))
    return found.drop("row", "range", "shift")


@dataclass
class Manifest:
    """Stored levels 0, KEPT, 2 KEPT, ... of all trees. A tree's root is in the last that has it."""

    levels: list[DataFrame]

    @property
    def roots(self) -> DataFrame:
        """tree and digest."""
        found = [t.where(_rounds() == r).select("tree", "digest") for r, t in enumerate(self.levels) if r]
        out = found[0]
        for more in found[1:]:
            out = out.union(more)
        return out


def _rounds() -> Column:
    """How many times a tree's levels are stored above its leaves."""
    return F.greatest(F.lit(1), F.ceil(F.col("height") / KEPT).cast("int"))


def _subtrees(level: DataFrame, number: int) -> DataFrame:
    """The aligned subtrees over a stored level: their nodes in order, and the levels they have."""
    inside = level.where(_rounds() > number)
    rest = [c for c in level.columns if c not in ("tree", "height", "place", "digest")]
    block = F.expr(f"place div {FAN**KEPT}").alias("block")
    found = inside.groupBy("tree", block).agg(F.first("height").alias("height"), F.sort_array(F.collect_list(F.struct("place", "digest", *rest))).alias("nodes"))
    levels = F.least(F.lit(KEPT), F.col("height") - KEPT * number)
    return found.withColumn("levels", levels).withColumn("level_0", F.transform("nodes", lambda x: x["digest"]))


def build(rows: DataFrame, order: Sequence[str]) -> Manifest:
    """The trees over rows with columns tree, digest and others, ordered by ``order``."""
    levels = [cut(numbered(rows, order))]
    deepest = levels[0].agg(F.max(_rounds())).first()[0] or 1
    for number in range(deepest):
        ups = F.slice(F.array(*[F.lit(i) for i in range(KEPT)]), 1, F.col("levels"))
        top = F.aggregate(ups, F.col("level_0"), lambda now, _: _up(now))[0]
        above = _subtrees(levels[-1], number).select("tree", "height", F.col("block").alias("place"), top.alias("digest"))
        levels.append(cut(above))
    return Manifest(levels)


def _siblings(digests: Column, place: Column) -> Column:
    """What stands left and right of a node in its run."""
    inside = F.pmod(place, F.lit(FAN))
    left = F.slice(digests, place - inside + 1, inside)
    return F.struct(F.array_join(left, "").alias("left"), F.array_join(F.slice(digests, place + 2, F.lit(FAN - 1) - inside), "").alias("right"))


def _descended(level: DataFrame, number: int, above: DataFrame) -> DataFrame:
    """The nodes of a stored level with proofs; ``above`` are those of the next one."""
    carried = [c for c in above.columns if c not in ("tree", "place", "proof")]
    subtrees = _subtrees(level, number).join(above.withColumnRenamed("place", "block"), ["tree", "block"])
    names = ["level_0"]
    for i in range(1, KEPT):
        made = F.when(F.col("levels") > i, _up(F.col(names[-1]))).otherwise(F.array().cast("array<string>"))
        subtrees = subtrees.withColumn(f"level_{i}", made)
        names.append(f"level_{i}")

    def proved(node: Column, place: Column) -> Column:
        own = F.array(*[_siblings(F.col(n), F.floor(place / FAN**i).cast("int")) for i, n in enumerate(names)])
        return F.struct(node.alias("node"), F.concat(F.slice(own, 1, F.col("levels")), F.col("proof")).alias("proof"))

    found = subtrees.select("tree", *carried, F.inline(F.transform("nodes", proved)))
    return found.select("tree", *carried, "node.*", "proof")


def proofs(manifest: Manifest, upper: DataFrame) -> DataFrame:
    """Every leaf with its proof: the texts left and right of it, level by level. ``upper`` has for
    every tree the proof that its root's goes on with, and columns to carry to its leaves."""
    above = None
    for number in range(len(manifest.levels) - 1, 0, -1):
        level = manifest.levels[number]
        here = level.where(_rounds() == number).select("tree", "place").join(upper, "tree")
        if above is not None:
            here = here.unionByName(_descended(level, number, above).drop("digest"))
        above = cut(here)
    return _descended(manifest.levels[0], 0, above)


def folded(proof: Column, digest: Column) -> Column:
    """The root that a digest and its proof lead to."""
    return F.aggregate(proof, digest, lambda now, s: F.sha2(F.concat(s["left"], now, s["right"]), 256))


def sibling_text(proof: Column) -> Column:
    """All siblings of a proof, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def proved(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows (tree, digest, others) with subroot, root and the proof from the leaf to the root."""
    trees = build(rows, order)
    named = trees.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    top = build(named, ["name"])
    start = top.roots.select("tree", F.col("digest").alias("root"), F.expr("array()").cast("array<struct<left:string,right:string>>").alias("proof"))
    upper = proofs(top, start).select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "root", "proof")
    return proofs(trees, cut(upper))
