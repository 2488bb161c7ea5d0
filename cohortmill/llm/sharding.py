"""Shards by a hierarchical weighted hash tree.

A document starts at the root and, at each level (region, rack, shard), enters the child with the
smallest draw ``-ln(u) / weight``, ``u`` a uniform hash of the key and the child's name. Draws of
children do not depend on one another, so a change of weight moves keys only into or out of the
child that changed; every other subtree keeps its own.

The law is ``key``: doc_id and the shard count alone decide, as ``tree`` builds the one tree of a count.
Beyond ``FULL`` shards a tree grows by a region of one shard, so the keys that move go to the new shard
and nowhere else. ``regrouped`` is another law: it folds such regions into full ones, from one count to
the next it moves keys between old shards too, and is for when a general move is acceptable.

Defined results: a null doc_id is a key like any other; a null text has size 16 and CRC 0; repeated
rows go to the same shard and get slots of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import scratch_table, whole

RACKS, PER_RACK = 2, 5
ROWS_PER_BUCKET = 20_000
FULL = 40  # shards in full regions; later ones stand alone


@dataclass(frozen=True)
class Node:
    """A subtree. A leaf has a shard; an inner node weighs what its children weigh."""

    name: str
    shard: int | None = None
    own_weight: float = 1.0
    children: tuple[Node, ...] = ()

    @property
    def weight(self) -> float:
        return sum(child.weight for child in self.children) if self.children else self.own_weight

    @property
    def shards(self) -> tuple[int, ...]:
        return tuple(s for c in self.children for s in c.shards) if self.children else (self.shard,)


def region(name: str, shards: list[int], per_rack: int) -> Node:
    racks = [shards[i:i + per_rack] for i in range(0, len(shards), per_rack)]
    return Node(name, children=tuple(
        Node(f"{name}/k{i}", children=tuple(Node(f"{name}/k{i}/s{s}", s) for s in rack))
        for i, rack in enumerate(racks)))


def regrouped(n_shards: int, racks: int = RACKS, per_rack: int = PER_RACK) -> Node:
    """A tree of full regions over ``n_shards`` equal shards."""
    step = racks * per_rack
    return Node("root", children=tuple(
        region(f"r{i}", list(range(start, min(start + step, n_shards))), per_rack)
        for i, start in enumerate(range(0, n_shards, step))))


def grown(tree: Node, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region of its own."""
    shard, name = max(tree.shards) + 1, f"r{len(tree.children)}"
    leaf = Node(f"{name}/k0/s{shard}", shard, weight)
    return Node(tree.name, children=(*tree.children, Node(name, children=(Node(f"{name}/k0", children=(leaf,)),))))


def tree(n_shards: int, full: int = FULL) -> Node:
    """The tree of a number of shards: from ``full`` on, that of one less, grown."""
    node = regrouped(min(n_shards, full))
    for _ in range(full, n_shards):
        node = grown(node)
    return node


def _draw(key: Column, node: Node) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(node.name), key), 11)
    return -F.log((bits.cast("double") + 0.5) / float(1 << 53)) / node.weight


def _enter(key: Column, node: Node) -> Column:
    """Position of the child that a key enters."""
    if len(node.children) == 1:
        return F.lit(0)
    return F.array_min(F.array(*[
        F.struct(_draw(key, child).alias("draw"), F.lit(i).alias("child"))
        for i, child in enumerate(node.children)]))["child"]


def shard_of(key: Column, node: Node) -> Column:
    """The shard under a node; only the draws on a key's way down are evaluated."""
    if not node.children:
        return F.lit(node.shard)
    if all(not child.children for child in node.children):
        return F.get(F.array(*[F.lit(child.shard) for child in node.children]), _enter(key, node))
    below = [shard_of(key, child) for child in node.children]
    if len(below) == 1:
        return below[0]
    place = _enter(key, node)
    # One draw per child, then one branch: the position is bound once by the lambda.
    def branch(chosen: Column) -> Column:
        out = F.when(chosen == 0, below[0])
        for i, column in enumerate(below[1:], 1):
            out = out.when(chosen == i, column)
        return out

    return F.get(F.transform(F.array(place), branch), F.lit(0))


def place(docs: DataFrame, tree: Node, key: str = "doc_id") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    Slots need no sort of a whole shard: rows are numbered inside hashed buckets of bounded size,
    and a bucket starts where the counts of the earlier ones end.
    """
    bigger = grown(tree)
    narrow = scratch_table(docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(whole("text")).cast("bigint") + 16).alias("size"),
        F.crc32(whole("text").cast("binary")).alias("text_crc32"),
        shard_of(F.col(key), tree).cast("int").alias("shard"),
        shard_of(F.col(key), bigger).cast("int").alias("grown_shard"),
    ), "shards")
    shards = len(tree.shards)
    buckets = 1 + narrow.count() // (shards * ROWS_PER_BUCKET)
    row_hash = F.xxhash64("doc_id", "size", "text_crc32")
    rows = narrow.withColumn("bucket", F.pmod(row_hash, F.lit(buckets)).cast("int"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "bucket").count().select(
        "shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32")
    numbered = rows.withColumn("n", F.row_number().over(within) - 1)
    return numbered.join(starts, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("start") + F.col("n")).cast("bigint").alias("slot"), "grown_shard")
