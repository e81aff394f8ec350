"""Sharding by a hierarchical weighted hash tree.

A tree of regions, racks and shards is descended once for every key. At each level the children draw a
hash of (key, child) and the child with the smallest ``-ln(u) / weight`` wins, so a child is chosen in
proportion to its weight and a change of weights moves keys only into the subtrees that gained or out of those that lost.
The draws are JVM expressions; no row is shuffled to find its shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusmill.llm.common import running_start


@dataclass(frozen=True)
class Node:
    """A region, rack or shard. ``name`` is unique among all nodes; ``shard`` is set on leaves alone."""

    name: str
    weight: float = 0.0
    children: tuple["Node", ...] = ()
    shard: int | None = None

    @property
    def total(self) -> float:
        return sum(c.total for c in self.children) if self.children else self.weight


def leaf(shard: int, weight: float = 1.0) -> Node:
    return Node(f"shard{shard}", weight, (), shard)


def balanced_tree(n_shards: int, per_rack: int = 2, racks: int = 2) -> Node:
    """Shards 0 to ``n_shards - 1`` with equal weights: ``per_rack`` to a rack, ``racks`` to a region."""
    if n_shards < 1:
        raise ValueError("a tree needs a shard")
    leaves = [leaf(i) for i in range(n_shards)]
    rack = [Node(f"rack{i}", children=tuple(leaves[k : k + per_rack])) for i, k in enumerate(range(0, n_shards, per_rack))]
    region = [Node(f"region{i}", children=tuple(rack[k : k + racks])) for i, k in enumerate(range(0, len(rack), racks))]
    return Node("root", children=tuple(region))


def grown(tree: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region and rack of its own: keys move into that shard alone."""
    rack = Node(f"rack-of-{shard}", children=(leaf(shard, weight),))
    return Node(tree.name, children=(*tree.children, Node(f"region-of-{shard}", children=(rack,))))


def _straw(key: Column, node: Node) -> Column:
    """-ln(u) / weight of a child, with u in (0, 1] from 52 bits of a hash of the key and the child's name."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(node.name)), 12)
    return -F.log((bits + F.lit(1)) / F.lit(float(1 << 52))) / F.lit(node.total)


def shard_of(key: Column, tree: Node) -> Column:
    """The leaf that ``key`` descends to. A null key draws like any other; children without weight never win."""
    if tree.shard is not None:
        return F.lit(tree.shard)
    live = [c for c in tree.children if c.total > 0]
    if not live:
        raise ValueError(f"{tree.name} has no weight")
    below = [shard_of(key, c) for c in live]
    if len(live) == 1:
        return below[0]
    draws = F.array(*[F.struct(_straw(key, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(live)])
    chosen = F.array_min(draws)["i"]
    out = F.when(chosen == 0, below[0])
    for i, b in enumerate(below[1:], 1):
        out = out.when(chosen == i, b)
    return out


def assign_shards(df: DataFrame, key: str, tree: Node, grown_tree: Node | None = None) -> DataFrame:
    """Add ``shard``, ``slot`` (gapless from 0 in each shard) and, with ``grown_tree``, ``grown_shard``.

    Every row gets a shard: null keys share one, repeated keys share theirs, and repeated rows get slots of
    their own. An empty table stays empty. Columns of ``df`` named ``shard``, ``slot`` or ``grown_shard`` are replaced, others stay.
    """
    placed = df.drop("shard", "slot", "grown_shard").withColumn("shard", shard_of(F.col(key), tree).cast("int"))
    placed = placed.withColumn("grown_shard", (shard_of(F.col(key), grown_tree) if grown_tree else F.lit(None)).cast("int"))
    return running_start(placed.withColumn("_one", F.lit(1).cast("long")), ["shard"], [key], "_one", "slot").drop("_one")


def op9_hash_tree(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """The contract's query: eight equal shards, and a ninth in a region of its own."""
    tree = balanced_tree(n_shards)
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    out = assign_shards(rows, "doc_id", tree, grown(tree, n_shards))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
