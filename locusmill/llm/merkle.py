"""Merkle manifest of a table: one tree a group, and one over the groups, in blocks of van Emde Boas layout.

A node is the SHA-256 of its up to sixteen children's hex digests. The nodes of a group are cut into aligned blocks of up to four levels
(65,536 leaves), each stored as one array of digests: a tree is split at half its height, its top part first and then the bottom parts one
after the other, each laid out in the same way. The address of a node follows from its depth and index alone (``slots``), for construction and
for siblings alike. Roots of blocks are the nodes of the next layer of blocks, until a group has one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusmill.llm.common import running_start, written

ARITY = 16
#: Levels below the root of a block.
HEIGHT = 4
TAIL = "array<struct<at: int, run: string>>"


def nodes_of(levels: int) -> int:
    """Nodes of a perfect tree of so many levels."""
    return (ARITY**levels - 1) // (ARITY - 1)


def slots(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Addresses of nodes of one depth (0: the root) in a tree of ``levels`` levels that is split at half its height again and again."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return slots(top, depth, index)
    bottom, below = levels - top, ARITY ** (depth - top)
    return nodes_of(top) + index // below * nodes_of(bottom) + slots(bottom, depth - top, index % below)


def _counts(n: int, height: int) -> list[int]:
    """Nodes at each depth above ``n`` leaves at depth ``height``."""
    return [-(-n // ARITY ** (height - d)) for d in range(height + 1)]


def build_block(digests: bytes, height: int) -> bytes:
    """The block over consecutive 32-byte digests; addresses that no node has hold zeros, what follows the last node is left out."""
    n = len(digests) // 32
    at = [slots(height + 1, d, np.arange(c)) for d, c in enumerate(_counts(n, height))]
    block = np.zeros((1 + max(int(a.max()) for a in at), 32), np.uint8)
    for d in range(height, -1, -1):
        block[at[d]] = np.frombuffer(digests, np.uint8).reshape(-1, 32)
        if d:
            run = 32 * ARITY
            digests = b"".join(sha256(digests[k : k + run].hex().encode()).digest() for k in range(0, len(digests), run))
    return block.tobytes()


def runs_of_block(block: bytes, n: int, height: int) -> list[list[str]]:
    """For each depth from the leaves up to 1, the hex digests of each run of siblings."""
    digests, run = np.frombuffer(block, np.uint8).reshape(-1, 32), 64 * ARITY
    out = []
    for d, c in reversed(list(enumerate(_counts(n, height)))[1:]):
        row = digests[slots(height + 1, d, np.arange(c))].tobytes().hex()
        out.append([row[k : k + run] for k in range(0, len(row), run)])
    return out


def steps_of(runs: list[list[str]], i: int) -> list[tuple[int, str]]:
    """Leaf ``i``'s way up: its place in the run and the run, level by level."""
    return [(i // ARITY**k % ARITY, row[i // ARITY ** (k + 1)]) for k, row in enumerate(runs)]


def fold(digest: str, steps: list[tuple[int, str]]) -> str:
    """The root that ``digest`` leads to along the steps' siblings."""
    for at, run in steps:
        digest = sha256((run[: 64 * at] + digest + run[64 * at + 64 :]).encode()).hexdigest()
    return digest


def proof(steps: list[tuple[int, str]]) -> str:
    """The hash of all siblings, level by level, left to right."""
    return sha256("".join(run[: 64 * at] + run[64 * at + 64 :] for at, run in steps).encode()).hexdigest()


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the values, each ``-`` if null, else its UTF-8 bytes' number, a colon and itself; numbers in decimal."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _levels(n: Column) -> Column:
    """The least t with ARITY ** t >= n."""
    return sum((F.when(n > ARITY**k, 1).otherwise(0) for k in range(15)), F.lit(0))


@dataclass
class Trees:
    """Trees of all cells: ``layers``, from the leaves up, hold cell, block, n, height, left (levels above the block) and tree; ``roots`` cell and digest."""

    layers: list[DataFrame]
    roots: DataFrame
    height: int


def _grown(key: tuple, nodes: pa.Table) -> pa.Table:
    nodes = nodes.sort_by("at")
    left, height = nodes["left"][0].as_py(), nodes["height"][0].as_py()
    tree = build_block(b"".join(nodes["digest"].to_pylist()), height)
    return pa.table({"cell": pa.array([key[0].as_py()], pa.string()), "block": pa.array([key[1].as_py()], pa.int64()), "n": pa.array([nodes.num_rows], pa.int32()), "height": pa.array([height], pa.int32()), "left": pa.array([left - height], pa.int32()), "tree": pa.array([tree], pa.binary())})


def build_trees(nodes: DataFrame, height: int) -> Trees:
    """Trees over ``nodes``: cell, at (gapless from 0 in each cell), digest (binary) and left, the levels of the cell's tree; blocks of ``height`` levels."""
    layers, more = [], True
    while more:
        grouped = nodes.select("cell", F.expr(f"at div {ARITY**height}").alias("block"), "at", "left", F.least("left", F.lit(height)).alias("height"), "digest").groupBy("cell", "block")
        layers.append(written(grouped.applyInArrow(_grown, "cell string, block long, n int, height int, left int, tree binary"), "blocks"))
        nodes = layers[-1].filter("left > 0").select("cell", F.col("block").alias("at"), F.substring("tree", 1, 32).alias("digest"), "left")
        more = bool(nodes.take(1))
    roots = [b.filter("left = 0").select("cell", F.substring("tree", 1, 32).alias("digest")) for b in layers]
    out = roots[0]
    for r in roots[1:]:
        out = out.unionByName(r)
    return Trees(layers, out, height)


def _below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ways up of the nodes below blocks: their steps in the block, then the block's own."""
    for b in batches:
        for r in b.to_pylist():
            runs = runs_of_block(r["tree"], r["n"], r["height"])
            for k in range(0, r["n"], 256):
                tails = [[{"at": a, "run": s} for a, s in steps_of(runs, i)] + r["tail"] for i in range(k, min(k + 256, r["n"]))]
                at = np.arange(k, k + len(tails), dtype=np.int64) + r["first"]
                yield pa.RecordBatch.from_arrays([pa.array([r["cell"]] * len(tails), pa.string()), pa.array(at), pa.array([r["subroot"]] * len(tails), pa.string()), pa.array(tails, pa.list_(pa.struct([("at", pa.int32()), ("run", pa.string())])))], ["cell", "block", "subroot", "tail"])


def below(blocks: DataFrame, height: int) -> DataFrame:
    """``blocks`` (a layer with subroot and tail) to their nodes: cell, block (the node's index), subroot, tail."""
    first = (F.col("block") * ARITY**height).alias("first")
    return blocks.select("cell", first, "n", "height", "tree", "subroot", "tail").mapInArrow(_below, f"cell string, block long, subroot string, tail {TAIL}")


def descend(trees: Trees, cells: DataFrame) -> DataFrame:
    """The lowest layer of blocks with the tail of each, its steps from the block's root up; ``cells`` gives each cell's subroot and the steps above it."""
    tails = None
    for layer in reversed(trees.layers):
        tops = layer.filter("left = 0").select("cell", "block").join(cells, "cell")
        tails = layer.join(tops if tails is None else tops.unionByName(below(tails, trees.height)), ["cell", "block"])
    return tails


def _proved(key: tuple, leaves: pa.Table, blocks: pa.Table) -> pa.Table:
    b = blocks.to_pylist()[0]
    runs, tail = runs_of_block(b["tree"], b["n"], b["height"]), [(s["at"], s["run"]) for s in b["tail"]]
    index = leaves["place"].to_numpy()
    proofs, roots = [], []
    for i, own, changed in zip(index.tolist(), leaves["digest"].to_pylist(), leaves["changed"].to_pylist()):
        steps = steps_of(runs, i) + tail
        proofs.append(proof(steps))
        roots.append(fold((own if changed is None else changed).hex(), steps))
    n = leaves.num_rows
    return pa.table({"key": leaves["key"], "leaf": pa.array([x.hex() for x in leaves["digest"].to_pylist()], pa.string()), "subroot": pa.array([b["subroot"]] * n, pa.string()), "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(roots, pa.string())})


def prove(rows: DataFrame, key: str, group: str, leaf: Column, tampered: Column, height: int = HEIGHT) -> DataFrame:
    """The manifest's leaves: ``key``, leaf, subroot, root, proof_sha256, folded_root, verified.

    A group's leaves ascend by key, null keys first, rows of one key by their digest; groups ascend bytewise, the null group first, so equal rows
    have leaves of their own in any order. ``leaf`` and ``tampered`` are hex digests (``leaf_digest``); a null ``tampered`` stands for the leaf itself.
    An empty table gives no rows. Other columns of ``rows`` aren't kept and may have any name.

    Rows are placed by range (``running_start``), a block of at most 65,536 leaves is one group of a task, and each task sees its own block's array alone.
    """
    # "-" sorts before ":", so the null group comes first and no two groups share a name
    named = rows.select(F.coalesce(F.concat(F.lit(":"), F.col(group).cast("string")), F.lit("-")).alias("cell"), F.col(key).alias("key"), F.unhex(leaf).alias("digest"), F.unhex(tampered).alias("changed"))
    placed = written(running_start(named.withColumn("one", F.lit(1).cast("long")), ["cell"], ["key", "digest"], "one", "at").drop("one"), "leaves")
    sizes = placed.groupBy("cell").agg(_levels(F.count(F.lit(1))).alias("left"))
    trees = build_trees(placed.select("cell", "at", "digest").join(sizes, "cell"), height)

    subroots = written(running_start(trees.roots.withColumn("one", F.lit(1).cast("long")), [], ["cell"], "one", "at").drop("one"), "subroots")
    left = subroots.agg(_levels(F.count(F.lit(1)))).first()[0]
    above = build_trees(subroots.select(F.lit("").alias("cell"), "at", "digest", F.lit(left).alias("left")), height)
    top = above.roots.first()
    root = top["digest"].hex() if top else None
    ways = below(descend(above, rows.sparkSession.createDataFrame([("", "", [])], f"cell string, subroot string, tail {TAIL}")), height)
    cells = subroots.join(ways.select(F.col("block").alias("at"), "tail"), "at").select("cell", F.lower(F.hex("digest")).alias("subroot"), "tail")

    blocks = descend(trees, cells)
    at, place = F.expr(f"at div {ARITY**height}").alias("block"), F.expr(f"at % {ARITY**height}").alias("place")
    kind = rows.schema[key].dataType.simpleString()
    proved = (
        placed.select("cell", at, place, "key", "digest", "changed").groupBy("cell", "block").cogroup(blocks.select("cell", "block", "n", "height", "tree", "subroot", "tail").groupBy("cell", "block"))
        .applyInArrow(_proved, f"key {kind}, leaf string, subroot string, proof_sha256 string, folded_root string")
    )
    return proved.select(F.col("key").alias(key), "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == F.lit(root)).alias("verified"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op12_merkle_manifest(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The contract's query. A null doc_id has no decimal form, so its row isn't tampered with."""
    fields = ("doc_id", "source", "lang", "n_chars")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    changed = F.when(hit, leaf_digest(*[F.col(c) for c in fields], F.translate("text", UPPER, LOWER)))
    return prove(docs, "doc_id", "source", leaf_digest(*[F.col(c) for c in fields], F.col("text")), changed, height)
