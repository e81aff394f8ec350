"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusmill.llm.common import written


def _star(both: DataFrame, keep: str) -> DataFrame:
    """Each node's kept neighbours (``keep``: a condition on node u and neighbour v), tied to the least of node and neighbours."""
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return both.filter(keep).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def components(edges: DataFrame, a: str, b: str, rounds: int = 60) -> DataFrame:
    """(node, component): the least node that each node of ``edges`` reaches. Nodes of any orderable type.

    Every round ties each node's larger neighbours, then its smaller ones, to the least one it sees, which needs about the logarithm of the longest path
    in rounds. Neighbours are aggregated before they are shuffled; a node with very many neighbours is split by the join. Each round is a written table.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct()
    known, pairs = None, written(pairs, "edges")
    for _ in range(rounds):
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        pairs = _star(both, "v > u").filter("u <> v").distinct()
        down = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("v"))
        pairs = _star(down, "true").union(least).filter("u <> v").distinct()
        pairs = written(pairs, "edges")
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == known:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(pairs.select(F.col("v"), F.col("v"))).distinct()
        known = now
    raise RuntimeError(f"no end after {rounds} rounds")
