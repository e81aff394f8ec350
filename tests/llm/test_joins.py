"""Joins whose sides grow in the plan beyond what Spark takes them for by their files."""

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from locusmill.llm import mixing  # noqa: E402


def broadcasts(df, column):
    """Lines of the plan that broadcast by a column."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "BroadcastHashJoin" in line and column in line]


def test_pieces_of_documents_are_not_broadcast(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.repeat(F.lit("a word "), (F.col("id") % 90 * 10).cast("int")).alias("text"))
    out = mixing.op1_source_mix(docs, block_words=16, n_shards=4)
    assert not broadcasts(out, "block")
    mixed = mixing.mixed_documents(docs, "source", (5, 2, 1), block_words=16)
    assert not broadcasts(mixed, "block")
    taken = {r["source_size"]: (r["n"], r["target"]) for r in out.groupBy("source_size").agg(F.sum("taken").alias("n"), F.first("target").alias("target")).collect()}
    assert all(abs(n - target) < 1 for n, target in taken.values())
