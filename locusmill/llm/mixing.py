"""Mixing sources to target weights.

Each source's words, document after document, are packed into blocks of ``block_words``. A mix of as many words as the
input has is divided over output shards; for each shard, the blocks it takes from each source are a multinomial draw, by the
sources' quotas that are left, so that a source's total is its target. A source's n-th slot maps through a
pseudorandom permutation of its block indices, a new permutation for every pass over the source, and the slots meet the blocks by index.
The last slot of a source is cut to the words that its target still needs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusmill.llm.common import WORD, keyed, n_words, running_start, written

SEED = 20240601


def water_fill(sources: DataFrame, cap: float = 3.0) -> DataFrame:
    """Add ``target``: shares of all sizes by weight, none above ``cap`` times its ``size``, the excess reshared by weight.

    ``sources`` has one row for each source: size and weight > 0. The end of resharing has one multiplier
    ``m`` with target = least(cap * size, m * weight). Sources in the order of cap * size / weight fill up first, so m follows
    from running sums over that order.
    """
    limit = F.col("size") * F.lit(float(cap))
    order = Window.orderBy(limit / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    s = sources.withColumn("_full", F.coalesce(F.sum(limit).over(order), F.lit(0.0)))
    s = s.withColumn("_left", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(order), F.lit(0.0)))
    s = s.withColumn("_m", (F.sum("size").over(every) - F.col("_full")) / F.col("_left"))
    # the first source in the order whose own limit is not below its share sets m
    s = s.withColumn("_m", F.min(F.when(limit >= F.col("_m") * F.col("weight"), F.struct(limit / F.col("weight"), F.col("rank"), F.col("_m").alias("m")))).over(every)["m"])
    return s.withColumn("target", F.coalesce(F.least(limit, F.col("_m") * F.col("weight")), F.lit(0.0))).drop("_full", "_left", "_m")


def source_targets(sizes: DataFrame, source: str, weights: tuple[float, ...], cap: float) -> DataFrame:
    """One row for each source, by code point, null last: rank, size, weight (``weights`` repeating), target."""
    s = sizes.groupBy(source).agg(F.sum("size").alias("size"))
    s = s.withColumn("rank", F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1)
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), F.pmod("rank", F.lit(len(weights))).cast("int"))
    return water_fill(s.withColumn("weight", w), cap)


def shard_draws(slots: np.ndarray, n_shards: int, seed: int = SEED) -> np.ndarray:
    """Counts [shard, source]: multinomial draws by the quotas left, whose sums are the sources' slots and even shards."""
    rng, left = np.random.default_rng(seed), slots.astype(np.int64).copy()
    total, out = int(left.sum()), np.zeros((n_shards, len(slots)), np.int64)
    for k in range(n_shards):
        size = total * (k + 1) // n_shards - total * k // n_shards
        while size > 0:  # what goes beyond a quota is drawn again
            got = np.minimum(rng.multinomial(size, left / left.sum()), left)
            out[k] += got
            left -= got
            size -= int(got.sum())
    return out


def _mix(x: np.ndarray, key: np.ndarray) -> np.ndarray:
    x = (x ^ key) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def permuted(i: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 for each key, at i: four Feistel rounds on the next even number of bits, walked into range."""
    i, n, key = (np.asarray(x).astype(np.uint64) for x in (i, n, key))
    bits = np.maximum(1, np.ceil(np.log2(np.maximum(n.astype(np.float64), 2)) / 2)).astype(np.uint64)
    mask, out, todo = (np.uint64(1) << bits) - np.uint64(1), i.copy(), np.ones(len(i), bool)
    with np.errstate(over="ignore"):
        while todo.any():
            h, m, k = bits[todo], mask[todo], key[todo]
            left, right = out[todo] >> h, out[todo] & m
            for r in range(4):
                left, right = right, left ^ (_mix(right, k + np.uint64(r * 0x632BE5AB)) & m)
            out[todo] = (left << h) | right
            todo &= out >= n
    return out.astype(np.int64)


def _place_slots(block_words: int, seed: int):
    """Slots (rank, slot, size, quota) to blocks: the block index and how many of its words the slot takes."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            size, n, slot = b["size"].to_numpy(), -(-b["size"].to_numpy() // block_words), b["slot"].to_numpy()
            turn, at = slot // n, slot % n
            with np.errstate(over="ignore"):
                key = _mix(b["rank"].to_numpy().astype(np.uint64) * np.uint64(1_000_003) + turn.astype(np.uint64), np.uint64(seed))
            block = permuted(at, n, key)
            short = n * block_words - size  # words that the last block lacks
            # where the last block stands in this pass: all later slots start earlier by what it lacks
            where = _position_of_last(n, key)
            start = turn * size + at * block_words - np.where(at > where, short, 0)
            words = np.where(block == n - 1, block_words - short, block_words)
            took = np.clip(b["quota"].to_numpy() - start, 0, words)
            yield pd.DataFrame({"rank": b["rank"], "shard": b["shard"], "slot": slot, "block": block, "took": took})[took > 0]

    return place


def _position_of_last(n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The index that ``permuted`` maps to n - 1: the rounds backwards, walked into range."""
    pairs, back = np.unique(np.stack([n.astype(np.uint64), key]), axis=1, return_inverse=True)
    n, key = pairs[0], pairs[1]
    bits = np.maximum(1, np.ceil(np.log2(np.maximum(n.astype(np.float64), 2)) / 2)).astype(np.uint64)
    mask, out, todo = (np.uint64(1) << bits) - np.uint64(1), n - np.uint64(1), np.ones(len(n), bool)
    with np.errstate(over="ignore"):
        while todo.any():
            h, m, k = bits[todo], mask[todo], key[todo]
            left, right = out[todo] >> h, out[todo] & m
            for r in reversed(range(4)):
                left, right = right ^ (_mix(left, k + np.uint64(r * 0x632BE5AB)) & m), left
            out[todo] = (left << h) | right
            todo &= out >= n
    return out.astype(np.int64)[back.reshape(-1)]


def _slots_needed(size: int, quota: int, blocks: int, block_words: int) -> int:
    """Slots that surely hold ``quota`` words: whole passes, and for the rest one more than full blocks need, as the last block may be short."""
    if not size:
        return 0
    turns, rest = divmod(quota, size)
    return turns * blocks + (min(blocks, -(-rest // block_words) + 1) if rest else 0)


def mix_plan(
    docs: DataFrame, source: str, order: list[str], size: Column, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0, block_words: int = 256, n_shards: int = 64, seed: int = SEED
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix as tables: documents with their place, sources with their targets, and what of each block is taken.

    - documents: the columns of ``docs`` with ``size``, ``_rank`` of the source and ``_start``, the document's
      first word in its source; repeated rows are documents of their own, a null source is a source of its own.
    - sources: rank, size, weight, target and ``quota``, the target rounded down to words.
    - takes: rank, block, shard, slot, took (a block's leading words). A source without words has none.

    The table of sources and the draws (``n_shards`` rows for each source) pass the driver; documents and slots don't.
    """
    sized = written(docs.withColumn("size", size.cast("long")), "mix-sizes")
    # the quotas fill the mix but for less than a word a source
    sources = source_targets(sized, source, weights, cap).withColumn("quota", F.floor("target").cast("long"))
    sources = written(sources.withColumn("blocks", F.ceil(F.col("size") / block_words).cast("long")), "mix-sources")
    known = [r.asDict() for r in sources.select("rank", "size", "quota", "blocks").orderBy("rank").collect()]
    slots = np.array([_slots_needed(r["size"], r["quota"], r["blocks"], block_words) for r in known] or [0], np.int64)
    drawn = shard_draws(slots, n_shards, seed)
    first = np.cumsum(drawn, axis=0) - drawn
    rows = [(r["rank"], k, int(first[k, j]), int(drawn[k, j]), r["size"], r["quota"]) for j, r in enumerate(known) for k in range(n_shards) if drawn[k, j]]
    spark = docs.sparkSession
    runs = spark.createDataFrame(rows, "rank int, shard int, first long, n long, size long, quota long")
    chunk = 65_536
    slots_df = (
        runs.withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / chunk))))
        .repartition("rank", "shard", "c")
        .withColumn("slot", F.explode(F.sequence(F.col("first") + F.col("c") * chunk, F.col("first") + F.least((F.col("c") + 1) * chunk, F.col("n")) - 1)))
        .select("rank", "shard", "slot", "size", "quota")
    )
    takes = slots_df.mapInPandas(_place_slots(block_words, seed), "rank int, shard int, slot long, block long, took long")
    ranked = sized.join(
        sources.select(F.col(source).alias("_source"), F.col("rank").alias("_rank"), F.col("size").alias("source_size"), "target"),
        sized[source].eqNullSafe(F.col("_source")),
    ).drop("_source")
    placed = running_start(ranked, ["_rank"], order, "size", "_start")
    return placed, sources, takes


def pieces(placed: DataFrame, block_words: int) -> DataFrame:
    """Each document's pieces, one for each block that it reaches into: block, and words ``lo`` to ``hi`` of the block.

    There are more of them than Spark takes them for by the file that they come from, so joins must not broadcast them.
    """
    end = F.col("_start") + F.col("size")
    held = placed.filter(F.col("size") > 0).withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("_start") / block_words), F.floor((end - 1) / block_words)))
    )
    base = F.col("block") * block_words
    return held.withColumn("lo", F.greatest(F.col("_start") - base, F.lit(0))).withColumn("hi", F.least(end - base, F.lit(block_words)))


def op1_source_mix(docs: DataFrame, block_words: int = 256, n_shards: int = 64, seed: int = SEED) -> DataFrame:
    """The contract's query: what the mix takes of every document, and in ``shards`` how many words go to which output shard (``shard:words`` by shard, comma-joined).

    Documents of one source and doc_id follow each other in any order; equal rows share what they are taken together evenly
    only by chance, their sum is fixed. Empty and null texts have no words and are never taken. Other columns don't count.
    """
    rows = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    placed, _, takes = mix_plan(rows, "source", ["doc_id", "size"], F.col("size"), block_words=block_words, n_shards=n_shards, seed=seed)
    placed = written(placed, "mix-placed")
    # what is taken of a block, by shard: so many whole takes, and leading parts of it by the one slot that is cut
    used = takes.groupBy("rank", "block", "shard").agg(F.collect_list("took").alias("tooks"))
    p = pieces(placed, block_words).alias("p")
    u = used.alias("u")
    met = p.join(u.hint("merge"), (F.col("p._rank") == F.col("u.rank")) & (F.col("p.block") == F.col("u.block")))
    words = F.aggregate("u.tooks", F.lit(0).cast("long"), lambda a, t: a + F.greatest(F.least(t, F.col("p.hi")) - F.col("p.lo"), F.lit(0).cast("long")))
    by_shard = met.groupBy("p._rank", "p._start", "u.shard").agg(F.sum(words).alias("n")).filter("n > 0")
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("shard", "n"))), lambda x: F.concat_ws(":", x["shard"].cast("string"), x["n"].cast("string"))), ",")
    taken = by_shard.groupBy("_rank", "_start").agg(F.sum("n").alias("taken"), listed.alias("shards"))
    out = placed.alias("a").join(taken.alias("b"), (F.col("a._rank") == F.col("b._rank")) & (F.col("a._start") == F.col("b._start")) & (F.col("a.size") > 0), "left")
    return out.select("a.doc_id", "a.size", "a.source_size", "a.target", F.coalesce("b.taken", F.lit(0)).cast("long").alias("taken"), F.coalesce("b.shards", F.lit("")).alias("shards"))


def _cut_words(texts: pd.Series, lows: pd.Series, highs: pd.Series, sizes: pd.Series) -> pd.Series:
    """Words ``low`` to ``high`` of each text of ``size`` words, with what stands between them; all words are the whole text."""
    word, out = re.compile(WORD), []
    for t, lo, hi, n in zip(texts, lows, highs, sizes):
        if hi - lo < n:
            at = list(islice(word.finditer(t), int(lo), int(hi)))
            t = t[at[0].start() : at[-1].end()]
        out.append(t)
    return pd.Series(out)


def mixed_documents(docs: DataFrame, source: str, weights: tuple[float, ...], cap: float = 3.0, block_words: int = 256, text: str = "text") -> DataFrame:
    """What the mix takes, as documents: the columns of ``docs``, with the whole text or a stretch of its words.

    A document taken twice and a half gives two rows and a part. Neighbouring blocks of a document that are taken equally often
    stay one stretch. Texts without words are in no row. Columns keep their values, but for the text.
    """
    rows = keyed(docs, "doc_id", "_key")
    plan, _, takes = mix_plan(rows.select("_key", source, n_words(F.col(text)).alias("size")), source, ["_key", "size"], F.col("size"), weights, cap, block_words)
    p, used = pieces(plan, block_words).alias("p"), takes.groupBy("rank", "block").agg(F.sort_array(F.collect_list("took"), asc=False).alias("tooks")).alias("u")
    met = p.join(used.hint("merge"), (F.col("p._rank") == F.col("u.rank")) & (F.col("p.block") == F.col("u.block")))
    # the n-th time that a block is taken goes with the n-th time of the next block
    each = met.select(F.col("p._key").alias("_key"), "p.size", "p.lo", "p.hi", "p._start", F.col("p.block").alias("block"), F.posexplode("u.tooks").alias("time", "took"))
    base = F.col("block") * block_words - F.col("_start")
    each = each.select("_key", "size", "time", (base + F.col("lo")).alias("a"), (base + F.least("took", "hi")).alias("z")).filter("z > a")
    order = Window.partitionBy("_key", "time").orderBy("a")
    each = each.withColumn("new", (F.coalesce(F.lag("z").over(order), F.lit(-1)) != F.col("a")).cast("int"))
    each = each.withColumn("stretch", F.sum("new").over(order))
    found = each.groupBy("_key", F.col("size").alias("_words"), "time", "stretch").agg(F.min("a").alias("_a"), F.max("z").alias("_z"))
    cut = F.pandas_udf(_cut_words, "string")
    return rows.join(found, "_key").withColumn(text, cut(F.col(text), F.col("_a"), F.col("_z"), F.col("_words"))).select(docs.columns)
