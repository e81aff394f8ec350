"""Interval operators: merging, circular merging, overlap joins, coverage.

Contigs can be hot, so nothing here orders a whole contig in one task: positions are dealt into bins of ``BIN`` bases, what
crosses bins is carried over by one row for each bin, and overlap joins meet in bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["genome", "contig", "strand"]
BIN = 1 << 20


def block_starts(intervals: DataFrame, keys: list[str] = KEYS, gap: int = 0, bin_size: int = BIN) -> DataFrame:
    """Add ``block_start``: the start of the merged block of each interval. An interval joins a block that ends at most ``gap`` before it; touching counts.

    The farthest end so far is found inside each bin of starts and, over bins, from one row for each bin; so are the starts of
    blocks. Rows of a bin are ordered in one task, whole contigs are not.
    """
    binned = intervals.withColumn("_bin", F.floor(F.col("start") / bin_size))
    ends = binned.groupBy(*keys, "_bin").agg(F.max("end").alias("_end"))
    over_bins = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_before", F.max("_end").over(over_bins)).drop("_end")
    inside = Window.partitionBy(*keys, "_bin").orderBy("start", "end")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = binned.join(ends, [*keys, "_bin"])
    reach = F.greatest(F.max("end").over(earlier), F.col("_before"))  # greatest skips nulls
    rows = rows.withColumn("_new", F.when(reach.isNull() | (F.col("start") > reach + gap), F.col("start")))
    last = rows.groupBy(*keys, "_bin").agg(F.max("_new").alias("_last"))
    last = last.withColumn("_open", F.max("_last").over(over_bins)).drop("_last")
    upto = inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)  # with equal intervals, whichever of them opened the block
    rows = rows.join(last, [*keys, "_bin"]).withColumn("block_start", F.coalesce(F.max("_new").over(upto), F.col("_open")))
    return rows.drop("_bin", "_before", "_new", "_open")


def merge(intervals: DataFrame, keys: list[str] = KEYS, gap: int = 0) -> DataFrame:
    """One row for each block: start, end, n intervals."""
    rows = block_starts(intervals, keys, gap)
    return rows.groupBy(*keys, F.col("block_start").alias("start")).agg(F.max("end").alias("end"), F.count(F.lit(1)).alias("n"))


def circular_merge(blocks: DataFrame, contigs: DataFrame, keys: list[str] = KEYS, gap: int = 0) -> DataFrame:
    """Blocks in which, on a circular contig, the first block is joined to the last when the gap over the origin is small.

    ``contigs``: genome, contig, length, circular. The joined block ends beyond the contig; ``wraps`` tells which do.
    """
    edge = blocks.groupBy(*keys).agg(F.min(F.struct("start", "end", "n")).alias("_f"), F.max(F.struct("start", "end", "n")).alias("_l"), F.count(F.lit(1)).alias("_k"))
    edge = edge.join(contigs, ["genome", "contig"])
    edge = edge.withColumn("_join", F.col("circular") & (F.col("_k") > 1) & (F.col("_l.end") + gap - F.col("length") >= F.col("_f.start")))
    rows = blocks.join(edge.select(*keys, "_f", "_l", "_join", "length", "circular"), keys)
    first, last = F.col("_join") & (F.col("start") == F.col("_f.start")), F.col("_join") & (F.col("start") == F.col("_l.start"))
    rows = rows.filter(~first).withColumn("end", F.when(last, F.greatest("end", F.col("_f.end") + F.col("length"))).otherwise(F.col("end")))
    rows = rows.withColumn("n", F.when(last, F.col("n") + F.col("_f.n")).otherwise(F.col("n")))
    return rows.select(*keys, "start", "end", "n", (F.col("circular") & (F.col("end") > F.col("length"))).alias("wraps"))


def fold_origin(loci: DataFrame) -> DataFrame:
    """Loci (with length, circular) that start beyond a circular contig, moved back; ``wraps`` anew."""
    over = F.col("circular") & (F.col("start") >= F.col("length"))
    moved = loci.withColumn("end", F.when(over, F.col("end") - F.col("length")).otherwise(F.col("end")))
    moved = moved.withColumn("start", F.when(over, F.col("start") - F.col("length")).otherwise(F.col("start")))
    return moved.withColumn("wraps", F.col("circular") & (F.col("end") > F.col("length")))


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], bin_size: int = 4096) -> DataFrame:
    """Pairs of overlapping intervals. Columns of ``left`` keep their names, those of ``right`` but the keys get ``r_`` before theirs.

    Both sides stand in every bin they touch and meet in the first bin they share, so each pair comes once.
    """
    bins = lambda a, b: F.explode(F.sequence(F.floor(a / bin_size), F.floor((F.greatest(b, a + 1) - 1) / bin_size)))
    a = left.withColumn("_bin", bins(F.col("start"), F.col("end")))
    b = right.select(*keys, *[F.col(c).alias(f"r_{c}") for c in right.columns if c not in keys])
    b = b.withColumn("_bin", bins(F.col("r_start"), F.col("r_end")))
    met = a.join(b, [*keys, "_bin"])
    first = F.col("_bin") == F.floor(F.greatest("start", "r_start") / bin_size)
    return met.filter(first & (F.col("r_start") < F.col("end")) & (F.col("r_end") > F.col("start"))).drop("_bin")


def anti_overlap(left: DataFrame, right: DataFrame, keys: list[str], row: str) -> DataFrame:
    """Rows of ``left`` that overlap nothing in ``right``; ``row`` names its unique column."""
    hit = overlap_join(left.select(*keys, row, "start", "end"), right.select(*keys, "start", "end"), keys).select(row).distinct()
    return left.join(hit, row, "left_anti")


def signed_runs(intervals: DataFrame, weights: dict[str, Column], keys: list[str] = KEYS, bin_size: int = BIN) -> DataFrame:
    """keys, start, end and a running sum of each of ``weights``: runs [start, end) between neighbouring starts and ends of intervals.

    Each interval is an event of +weight at its start and one of -weight at its end; running sums go on over bins by a row each. Rows follow the intervals in number, not their bases.
    """
    names = list(weights)
    w = {n: c.cast("double") for n, c in weights.items()}
    event = lambda pos, sign: F.struct(F.col(pos).alias("pos"), *[(sign * c).alias(f"w{i}") for i, c in enumerate(w.values())])
    events = intervals.select(*keys, F.explode(F.array(event("start", 1), event("end", -1))).alias("e"))
    events = events.groupBy(*keys, F.col("e.pos").alias("start")).agg(*[F.sum(f"e.w{i}").alias(f"_w{i}") for i in range(len(names))]).withColumn("_bin", F.floor(F.col("start") / bin_size))
    bins = events.groupBy(*keys, "_bin").agg(*[F.sum(f"_w{i}").alias(f"_s{i}") for i in range(len(names))], F.min("start").alias("_first"))
    over = Window.partitionBy(*keys).orderBy("_bin")
    base = [F.coalesce(F.sum(f"_s{i}").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias(f"_b{i}") for i in range(len(names))]
    bins = bins.select(*keys, "_bin", *base, F.lead("_first").over(over).alias("_next"))
    inside = Window.partitionBy(*keys, "_bin").orderBy("start")
    sums = [(F.col(f"_b{i}") + F.sum(f"_w{i}").over(inside.rowsBetween(Window.unboundedPreceding, 0))).alias(n) for i, n in enumerate(names)]
    rows = events.join(bins, [*keys, "_bin"]).select(*keys, "start", F.coalesce(F.lead("start").over(inside), F.col("_next")).alias("end"), *sums)
    return rows.filter("end IS NOT NULL")


def depth_runs(intervals: DataFrame, weight: Column, keys: list[str] = KEYS, bin_size: int = BIN) -> DataFrame:
    """Runs [start, end) of equal depth > 0."""
    return signed_runs(intervals, {"depth": weight}, keys, bin_size).filter("depth > 1e-9")


def sample_runs(placed: DataFrame, contigs: DataFrame, weight: Column, samples: list[str]) -> DataFrame:
    """genome, contig, strand, start, end, depth and ``depth_<sample>``: the runs of reads (with sample) on contigs (genome, contig, length, circular), over the origin too."""
    rows = split_at_origin(placed.join(contigs.select("genome", "contig", "length", "circular"), ["genome", "contig"]).withColumn("_w", weight))
    each = {f"depth_{s}": F.when(F.col("sample") == s, F.col("_w")).otherwise(0.0) for s in samples}
    return signed_runs(rows, {"depth": F.col("_w"), **each}).filter("depth > 1e-9")


def split_at_origin(intervals: DataFrame) -> DataFrame:
    """Intervals (with length, circular) across the origin as two pieces: up to the contig's end, and from 0."""
    over = F.col("circular") & (F.col("end") > F.col("length"))
    piece = lambda a, b: F.struct(a.cast("long").alias("start"), b.cast("long").alias("end"))
    both = F.array(piece(F.col("start"), F.col("length")), piece(F.lit(0), F.col("end") - F.col("length")))
    rows = intervals.withColumn("_p", F.explode(F.when(over, both).otherwise(F.array(piece(F.col("start"), F.col("end"))))))
    return rows.withColumn("start", F.col("_p.start")).withColumn("end", F.col("_p.end")).drop("_p")


def coverage(placed: DataFrame, contigs: DataFrame, weight: Column) -> DataFrame:
    """genome, contig, strand, position (from 1), depth, five_ends of covered positions."""
    rows = placed.join(contigs, ["genome", "contig"]).withColumn("_w", weight)
    runs = depth_runs(split_at_origin(rows), F.col("_w"))
    depth = runs.select(*KEYS, F.explode(F.sequence("start", F.col("end") - 1)).alias("pos"), "depth")
    five = F.when(F.col("strand") == "+", F.col("start")).otherwise(F.col("end") - 1)
    five = F.when(F.col("circular") & (five >= F.col("length")), five - F.col("length")).otherwise(five)
    ends = rows.groupBy(*KEYS, five.alias("pos")).agg(F.sum("_w").alias("five_ends"))
    both = depth.join(ends, [*KEYS, "pos"], "left")
    return both.select(*KEYS, (F.col("pos") + 1).alias("position"), "depth", F.coalesce("five_ends", F.lit(0.0)).alias("five_ends"))


def binned_depth(cover: DataFrame, contigs: DataFrame, bins: int = 3000) -> DataFrame:
    """Depth summed over at most ``bins`` bins of a contig, empty bins as 0."""
    width = F.greatest(F.lit(1), F.ceil(F.col("length") / bins))
    frame = contigs.select("genome", "contig", width.alias("width"), F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / width))).alias("bin"))
    held = cover.join(contigs.select("genome", "contig", width.alias("width")), ["genome", "contig"])
    held = held.groupBy("genome", "contig", F.floor((F.col("position") - 1) / F.col("width")).alias("bin")).agg(F.sum("depth").alias("depth"))
    return frame.join(held, ["genome", "contig", "bin"], "left").select("genome", "contig", "bin", "width", F.coalesce("depth", F.lit(0.0)).alias("depth"))
