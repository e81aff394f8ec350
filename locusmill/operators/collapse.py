"""Collapsing reads to distinct sequences, and counts of libraries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusmill.functions.sequences import normalised


def kept_reads(reads: DataFrame, low: int, high: int) -> DataFrame:
    """sample, sequence of normalised reads of the right length without N."""
    rows = reads.select("sample", normalised(F.col("sequence")).alias("sequence"))
    n = F.char_length("sequence")
    return rows.filter(n.between(low, high) & ~F.contains("sequence", F.lit("N")))


def libraries(reads: DataFrame, low: int, high: int) -> DataFrame:
    """Reads of each sample before and after ``kept_reads``."""
    seq = normalised(F.col("sequence"))
    keep = F.char_length(seq).between(low, high) & ~F.contains(seq, F.lit("N"))
    return reads.groupBy("sample").agg(F.count(F.lit(1)).alias("reads_in"), F.count_if(F.coalesce(keep, F.lit(False))).alias("reads_kept"))


def counts(reads: DataFrame, low: int, high: int) -> DataFrame:
    """sequence, sample, n."""
    return kept_reads(reads, low, high).groupBy("sequence", "sample").agg(F.count(F.lit(1)).alias("n"))


def collapse(reads: DataFrame, low: int, high: int) -> DataFrame:
    """read_id, sequence, length, total of each distinct sequence; ids by falling total, then by sequence.

    The rank is found without ordering all sequences in one task: totals with the first four bases make cells whose sizes are summed up in order (at
    most 256 cells for each distinct total), and rows are ranked inside their cell.
    """
    seqs = counts(reads, low, high).groupBy("sequence").agg(F.sum("n").alias("total"))
    seqs = seqs.withColumn("_head", F.substring("sequence", 1, 4))
    cells = seqs.groupBy("total", "_head").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(F.desc("total"), "_head").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy("total", "_head").orderBy("sequence")
    rank = F.col("_base") + F.row_number().over(inside)
    ranked = seqs.join(cells, ["total", "_head"]).withColumn("rank", rank)
    return ranked.select(F.format_string("u%09d", "rank").alias("read_id"), "sequence", F.char_length("sequence").alias("length"), "total")


def wide_counts(long: DataFrame, samples: list[str], key: str = "sequence") -> DataFrame:
    """One column of counts for each sample."""
    return long.groupBy(key).pivot("sample", samples).agg(F.sum("n")).na.fill(0, samples)
