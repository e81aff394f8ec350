"""Windows of target sequences for fitting a predictor's background: drawn by length, at random offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusmill.operators.intervals import overlap_join

#: Hex digits of a digest that place a sequence in a cell; cells are summed up one by one.
CELL_DIGITS = 3


def digest_number(*parts: Column) -> Column:
    """A whole number below 2^60 that follows from the parts alone."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 15), 16, 10).cast("long")


def cumulative(sequences: DataFrame, least: int) -> DataFrame:
    """seq_id, start, end: sequences (seq_id, sequence) of at least ``least`` bases laid end to end, in the order of their ids' digests.

    Ids are dealt into 4,096 cells by digest. Lengths are summed in each cell, cells from a row each, so no task orders the whole table.
    """
    sized = sequences.select("seq_id", F.char_length("sequence").cast("long").alias("n")).filter(F.col("n") >= least)
    digest = F.md5(F.col("seq_id").cast("string"))
    sized = sized.withColumn("digest", digest).withColumn("cell", F.substring("digest", 1, CELL_DIGITS))
    cells = sized.groupBy("cell").agg(F.sum("n").alias("held"))
    over = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # a row for each cell
    cells = cells.select("cell", F.coalesce(F.sum("held").over(over), F.lit(0)).alias("base"))
    inside = Window.partitionBy("cell").orderBy("digest").rowsBetween(Window.unboundedPreceding, -1)
    rows = sized.join(cells, "cell").withColumn("start", F.col("base") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return rows.select("seq_id", "start", (F.col("start") + F.col("n")).alias("end"))


def calibration_windows(sequences: DataFrame, length: int, n: int, seed: int = 1, least: int = 20) -> DataFrame:
    """draw, seq_id, start, window: ``n`` windows of ``length`` bases from sequences (seq_id, sequence; ids are unique), each sequence drawn by its length.

    Draws are with replacement and follow from ``seed`` and their number alone. A draw is a place in the sequences laid end to end, found by a range lookup in bins;
    its window starts anywhere in the sequence that holds the place. Sequences not longer than ``length`` are used whole, those under ``least`` bases never. Without any there are no windows.
    """
    if length < 1 or n < 0:
        raise ValueError("windows have bases, and there are none or more of them")
    laid = cumulative(sequences, least)
    total = laid.agg(F.max("end")).first()[0] or 0
    if not total:
        return sequences.limit(0).select(F.lit(0).cast("long").alias("draw"), "seq_id", F.lit(0).cast("long").alias("start"), F.col("sequence").alias("window"))
    spark = sequences.sparkSession
    draws = spark.range(n).withColumnRenamed("id", "draw")
    draws = draws.withColumn("start", digest_number(F.lit(seed), F.lit("place"), F.col("draw")) % total).withColumn("end", F.col("start") + 1).withColumn("all", F.lit(1))
    # as many bins as draws or so: long sequences stand in several
    drawn = overlap_join(draws, laid.withColumn("all", F.lit(1)), ["all"], bin_size=max(4096, total // max(1, n))).select("draw", F.col("r_seq_id").alias("seq_id"))
    rows = drawn.join(sequences.select("seq_id", "sequence"), "seq_id")
    room = F.greatest(F.char_length("sequence") - length + 1, F.lit(1))
    start = digest_number(F.lit(seed), F.lit("offset"), F.col("draw")) % room
    return rows.withColumn("start", start).select("draw", "seq_id", "start", F.substring("sequence", (F.col("start") + 1).cast("int"), F.lit(length)).alias("window"))
