"""Cutting intervals out of long sequences: contigs are held in pieces, and an interval is put together from the pieces it touches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bases of a piece, and of a piece that short stretches are cut from.
PIECE, SHORT = 1 << 14, 1000


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` dealt by ``keys`` over as many partitions as a shuffle has, however few bytes they are: each is about to become many rows."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def pieces(contigs: DataFrame, key: str = "ref", size: int | None = None) -> DataFrame:
    """key, piece, bases of contigs (key, sequence): bases ``piece * size`` on, ``size`` of them but in the last one."""
    size = size or PIECE
    cut = F.regexp_extract_all("sequence", F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return contigs.select(key, F.posexplode(cut).alias("piece", "bases"))


def cut(spans: DataFrame, held: DataFrame, row: list[str], key: str = "ref", size: int | None = None) -> DataFrame:
    """row, sequence: the bases of spans (row, part, key, start, end; half-open) of contigs in ``pieces``.

    Spans of one row are joined in the order of ``part``. What lies beyond a contig is left out; rows without any base are missing. Each span meets the
    pieces it touches by an equi-join, so no row ever holds a whole contig.
    """
    size = size or PIECE
    last = F.floor((F.col("end") - 1) / size)
    touched = spans.filter(F.col("end") > F.col("start")).withColumn("piece", F.explode(F.sequence(F.floor(F.greatest("start", F.lit(0)) / size).cast("int"), last.cast("int"))))
    met = touched.join(held, [key, "piece"])
    first = F.col("piece").cast("long") * size
    a, z = F.greatest("start", first), F.least("end", first + size)
    text = F.substring("bases", (a - first + 1).cast("int"), (z - a).cast("int"))
    whole = F.array_sort(F.collect_list(F.struct("part", "piece", text.alias("text"))))
    return met.groupBy(*row).agg(F.array_join(F.transform(whole, lambda x: x["text"]), "").alias("sequence"))


def with_stretch(found: DataFrame, targets: DataFrame, before: int, after: int, longest: int) -> DataFrame:
    """Add ``stretch``, the target's bases from ``before`` bases before a site to ``after`` behind it, and ``stretch_start``.

    Targets are cut into pieces that overlap by that much, and a site meets the piece it starts in, so no row ever holds a whole target.
    """
    if max(before, after + longest) > SHORT:
        raise ValueError(f"a stretch reaches {SHORT} bases at most")
    cut = F.regexp_extract_all("sequence", F.lit(f".{{1,{SHORT}}}"), F.lit(0))
    side = lambda x, f, n: F.coalesce(f(x, F.lit(n)), F.lit(""))
    whole = F.transform("p", lambda x, i: F.concat(F.when(i > 0, side(F.get("p", i - 1), F.right, before)).otherwise(""), x, side(F.get("p", i + 1), F.left, after + longest)))
    pieces = targets.select("seq_id", cut.alias("p")).select("seq_id", F.posexplode(whole).alias("_i", "_piece"))
    rows = found.withColumn("_i", F.floor(F.col("start") / SHORT).cast("int")).join(pieces, ["seq_id", "_i"])
    at = F.greatest(F.col("start") - before, F.lit(0))
    first = F.greatest(F.col("_i") * SHORT - before, F.lit(0))
    return rows.withColumn("stretch_start", at.cast("long")).withColumn("stretch", F.substring("_piece", (at - first + 1).cast("int"), (F.col("end") + after - at).cast("int"))).drop("_i", "_piece")
