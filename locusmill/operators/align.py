"""Ungapped alignment with few mismatches: a fuzzy join of reads and contigs by exact pieces.

A read with at most v mismatches has at least one of v + 1 pieces without any. Contigs stand in a table of k-mers, each row with the bases around
it; a piece meets the k-mers equal to its first bases, and the whole read is compared with the row's bases, three bits a base.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusmill.functions.sequences import reverse_complement
from locusmill.operators.kept import kept
from locusmill.operators.stretches import spread

#: Bases of three bits that a long holds.
LANES = 21
ONES = int("1" * LANES, 8)
#: Longest k-mer: longer pieces meet by their first bases. k-mers come in steps of two bases.
MOST, STEP = 16, 2
#: Bases of a piece of a contig.
PIECE = 1000


def digits(sequence: Column, other: str) -> Column:
    """A, C, G and T (U) as 0 to 3, any other letter as ``other``."""
    return F.regexp_replace(F.translate(F.upper(sequence), "ACGTU", "01233"), "[^0-3]", other)


def _octal(text: Column) -> Column:
    return F.coalesce(F.conv(text, 8, 10).cast("long"), F.lit(0))


def _before(text: Column, end: Column, words: int) -> list[Column]:
    """The digits of ``text`` up to its ``end``-th, the last one lowest, ``LANES`` in a long."""
    first = lambda j: F.greatest(end - LANES * (j + 1) + 1, F.lit(1))
    return [_octal(F.substring(text, first(j).cast("int"), F.greatest(end - LANES * j - first(j) + 1, F.lit(0)).cast("int"))) for j in range(words)]


def _after(text: Column, end: Column, words: int) -> list[Column]:
    """The digits of ``text`` behind its ``end``-th, the first one lowest, ``LANES`` in a long."""
    return [_octal(F.reverse(F.substring(text, (end + 1 + LANES * j).cast("int"), F.lit(LANES)))) for j in range(words)]


def _lanes(n: Column, word: int) -> Column:
    """Ones in the lanes of a word that the lowest ``n`` bases of all words fill."""
    here = F.least(F.greatest(n - LANES * word, F.lit(0)), F.lit(LANES))
    return F.call_function("shiftright", F.lit(ONES), (3 * (LANES - here)).cast("int"))


def differing(a: Column, b: Column) -> Column:
    """Ones in the lanes that differ."""
    d = a.bitwiseXOR(b)
    return d.bitwiseOR(F.shiftright(d, 1)).bitwiseOR(F.shiftright(d, 2)).bitwiseAND(F.lit(ONES))


def kmer_sizes(shortest: int, longest: int, parts: int) -> list[int]:
    """k of pieces of reads from ``shortest`` to ``longest`` bases: eight sizes at most."""
    return list(range(min(shortest // parts, MOST), min(-(-longest // parts), MOST) + 1, STEP))


@dataclass(frozen=True)
class KmerIndex:
    """A table of k-mers, its sizes, ascending by ``STEP``, and the bases around each."""

    table: DataFrame
    ks: tuple[int, ...]
    reach: int


def kmer_index(contigs: DataFrame, ks: list[int], reach: int) -> KmerIndex:
    """k, kmer, ref, at, b0, b1, ..., a0, a1, ... of contigs (ref, sequence): every k-mer of A, C, G, T, where it starts, and ``reach`` bases before (b) and from there on (a).

    The nearest base is in the lowest lane of the first long. Positions beyond a contig are 5, letters that match nothing 6. Work and rows are linear in the contigs' bases.
    It doesn't hold the reads and can be written once (``write_index``).
    """
    padded = F.concat(F.lit("-" * reach), "sequence", F.lit("-" * reach))
    cut = contigs.select("ref", F.regexp_extract_all(padded, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)).alias("p"))
    # a piece goes on with the next ones' first bases
    more = -(-2 * reach // PIECE) + 1
    whole = lambda x, i: F.left(F.concat(x, *[F.coalesce(F.get("p", i + j), F.lit("")) for j in range(1, more)]), F.lit(PIECE + 2 * reach - 1))
    cut = cut.select("ref", F.posexplode(F.transform("p", whole)).alias("i", "piece"))
    piece = F.regexp_replace(F.translate(F.upper("piece"), "ACGTU-", "012335"), "[^0-35]", "6")
    cut = cut.select("ref", "i", piece.alias("piece")).filter(F.char_length("piece") >= 2 * reach)
    rows = spread(cut, "ref", "i").select("ref", "i", "piece", F.explode(F.sequence(F.lit(0), F.least(F.char_length("piece") - 2 * reach, F.lit(PIECE - 1)))).alias("o"))
    rows = rows.select("ref", (F.col("i") * PIECE + F.col("o")).alias("at"), F.substring("piece", F.col("o") + 1, F.lit(2 * reach)).alias("around"))
    words = -(-reach // LANES)
    sides = [x.alias(f"{side}{j}") for side, of in (("b", _before), ("a", _after)) for j, x in enumerate(of(F.col("around"), F.lit(reach), words))]
    rows = rows.select("ref", "at", F.substring("around", reach + 1, min(MOST, reach)).alias("text"), *sides).select("*", F.explode(F.array(*map(F.lit, ks))).alias("k"))
    rows = rows.select("k", F.substring("text", F.lit(1), F.col("k")).alias("kmer"), "ref", "at", *[f"{side}{j}" for side in "ba" for j in range(words)]).filter((F.char_length("kmer") == F.col("k")) & ~F.col("kmer").rlike("[56]"))
    return KmerIndex(rows, tuple(ks), reach)


def write_index(index: KmerIndex, path: str) -> KmerIndex:
    """The table of k-mers, in folders by k and files by k-mer, and read from there."""
    index.table.repartition("k", "kmer").sortWithinPartitions("k", "kmer").write.partitionBy("k").parquet(path)
    return KmerIndex(index.table.sparkSession.read.schema(index.table.schema).parquet(path), index.ks, index.reach)


def align(reads: DataFrame, contigs: DataFrame | None, mismatches: int, best_only: bool = True, index: KmerIndex | None = None) -> DataFrame:
    """read_id, ref, start, end, strand, mismatches of every placement of reads (read_id, sequence) on contigs (ref, sequence).

    ``best_only``: only a read's placements with its fewest mismatches. Letters other than A, C, G, T match nothing; U is T. Reads as short as the number of pieces have none.
    Instead of contigs, ``index`` can be a ``kmer_index`` that reaches as many bases as the longest read has, with a least k that the shortest read's pieces have.
    """
    if not 0 <= mismatches <= 3:
        raise ValueError("0 to 3 mismatches")
    parts = mismatches + 1
    both = reads.select("read_id", F.explode(F.array(F.struct(F.lit("+").alias("strand"), F.col("sequence").alias("q")), F.struct(F.lit("-").alias("strand"), reverse_complement(F.col("sequence")).alias("q")))).alias("x"))
    both = both.select("read_id", "x.strand", digits(F.col("x.q"), "7").alias("q"), F.char_length("x.q").alias("n")).filter(F.col("n") >= parts)
    shortest, longest = both.agg(F.min("n"), F.max("n")).first()
    if not longest:
        return reads.select("read_id", F.lit("").alias("ref"), F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("").alias("strand"), F.lit(0).alias("mismatches")).limit(0)
    if index is None:
        index = kmer_index(contigs, kmer_sizes(shortest, longest, parts), longest)
    elif index.reach < longest or index.ks[0] > shortest // parts:
        raise ValueError(f"the index must reach {longest} bases and hold k-mers of {shortest // parts} bases or fewer")
    ks, reach = index.ks, index.reach
    edge = lambda i: F.floor(F.col("n") * i / parts).cast("int")
    fit = lambda n: F.least(F.lit(ks[0]) + F.floor((n - ks[0]) / STEP).cast("int") * STEP, F.lit(ks[-1]))
    words = range(-(-longest // LANES))
    piece = [F.struct(F.lit(i).alias("i"), edge(i).alias("lo"), fit(edge(i + 1) - edge(i)).alias("k")) for i in range(parts)]
    rows = both.select("read_id", "strand", "q", "n", F.array(*piece).alias("pieces")).select("*", F.explode("pieces").alias("p"))
    lo, i = F.col("p.lo"), F.col("p.i")
    # the read's bases on both sides of the piece's start, and the lanes that they fill
    own = [x.alias(f"q{side}{j}") for side, of in (("b", _before), ("a", _after)) for j, x in enumerate(of(F.col("q"), lo, len(words)))]
    filled = [_lanes(n, j).alias(f"m{side}{j}") for side, n in (("b", lo), ("a", F.col("n") - lo)) for j in words]
    # the lanes of each piece before this one
    gap = lambda e: lo - F.col("pieces")[e]["lo"]
    earlier = [F.when(i > e, _lanes(gap(e), j).bitwiseXOR(_lanes(gap(e) - F.col("pieces")[e]["k"], j))).otherwise(F.lit(0)).cast("long").alias(f"e{e}_{j}") for e in range(parts - 1) for j in words]
    rows = rows.select("read_id", "strand", "n", i.alias("i"), lo.alias("lo"), F.col("p.k").alias("k"), F.substring("q", lo + 1, F.col("p.k")).alias("kmer"), *own, *filled, *earlier)
    # the index has a row for each base of the contigs and each k, far more than their files let Spark expect: it is never broadcast
    met = rows.join(index.table.hint("merge"), ["k", "kmer"])
    off = {f"{side}{j}": differing(F.col(f"q{side}{j}"), F.col(f"{side}{j}")).bitwiseAND(F.col(f"m{side}{j}")) for side in "ba" for j in words}
    total = sum((F.bit_count(x) for x in off.values()), F.lit(0)).cast("int")
    met = met.filter(total <= mismatches)
    beyond = [F.col(c).bitwiseAND(F.shiftright(F.col(c), 2)).bitwiseAND(F.bitwise_not(F.shiftright(F.col(c), 1))).bitwiseAND(F.col(f"m{c}")) for c in off]
    for x in beyond:
        met = met.filter(x == 0)
    # a placement that several pieces find is the first one's
    for e in range(parts - 1):
        met = met.filter((F.col("i") <= e) | reduce(Column.__or__, [off[f"b{j}"].bitwiseAND(F.col(f"e{e}_{j}")) != 0 for j in words]))
    start = (F.col("at") - F.col("lo")).cast("int")
    met = met.select("read_id", "ref", start.alias("start"), (start + F.col("n")).alias("end"), "strand", total.alias("mismatches"))
    if best_only:
        met = met.withColumn("_best", F.min("mismatches").over(Window.partitionBy("read_id"))).filter("mismatches = _best").drop("_best")
    return met


def reported(reads: DataFrame, contigs: DataFrame, mismatches: int, max_hits: int, mode: str = "best", evil_max_diff: int = 0) -> tuple[DataFrame, DataFrame]:
    """The placements that origins are judged by, and the read_ids set aside for too many.

    In the modes ``best`` and ``severe`` these are a read's best placements, and a read with more than ``max_hits`` of them is set aside. ``evil`` compares with placements up to
    ``evil_max_diff`` mismatches worse, so all with up to ``mismatches + evil_max_diff`` (3 at most) are given, and none is set aside: ``origin.classify`` counts the best ones.
    """
    if mode not in ("best", "severe", "evil"):
        raise ValueError(f"no mode {mode}")
    if mode == "evil":
        if not 0 <= evil_max_diff <= mismatches:
            raise ValueError("evil_max_diff must be between 0 and mismatches")
        hits = align(reads, contigs, min(3, mismatches + evil_max_diff), best_only=False)
        return hits, hits.select("read_id").limit(0)
    hits = kept(align(reads, contigs, mismatches))
    many = hits.groupBy("read_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_hits).select("read_id")
    return hits.join(many, "read_id", "left_anti"), many
