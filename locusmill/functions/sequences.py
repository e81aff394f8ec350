"""Sequence functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalised(seq: Column) -> Column:
    """Upper case, U as T."""
    return F.translate(F.upper(seq), "U", "T")


def reverse_complement(seq: Column) -> Column:
    """Of upper-case letters; letters other than A, C, G, T, U and N stay."""
    return F.reverse(F.translate(seq, "ACGTUN", "TGCAAN"))


def reverse_complement_any_case(seq: Column) -> Column:
    """As ``reverse_complement``, lower case too."""
    return F.reverse(F.translate(seq, "ACGTUNacgtun", "TGCAANtgcaan"))


def part(seq: Column, first: int | Column, last: int | Column) -> Column:
    """Bases ``first`` to ``last``, from 1, both included."""
    first, last = (F.lit(x) if isinstance(x, int) else x for x in (first, last))
    return F.substring(seq, first.cast("int"), (last - first + 1).cast("int"))


def share_of(seq: Column, letters: str) -> Column:
    """Share of the given letters in a sequence, 0 for an empty one."""
    held = F.char_length(seq) - F.char_length(F.translate(seq, letters, ""))
    return F.coalesce(F.try_divide(held, F.char_length(seq)), F.lit(0.0))


def gc_percent(seq: Column) -> Column:
    return 100 * share_of(seq, "GCgc")


def folding_indices(mfe: Column, seq: Column) -> tuple[Column, Column]:
    """AMFE (energy for 100 bases, positive for a folded sequence; 0 for an empty one) and MFEI (AMFE for one percent of G and C; null without any)."""
    amfe = F.coalesce(F.try_divide(-100 * mfe, F.char_length(seq)), F.lit(0.0))
    return amfe, F.try_divide(amfe, gc_percent(seq))


def flank_au(seq: Column, start: Column, end: Column, reach: int = 30) -> Column:
    """Share of A, U and T within ``reach`` bases on either side of [start, end), half-even to three digits."""
    low = F.greatest(start - reach, F.lit(0))
    left = F.substring(seq, (low + 1).cast("int"), (start - low).cast("int"))
    right = F.substring(seq, (end + 1).cast("int"), F.lit(reach))
    return F.bround(share_of(F.concat(left, right), "AUTaut"), 3)


def with_overhang(seq: Column, circular: Column, reach: int) -> Column:
    """A circular sequence followed by its first ``reach`` bases, so that reads across the origin align."""
    return F.when(circular, F.concat(seq, F.substring(seq, 1, reach))).otherwise(seq)


def occurrences(seq: Column, pattern: Column) -> Column:
    """Starts (from 0) of a pattern in a sequence, overlapping ones too."""
    k = F.char_length(pattern)
    starts = F.sequence(F.lit(0), F.greatest(F.char_length(seq) - k, F.lit(0)))
    return F.filter(starts, lambda i: F.substring(seq, i + 1, k) == pattern)


def poisson_tail(k: Column, mean: Column) -> Column:
    """P(X >= floor(k)) of a Poisson variable, by summing its terms below k."""
    n = F.floor(k + 1e-9).cast("int")
    term = "struct<term:double,cdf:double>"
    first = F.exp(-mean)
    below = F.aggregate(
        F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>")),
        F.struct(first.alias("term"), first.alias("cdf")).cast(term),
        lambda a, i: F.struct((a["term"] * mean / i).alias("term"), (a["cdf"] + a["term"] * mean / i).alias("cdf")).cast(term),
        lambda a: a["cdf"],
    )
    return F.when(n <= 0, F.lit(1.0)).otherwise(1.0 - below)


def poisson_significant(k: Column, mean: Column, p: float) -> Column:
    """Whether k reads stand out of a background mean; a count far above it does without a sum."""
    n = F.floor(k + 1e-9)
    return F.when(n <= 0, False).when(mean <= 0, True).when(n > mean + 10 * F.sqrt(mean) + 10, True).otherwise(poisson_tail(k, mean) < p)


def interval_text(contig: Column, start: Column, end: Column, strand: Column) -> Column:
    """``chr:10-17(+)``; null if any part is."""
    return F.concat(contig, F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"), F.lit("("), strand, F.lit(")"))


def parsed_interval(text: Column) -> Column:
    """contig, start, end, strand of ``interval_text``; the contig may hold colons. Nulls where the text isn't one."""
    part = lambda i: F.nullif(F.regexp_extract(text, r"^(.*):(\d+)-(\d+)(?:\((.)\))?$", i), F.lit(""))
    return F.struct(part(1).alias("contig"), part(2).cast("long").alias("start"), part(3).cast("long").alias("end"), part(4).alias("strand"))


def number_text(c: Column) -> Column:
    """Whole numbers without decimals, others with one, ties to the even digit."""
    x = c.cast("double")
    return F.when(x == F.floor(x), x.cast("decimal(38,0)").cast("string")).otherwise(F.bround(x, 1).cast("string"))


def seed_pairing(site_class: Column, start: Column, end: Column, t1: Column, seed: tuple[int, int] = (2, 8)) -> Column:
    """guide_from, guide_to (from 1), target_from, target_to (from 0, both included): the stretch that a site's class pairs."""
    pairing = lambda a, b, s, e: F.struct(F.lit(a).alias("guide_from"), F.lit(b).alias("guide_to"), s.cast("long").alias("target_from"), e.cast("long").alias("target_to"))
    long_, short = site_class.isin("8mer", "7mer-m8"), site_class.isin("7mer-A1", "6mer")
    return F.when(long_, pairing(2, 8, t1 - 7, t1 - 1)).when(short, pairing(2, 7, t1 - 6, t1 - 1)).when(site_class == "offset-6mer", pairing(3, 8, t1 - 7, t1 - 2)).otherwise(pairing(*seed, start, end - 1))


def pairing_window(pairing: Column, guide_length: Column, target_length: Column, flank: int) -> Column:
    """start, end of the stretch of a target that an interaction may use: the guide's length and ``flank`` before the pairing, two and ``flank`` behind it."""
    return F.struct(F.greatest(pairing["target_from"] - guide_length - flank, F.lit(0)).alias("start"), F.least(pairing["target_to"] + 2 + flank, target_length).alias("end"))
