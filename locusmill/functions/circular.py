"""Arithmetic of coordinates on linear and circular contigs. Intervals are half-open from 0 unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def folded(start: Column, length: Column, circular: Column) -> Column:
    """A start in the overhang of a circular contig, moved back to the origin."""
    return F.when(circular & (start >= length), start - length).otherwise(start)


def signed_distance(a: Column, b: Column, length: Column, circular: Column) -> Column:
    """b - a, the shorter way round on a circular contig."""
    half = F.floor(length / 2)
    return F.when(circular, F.pmod(b - a + half, length) - half).otherwise(b - a)


def overlap(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Common bases of [a, b) and [c, d)."""
    return F.greatest(F.lit(0), F.least(b, d) - F.greatest(a, c))


def circular_overlap(a: Column, b: Column, c: Column, d: Column, length: Column, circular: Column) -> Column:
    """The largest overlap over shifts by the contig's length either way."""
    return F.when(circular, F.greatest(overlap(a, b, c, d), overlap(a, b, c + length, d + length), overlap(a, b, c - length, d - length))).otherwise(overlap(a, b, c, d))


def five_prime(start: Column, end: Column, strand: Column) -> Column:
    return F.when(strand == "+", start).otherwise(end - 1)


def one_based(start: Column, end: Column, length: Column) -> tuple[Column, Column, Column]:
    """start, end, wraps_origin as written: from 1, both included, the end within the contig."""
    wraps = end > length
    return start + 1, F.when(wraps, end - length).otherwise(end), wraps


def half_open(start: Column, end: Column, length: Column, wraps: Column) -> tuple[Column, Column]:
    """The other way: from 1 to half-open, the end beyond the contig where the origin is crossed."""
    return start - 1, F.when(wraps, end + length).otherwise(end)


def checked_interval(start: Column, end: Column, length: Column) -> tuple[Column, Column]:
    """A written interval (from 1, both included; over the origin if it ends before it starts) as half-open; one that leaves its contig is an error."""
    inside = (start >= 1) & (start <= length) & (end >= 1) & (end <= length)
    outside = F.raise_error(F.format_string("interval %s-%s leaves a contig of %s bases", start, end, length)).cast("bigint")
    a, z = half_open(start, end, length, end < start)
    return F.when(F.coalesce(inside, F.lit(False)), a).otherwise(outside), z


def precursor_windows(start: Column, end: Column, strand: Column, length: Column, circular: Column, near: int, far: int) -> Column:
    """The two windows in which a candidate is the 5' or the 3' arm of a hairpin: an array to explode.

    The far flank lies behind the candidate for the 5p window and before it for the 3p one, seen along its strand. Linear
    contigs clip windows; circular ones trim a window that is longer than the contig and start it inside.
    """
    forward = strand == "+"
    out = []
    for name in ("3p", "5p"):
        behind, before = (far, near) if name == "5p" else (near, far)
        a = F.when(forward, start - before).otherwise(start - behind)
        z = F.when(forward, end + behind).otherwise(end + before)
        clipped = ~circular & ((a < 0) | (z > length))
        over = F.when(circular, F.greatest(z - a - length, F.lit(0))).otherwise(F.lit(0))
        a2 = F.when(circular, a + F.ceil(over / 2)).otherwise(F.greatest(a, F.lit(0)))
        z2 = F.when(circular, z - F.floor(over / 2)).otherwise(F.least(z, length))
        shift = F.when(circular & (a2 < 0), length).when(circular & (a2 >= length), -length).otherwise(F.lit(0))
        lead = F.when(forward, start - a2).otherwise(z2 - end)
        out.append(
            F.struct(
                F.lit(name).alias("window"), (a2 + shift).cast("long").alias("win_start"), (z2 + shift).cast("long").alias("win_end"),
                lead.cast("long").alias("cand_from"), (lead + end - start).cast("long").alias("cand_to"), (circular & (z2 + shift > length)).alias("wraps"), clipped.alias("clipped"),
            )
        )
    return F.array(*out)
