"""The loci whose surroundings are folded, and the contigs that they need."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ANCHORS = {"representative": ("rep_start", "rep_end"), "locus": ("start", "end")}


def selected(loci: DataFrame, named: DataFrame | None = None, anchor: str = "representative") -> tuple[DataFrame, DataFrame]:
    """candidate, genome, contig, strand, start, end, and the named ids that no locus has.

    Without names (column ``locus_id``, repeats don't count) the loci that pass are taken. ``anchor``: the interval of the representative read or of the locus.
    """
    if anchor not in ANCHORS:
        raise ValueError("anchor must be representative or locus")
    start, end = ANCHORS[anchor]
    wanted = (loci.filter("pass") if named is None else named).select("locus_id").distinct()
    rows = loci.join(wanted, "locus_id", "left_semi")
    found = rows.select(F.col("locus_id").alias("candidate"), "genome", "contig", "strand", F.col(start).cast("long").alias("start"), F.col(end).cast("long").alias("end"))
    return found, wanted.join(loci.select("locus_id"), "locus_id", "left_anti")


def needed_contigs(candidates: DataFrame, contigs: DataFrame) -> DataFrame:
    """The contigs (genome, contig, sequence, circular) that hold candidates. A contig that is missing is an error, raised before anything is folded."""
    needed = candidates.select("genome", "contig").distinct()
    missing = needed.join(contigs.select("genome", "contig"), ["genome", "contig"], "left_anti").sort("genome", "contig").limit(10).collect()
    if missing:
        raise ValueError("contigs of candidates that no genome has: " + ", ".join(f"{r.genome}|{r.contig}" for r in missing))
    return contigs.join(needed, ["genome", "contig"], "left_semi")
