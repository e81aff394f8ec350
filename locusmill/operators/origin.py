"""The genome of origin of reads that align to several."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusmill.functions.circular import folded

POLICIES, MULTIMAP, MODES = ("discard", "report", "split"), ("fractional", "unique"), ("best", "severe", "evil")
CLASSES = ("assigned", "ambiguous", "evil_rejected", "excluded", "multimap_dropped", "too_many_hits", "unmapped")


@dataclass(frozen=True)
class OriginRules:
    policy: str = "report"
    multimap: str = "fractional"
    mode: str = "best"
    evil_max_diff: int = 0
    max_hits: int | None = None
    max_mismatches: int | None = None

    def __post_init__(self) -> None:
        for name, known in (("policy", POLICIES), ("multimap", MULTIMAP), ("mode", MODES)):
            if getattr(self, name) not in known:
                raise ValueError(f"{name} must be one of {known}")
        if self.evil_max_diff < 0:
            raise ValueError("evil_max_diff must not be negative")


def distinct_hits(hits: DataFrame, contigs: DataFrame) -> DataFrame:
    """Hits (read_id, ref, start, end, strand, mismatches) with genome, contig and role, folded to the origin, each once.

    ``contigs``: ref, genome, contig, role, length, circular; small, one row for each contig.
    """
    rows = hits.join(contigs, "ref")
    at = folded(F.col("start"), F.col("length"), F.col("circular"))
    rows = rows.withColumn("end", at + F.col("end") - F.col("start")).withColumn("start", at)
    return rows.select("read_id", "genome", "contig", "role", "start", "end", "strand", "mismatches").distinct()


def classify(hits: DataFrame, rules: OriginRules) -> DataFrame:
    """read_id, class, genomes (sorted), top, n_top of each read with hits (the output of ``distinct_hits``).

    Counts by genome and mismatches are taken first, so a read with very many hits is a few rows of counts.
    """
    limit = F.lit(True) if rules.max_mismatches is None else F.col("mismatches") <= rules.max_mismatches
    strata = hits.groupBy("read_id", "genome", "role", "mismatches").agg(F.count(F.lit(1)).alias("n"))
    top = strata.groupBy("read_id").agg(
        F.min(F.when(limit, F.col("mismatches"))).alias("top"),
        F.min(F.when(F.col("role") != "focus", F.col("mismatches"))).alias("other"),
        F.collect_list(F.struct("genome", "role", "mismatches", "n")).alias("strata"),
    )
    at_top = F.filter("strata", lambda s: s["mismatches"] == F.col("top"))
    names = lambda a: F.array_sort(F.array_distinct(F.transform(a, lambda s: s["genome"])))
    top = top.withColumn("at", at_top).withColumn("genomes", names(F.col("at")))
    top = top.withColumn("focus", F.filter("at", lambda s: s["role"] == "focus"))
    top = top.withColumn("n_top", F.aggregate("at", F.lit(0).cast("long"), lambda a, s: a + s["n"]))
    none, focus = F.array().cast("array<string>"), F.size("focus") > 0
    many = F.lit(False) if rules.max_hits is None else F.col("n_top") > rules.max_hits
    worse = F.col("other") - F.col("top")
    evil = F.lit(rules.mode == "evil") & focus & F.coalesce((worse > 0) & (worse <= rules.evil_max_diff), F.lit(False))
    near = F.filter("strata", lambda s: (s["role"] != "focus") & (s["mismatches"] <= F.col("top") + rules.evil_max_diff))
    one = F.size("genomes") == 1
    dropped = F.lit(rules.multimap == "unique") & (F.col("n_top") > 1)
    cls = (
        F.when(F.col("top").isNull(), "unmapped").when(many, "too_many_hits").when(evil, "evil_rejected").when(~focus, "excluded")
        .when(one & dropped, "multimap_dropped").when(one, "assigned").otherwise("ambiguous")
    )
    rows = top.withColumn("class", cls)
    found = F.when(F.col("class").isin("unmapped", "too_many_hits"), none).when(F.col("class") == "evil_rejected", names(F.concat("focus", near))).otherwise(F.col("genomes"))
    return rows.select("read_id", "class", found.alias("genomes"), "top", "n_top")


def placements(hits: DataFrame, origin: DataFrame, rules: OriginRules) -> DataFrame:
    """Focus hits of the best stratum with their weight: of assigned reads, and of ambiguous ones if the policy splits them."""
    split = F.lit(rules.policy == "split" and rules.mode == "best") & (F.col("class") == "ambiguous")
    chosen = origin.filter((F.col("class") == "assigned") | split)
    rows = hits.filter("role = 'focus'").join(chosen, "read_id").filter("mismatches = top")
    return rows.select("read_id", "genome", "contig", "start", "end", "strand", (1.0 / F.col("n_top")).alias("weight"), "mismatches")


def with_unaligned(origin: DataFrame, reads: DataFrame, excess: DataFrame) -> DataFrame:
    """``origin`` with the reads that have no hit: set aside by the aligner (``excess``) or unmapped."""
    over = excess.select("read_id", F.lit(True).alias("_over")).distinct()
    rest = reads.select("read_id").join(origin, "read_id", "left_anti").join(over, "read_id", "left")
    cls = F.when(F.col("_over"), "too_many_hits").otherwise("unmapped")
    return origin.select("read_id", "class", "genomes").unionByName(rest.select("read_id", cls.alias("class"), F.array().cast("array<string>").alias("genomes")))


def origin_summary(origin: DataFrame, counts: DataFrame, by_length: bool = False) -> DataFrame:
    """class, genomes (``+`` between them), sample (and length): reads. ``counts``: read_id, sample, n (and length)."""
    keys = ["class", "label", "sample", *(["length"] if by_length else [])]
    rows = origin.withColumn("label", F.array_join("genomes", "+")).join(counts, "read_id")
    return rows.groupBy(*keys).agg(F.sum("n").alias("reads")).withColumnRenamed("label", "genomes")
