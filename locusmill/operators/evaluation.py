"""Comparing found loci with planted features.

Planted features: feature_id, category, genome, contig, strand, start, end, length (of the contig), circular, expected. Found loci: locus_id, the same place,
kind (peak or background), pass, total, and rep_start, rep_end of the representative read. Intervals are half-open and may end beyond a circular contig.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusmill.functions.circular import circular_overlap, signed_distance
from locusmill.operators.intervals import overlap_join, split_at_origin

OUTCOMES = ("split", "background", "merged", "pass", "fail", "partial", "missed")
# Beginnings of the categories that are judged, how far from a feature's 5' end its own locus may start, and the least share of reads of a second own locus.
TARGETS, SMALL_RNA = ("srna", "trf5", "trf3_cca"), "srna"
OWN_DISTANCE, OWN_SHARE = 3, 0.1
#: Categories of reads of planted features that a mode turns away.
REJECTED = "evil_rejected"


def is_target(category: Column) -> Column:
    """Whether features of this category are judged."""
    out = F.lit(False)
    for c in TARGETS:
        out = out | F.startswith(category, F.lit(c))
    return out


def judged_features(features: DataFrame, genomes: DataFrame) -> DataFrame:
    """The features of judged categories on focus genomes (``genomes``: genome, role)."""
    return features.filter(is_target(F.col("category"))).join(genomes.filter("role = 'focus'").select("genome").distinct(), "genome", "left_semi")


def with_expected(features: DataFrame, mode: str, evil_max_diff: int = 0) -> DataFrame:
    """``features`` with the outcome expected in a mode from its column ``expected_<mode>``, or ``expected`` where it is empty or not there; evil without tolerance is severe."""
    column = f"expected_{'severe' if mode == 'evil' and evil_max_diff == 0 else mode}"
    if column not in features.columns:
        return features
    plain = F.col("expected") if "expected" in features.columns else F.lit(None).cast("string")
    return features.withColumn("expected", F.coalesce(F.nullif(F.col(column), F.lit("")), plain))


def circular_overlaps(truth: DataFrame, loci: DataFrame) -> DataFrame:
    """feature_id, locus_id, shared bases of overlapping intervals on the same genome, contig and strand, round the origin too, and covers: the locus holds the whole feature.

    Intervals across the origin meet as two pieces each.
    """
    keys = ["genome", "contig", "strand"]
    side = lambda df, row: split_at_origin(df.select(row, *keys, "start", "end", "length", "circular")).select(row, *keys, "start", "end")
    met = overlap_join(side(truth, "feature_id"), side(loci, "locus_id"), keys).select("feature_id", F.col("r_locus_id").alias("locus_id")).distinct()
    both = met.join(truth.select("feature_id", F.col("start").alias("a"), F.col("end").alias("b"), "length", "circular"), "feature_id").join(loci.select("locus_id", F.col("start").alias("c"), F.col("end").alias("d")), "locus_id")
    n = circular_overlap(F.col("a"), F.col("b"), F.col("c"), F.col("d"), F.col("length"), F.col("circular"))
    return both.select("feature_id", "locus_id", n.alias("shared"), (n >= F.col("b") - F.col("a")).alias("covers"))


def five_offset(feature: str, locus: str) -> Column:
    """How far inside the feature, along its strand, the representative's 5' end lies; the shorter way round the contig."""
    f, l = (lambda c: F.col(f"{feature}.{c}")), (lambda c: F.col(f"{locus}.{c}"))
    forward = signed_distance(f("start"), l("rep_start"), f("length"), F.lit(True))
    backward = signed_distance(l("rep_end"), f("end"), f("length"), F.lit(True))
    return F.when(f("strand") == "+", forward).otherwise(backward)


def meetings(truth: DataFrame, loci: DataFrame) -> DataFrame:
    """feature_id, locus_id, shared, covers, offset, own: the loci that overlap each feature. Own ones start near its 5' end and have a share of the strongest such one's reads."""
    met = circular_overlaps(truth, loci)
    rows = met.join(truth.select("feature_id", "start", "end", "strand", "length").alias("t"), "feature_id").join(loci.select("locus_id", "rep_start", "rep_end", "total").alias("l"), "locus_id")
    rows = rows.select("feature_id", "locus_id", "shared", "covers", F.col("l.total").alias("total"), five_offset("t", "l").alias("offset"))
    near = F.abs("offset") <= OWN_DISTANCE
    top = rows.filter(near).groupBy("feature_id").agg(F.max("total").alias("_top"))
    own = near & (F.col("total") >= OWN_SHARE * F.col("_top"))
    return rows.join(top, "feature_id", "left").select("feature_id", "locus_id", "shared", "covers", "offset", F.coalesce(own, F.lit(False)).alias("own"))


def outcomes(truth: DataFrame, loci: DataFrame) -> DataFrame:
    """Every judged feature with its outcome, whether it is as expected (``any`` always is), the loci that overlap it and its best locus.

    Several own loci: split. One: background if it is one, merged if it covers *another* small RNA, else pass or fail. None: background or merged if loci
    cover the feature (background if all of them are), partial if some overlap it, else missed. ``fail`` is as expected if no own locus passes.
    The best locus is the own one with most reads, else the overlapping one, of equal ones the first id.
    """
    met = meetings(truth, loci)
    facts = met.join(loci.select("locus_id", "kind", "pass", "total"), "locus_id")
    # how many small RNAs a locus covers, and whether the feature itself is one of them
    small = truth.filter(F.startswith("category", F.lit(SMALL_RNA))).select("feature_id", F.lit(True).alias("_small"))
    held = met.filter("covers").join(small, "feature_id").groupBy("locus_id").agg(F.count(F.lit(1)).alias("_held"))
    facts = facts.join(held, "locus_id", "left").join(small, "feature_id", "left")
    itself = F.when(F.col("covers") & F.col("_small"), 1).otherwise(0)
    facts = facts.withColumn("_others", F.coalesce("_held", F.lit(0)) - itself)
    order = F.struct((~F.col("own")).alias("own"), (-F.col("total")).alias("total"), "locus_id")
    seen = facts.groupBy("feature_id").agg(
        F.count_if("own").alias("own"), F.bool_or(F.col("own") & (F.col("_others") > 0)).alias("holds"), F.bool_or(F.col("own") & F.col("pass")).alias("own_pass"), F.bool_or(F.col("own") & (F.col("kind") == "background")).alias("own_background"),
        F.count_if("covers").alias("covering"), F.bool_and(F.when(F.col("covers"), F.col("kind") == "background")).alias("all_background"), F.count(F.lit(1)).alias("met"),
        F.array_join(F.array_sort(F.collect_list("locus_id")), ",").alias("loci"), F.min_by(F.struct("locus_id", "offset"), order).alias("best"),
    )
    rows = truth.join(seen, "feature_id", "left")
    one = F.col("own") == 1
    out = (
        F.when(F.col("own") > 1, "split").when(one & F.col("own_background"), "background").when(one & F.col("holds"), "merged").when(one & F.col("own_pass"), "pass").when(one, "fail")
        .when((F.col("covering") > 0) & F.col("all_background"), "background").when(F.col("covering") > 0, "merged").when(F.col("met") > 0, "partial").otherwise("missed")
    )
    rows = rows.withColumn("outcome", out)
    fine = F.when(F.col("expected") == "fail", ~F.coalesce("own_pass", F.lit(False))).otherwise((F.col("outcome") == F.col("expected")) | (F.col("expected") == "any"))
    return rows.select(*truth.columns, "outcome", fine.alias("as_expected"), F.coalesce("loci", F.lit("")).alias("loci"), F.col("best.locus_id").alias("best_locus"), F.col("best.offset").alias("best_offset"))


def outcome_table(judged: DataFrame, loci: DataFrame) -> DataFrame:
    """``judged`` (``outcomes``; and sequence, if known) as a report has it: with the best locus's place, how much longer it is than the feature, and whether its representative is the planted sequence.

    ``loci`` also have rep_sequence, five_score, three_score and class. Places are 1-based, as written.
    """
    l = loci.select(F.col("locus_id").alias("best_locus"), (F.col("start") + 1).alias("locus_start"), F.when(F.col("end") > F.col("length"), F.col("end") - F.col("length")).otherwise(F.col("end")).alias("locus_end"), (F.col("end") - F.col("start")).alias("_span"), "kind", "total", "rep_sequence", "five_score", "three_score", "class")  # noqa: E741
    rows = judged.join(l, "best_locus", "left")
    own = F.nullif(F.col("sequence"), F.lit("")) if "sequence" in judged.columns else F.lit(None).cast("string")
    return rows.select(
        "feature_id", "category", "strand", (F.col("start") + 1).alias("start"), "end", (F.col("end") - F.col("start")).alias("length"), "expected", "outcome", "as_expected", F.col("loci").alias("locus_id"), "locus_start", "locus_end",
        F.col("kind").alias("locus_type"), (F.col("_span") - (F.col("end") - F.col("start"))).alias("extra_span"), "rep_sequence", (F.col("rep_sequence") == own).alias("rep_is_canonical"), F.col("best_offset").alias("rep_five_offset"),
        F.col("total").alias("locus_count"), "five_score", "three_score", F.col("class").alias("annotation_class"),
    )


def false_positives(features: DataFrame, loci: DataFrame) -> DataFrame:
    """Passing loci that overlap no planted small RNA, with ``explained_by``: the planted features that they do overlap, the longest overlap first, or ``none``."""
    passing = loci.filter("pass")
    met = circular_overlaps(features, passing).join(features.select("feature_id", "category"), "feature_id")
    met = met.groupBy("locus_id").agg(F.bool_or(F.startswith("category", F.lit(SMALL_RNA))).alias("_small"), F.array_sort(F.collect_list(F.struct((-F.col("shared")).alias("n"), "feature_id"))).alias("_by"))
    rows = passing.join(met, "locus_id", "left").filter(~F.coalesce("_small", F.lit(False)))
    names = F.array_join(F.transform("_by", lambda x: x["feature_id"]), ",")
    return rows.withColumn("explained_by", F.coalesce(names, F.lit("none"))).drop("_small", "_by")


def outcome_counts(rows: DataFrame) -> DataFrame:
    """category, expected, features, observed: how often each outcome was seen, the most common first, equal ones by name, as ``pass 3, fail 1``."""
    each = rows.groupBy("category", "expected", "outcome").agg(F.count(F.lit(1)).alias("n"))
    seen = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "outcome")))
    return each.groupBy("category", "expected").agg(F.sum("n").alias("features"), F.array_join(F.transform(seen, lambda x: F.concat_ws(" ", x["outcome"], (-x["m"]).cast("string"))), ", ").alias("observed"))


def found_summary(table: DataFrame) -> DataFrame:
    """One row on the small RNAs of ``outcome_table``: how many there are and as expected; of those with a locus, representatives that are the planted sequence, start at its 5' end, loci over 10 bases longer."""
    small = table.filter(F.startswith("category", F.lit(SMALL_RNA)))
    found = F.col("outcome").isin("pass", "fail", "merged")
    return small.agg(
        F.count(F.lit(1)).alias("small_rnas"), F.count_if("as_expected").alias("as_expected"), F.count_if(found).alias("found"), F.count_if(found & F.col("rep_is_canonical").isNotNull()).alias("with_sequence"),
        F.count_if(found & F.col("rep_is_canonical")).alias("canonical"), F.count_if(found & (F.col("rep_five_offset") == 0)).alias("exact_five"), F.count_if(found & (F.col("extra_span") > 10)).alias("embedded"),
    )


def rejected_reads(by_origin: DataFrame, origin: DataFrame, counts: DataFrame, judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What became of reads that the mode evil turned away: one row of sums, and a row for each planted feature that lost reads.

    ``by_origin`` (``planted.reads_by_origin``), ``origin`` (read_id, class), ``counts`` (read_id, n) and ``judged`` (``outcomes``). The sums: rejected reads of the run, those of planted
    features, and the rest. Features: their rejected and matched reads, expected and outcome, whether more than half of the matched reads were rejected (``mostly``), and ``lost``: so, and no pass.
    """
    total = counts.join(origin.filter(F.col("class") == REJECTED).select("read_id"), "read_id", "left_semi").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rejected"))
    rows = by_origin.filter(F.col(REJECTED) > 0).select("feature_id", F.col(REJECTED).cast("long").alias("rejected"), F.col("matched_reads").cast("long").alias("matched_reads"))
    rows = rows.join(judged.select("feature_id", "expected", "outcome"), "feature_id", "left")
    mostly = 2 * F.col("rejected") > F.col("matched_reads")
    rows = rows.withColumn("mostly", mostly).withColumn("lost", F.coalesce(mostly & (F.col("outcome") != "pass"), F.lit(False)))
    zero = F.lit(0).cast("long")
    both = total.select("rejected", zero.alias("explained")).unionByName(rows.select(zero.alias("rejected"), F.col("rejected").alias("explained")))
    sums = both.agg(F.sum("rejected").alias("rejected"), F.sum("explained").alias("explained"))
    return sums.withColumn("other", F.col("rejected") - F.col("explained")), rows
