"""Results held against what was planted: reads of planted small RNAs, planted sites, planted hairpins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusmill.functions.sequences import parsed_interval
from locusmill.operators.seeds import class_rank

# Bases that a read shares with its small RNA, the least overlap and the most differences; classes of reads; a window's significance.
SHARED, LEAST_OVERLAP, MOST_DIFFERENCES = 8, 15, 2
ORIGIN_CLASSES = ("assigned", "ambiguous", "evil_rejected", "excluded", "multimap_dropped", "too_many_hits", "unmapped")
SIGNIFICANT = 0.05


def _kmers(key: str, at: str) -> Column:
    starts = F.sequence(F.lit(1), F.char_length("sequence") - SHARED + 1)
    return F.explode(F.transform(starts, lambda i: F.struct(F.substring("sequence", i, F.lit(SHARED)).alias("kmer"), i.alias(at)))).alias(key)


def owners(reads: DataFrame, planted: DataFrame) -> DataFrame:
    """read_id, feature_id of each read (read_id, sequence) that a planted small RNA (feature_id, position, sequence) owns.

    A read and a small RNA that share eight bases are laid over each other without gaps there; they fit with 15 bases in common and two differences at most. The
    closest fit owns: the most bases less differences, then the least position. Placements are met by a join on the shared bases, each verified once.
    """
    long_ = F.char_length("sequence") >= SHARED
    r = reads.filter(long_).select("read_id", F.col("sequence").alias("read"), _kmers("k", "i")).select("read_id", "read", "k.kmer", "k.i")
    f = planted.filter(long_).select("feature_id", "position", F.col("sequence").alias("own"), _kmers("k", "j")).select("feature_id", "position", "own", "k.kmer", "k.j")
    met = r.join(f, "kmer").select("read_id", "read", "feature_id", "position", "own", (F.col("j") - F.col("i")).alias("shift")).distinct()
    low = F.greatest(F.lit(0), -F.col("shift"))
    met = met.withColumn("low", low).withColumn("bases", F.least(F.char_length("read"), F.char_length("own") - F.col("shift")) - low).filter(F.col("bases") >= LEAST_OVERLAP)
    a, b = F.substring("read", F.col("low") + 1, F.col("bases")), F.substring("own", F.col("low") + F.col("shift") + 1, F.col("bases"))
    apart = F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x != y), lambda x: x))
    fits = met.withColumn("apart", apart).filter(F.col("apart") <= MOST_DIFFERENCES)
    return fits.groupBy("read_id").agg(F.min_by("feature_id", F.struct(F.col("apart") - F.col("bases"), F.col("position"))).alias("feature_id"))


def reads_by_origin(owned: DataFrame, origin: DataFrame, counts: DataFrame, planted: DataFrame) -> DataFrame:
    """Every planted small RNA with matched_reads, and those of each class of origin; classes besides the known ones are ``other``, reads without class unmapped."""
    cls = F.coalesce("class", F.lit("unmapped"))
    rows = owned.join(counts.groupBy("read_id").agg(F.sum("n").alias("n")), "read_id").join(origin.select("read_id", "class"), "read_id", "left").withColumn("class", F.when(cls.isin(*ORIGIN_CLASSES), cls).otherwise("other"))
    table = rows.groupBy("feature_id").pivot("class", [*ORIGIN_CLASSES, "other"]).agg(F.sum("n"))
    out = planted.select("feature_id").join(table, "feature_id", "left").na.fill(0, [*ORIGIN_CLASSES, "other"])
    return out.withColumn("matched_reads", sum((F.col(c) for c in ORIGIN_CLASSES), F.col("other")))


def candidates_of(features: DataFrame, candidates: DataFrame) -> DataFrame:
    """feature_id, candidate of features that passed (feature_id, rep_sequence), by the sequence of the candidate (candidate, sequence)."""
    one = candidates.groupBy("sequence").agg(F.max("candidate").alias("candidate"))
    return features.join(one, F.col("rep_sequence") == F.col("sequence"), "left").select("feature_id", "candidate")


def _meeting(planted: DataFrame, sites: DataFrame) -> DataFrame:
    """Planted sites (site_id, candidate, transcript, genomic_start, genomic_end) with the sites on the genome that touch them; both ends included."""
    at = parsed_interval(F.col("genomic"))
    s = sites.withColumn("_at", at).filter("_at.start IS NOT NULL")
    p = planted.select("site_id", F.col("candidate").alias("_c"), F.col("transcript").alias("_t"), "genomic_start", "genomic_end")
    same = (F.col("_c") == s["candidate"]) & (F.col("_t") == s["transcript"])
    return p.join(s, same & (F.col("_at.start") <= F.col("genomic_end")) & (F.col("_at.end") >= F.col("genomic_start")))


def planted_sites(planted: DataFrame, sites: DataFrame, scores: tuple[str, ...] = ()) -> DataFrame:
    """Every planted site with found_class (the strongest class of the sites that touch it) and found: that class is its own or a stronger one.

    ``scores``: columns of that site that are wanted too; of equal classes the first on the genome counts.
    """
    best = F.min_by(F.struct(F.col("site_class").alias("found_class"), *scores), F.struct(class_rank(F.col("site_class")), F.col("_at.start"), F.col("_at.end")))
    met = _meeting(planted, sites).groupBy("site_id").agg(best.alias("m")).select("site_id", "m.*")
    out = planted.join(met, "site_id", "left")
    return out.withColumn("found", F.coalesce(class_rank(F.col("found_class")) <= class_rank(F.col("site_class")), F.lit(False)))


def support_by_pairing(judged: DataFrame, levels: tuple[int, ...] = (1, 2)) -> DataFrame:
    """pairing, sites, and how many have each level of support."""
    kind = F.coalesce("pairing", F.lit("seed")).alias("pairing")
    return judged.groupBy(kind).agg(F.count(F.lit(1)).alias("sites"), *[F.count_if(F.col("support") >= x).alias(f"support_{x}") for x in levels])


def false_calls(planted: DataFrame, scored: DataFrame, levels: tuple[int, ...] = (1, 2)) -> DataFrame:
    """level, calls (scored sites with that support), not_planted and their share (null without calls). ``scored`` has a ``call_id``."""
    calls = scored.filter(F.col("support") >= min(levels))
    true = _meeting(planted, calls).select("call_id").distinct().withColumn("_true", F.lit(True))
    rows = calls.join(true, "call_id", "left").agg(*[F.count_if(F.col("support") >= x).alias(f"c{x}") for x in levels], *[F.count_if((F.col("support") >= x) & F.col("_true").isNull()).alias(f"f{x}") for x in levels])
    each = F.array(*[F.struct(F.lit(x).alias("level"), F.col(f"c{x}").alias("calls"), F.col(f"f{x}").alias("not_planted")) for x in levels])
    return rows.select(F.inline(each)).withColumn("share", F.try_divide("not_planted", "calls"))


def planted_hairpins(planted: DataFrame, windows: DataFrame) -> DataFrame:
    """Every planted hairpin (feature_id, candidate, arm) with its candidate's best window, and found: significant, a single hairpin, on the planted arm."""
    best = windows.filter("best").select("candidate", "window", "pvalue", "mfei", "single_hairpin", F.col("arm").alias("arm_found"))
    out = planted.join(best, "candidate", "left")
    good = (F.col("pvalue") <= SIGNIFICANT) & F.col("single_hairpin") & (F.col("arm_found") == F.col("arm"))
    return out.withColumn("found", F.coalesce(good, F.lit(False)))


def background_hairpins(planted: DataFrame, windows: DataFrame) -> DataFrame:
    """One row: the candidates without a planted hairpin whose best window has a p value, and how many of them are significant."""
    rest = windows.filter("best AND pvalue IS NOT NULL").join(planted.select("candidate").distinct(), "candidate", "left_anti")
    return rest.agg(F.count(F.lit(1)).alias("others"), F.count_if(F.col("pvalue") <= SIGNIFICANT).alias("significant"))
