"""False discovery rates against decoys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MIN_DECOY_SCORES = 20


#: Equal stretches of a key's scores that are ordered one by one.
SCORE_BINS = 1024


def site_count_fdr(counts: DataFrame, pooled: bool = False) -> DataFrame:
    """candidate, site_class (and any): real sites, mean and population sd of decoys, enrichment and FDR (null without a divisor).

    ``counts``: candidate, decoy (its number, null: real), site_class, n, zeros too. ``pooled``: also the candidate ``all``, whose decoy of a number is the sum of all
    candidates' decoys of that number. All sums are grouping sets of one aggregation.
    """
    candidate, decoy, cls = F.col("candidate"), F.col("decoy"), F.col("site_class")
    sets = [[candidate, decoy, cls], [candidate, decoy]] + ([[decoy, cls], [decoy]] if pooled else [])
    rows = counts.groupingSets(sets, candidate, decoy, cls).agg(F.sum("n").alias("n"), F.grouping("candidate").alias("_all"), F.grouping("site_class").alias("_any"))
    name = F.when(F.col("_all") == 1, "all").otherwise(candidate.cast("string")) if pooled else candidate
    rows = rows.select(name.alias("candidate"), "decoy", F.when(F.col("_any") == 1, "any").otherwise(cls).alias("site_class"), "n")
    real, decoy = F.when(F.col("decoy").isNull(), F.col("n")), F.when(F.col("decoy").isNotNull(), F.col("n"))
    out = rows.groupBy("candidate", "site_class").agg(F.coalesce(F.sum(real), F.lit(0)).alias("real_sites"), F.coalesce(F.avg(decoy), F.lit(0.0)).alias("decoy_mean"), F.coalesce(F.stddev_pop(decoy), F.lit(0.0)).alias("decoy_sd"))
    positive = lambda c: F.when(F.col(c) > 0, F.col(c))
    return out.withColumn("enrichment", F.col("real_sites") / positive("decoy_mean")).withColumn("fdr", F.when(F.col("real_sites") > 0, F.least(F.lit(1.0), F.col("decoy_mean") / F.col("real_sites"))))


def q_values(scores: DataFrame, keys: list[str], score: str, n_decoys: int, pseudo: int = 0, higher_is_better: bool = False, times: str | None = None) -> DataFrame:
    """keys, threshold (a distinct real score), real_sites, decoy_sites, fdr, q of rows (keys, decoy flag ``is_decoy``, score).

    Rows are counted by distinct score first. At a threshold, decoys that pass (plus ``pseudo``) by ``n_decoys`` and by real ones that
    pass is the FDR; q is the least FDR of the thresholds at least as lax. A key's scores are dealt into bins from its least to its greatest one: running counts and the
    running minimum go on over bins by a row each, so no task orders all scores of a key. A row stands for ``times`` equal ones.
    """
    s = -F.col(score) if higher_is_better else F.col(score)
    rows = scores.filter(F.col(score).isNotNull()).groupBy(*keys, s.alias("_s")).agg(*[F.sum(F.when(c, F.col(times) if times else F.lit(1)).otherwise(0)).alias(x) for x, c in (("r", ~F.col("is_decoy")), ("d", F.col("is_decoy")))])
    span = rows.groupBy(*keys).agg(F.min("_s").cast("double").alias("_lo"), F.max("_s").cast("double").alias("_hi"))
    place = F.floor((F.col("_s").cast("double") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * SCORE_BINS)
    rows = rows.join(span, keys).withColumn("_bin", F.when(F.col("_hi") > F.col("_lo"), F.least(place, F.lit(SCORE_BINS - 1))).otherwise(0).cast("int")).drop("_lo", "_hi")
    over = Window.partitionBy(*keys).orderBy("_bin")
    before, behind = over.rowsBetween(Window.unboundedPreceding, -1), over.rowsBetween(1, Window.unboundedFollowing)
    sums = rows.groupBy(*keys, "_bin").agg(F.sum("r").alias("_r"), F.sum("d").alias("_d"))
    base = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c)
    sums = sums.select(*keys, "_bin", base("_r"), base("_d"))
    inside = Window.partitionBy(*keys, "_bin").orderBy("_s")
    up, down = inside.rowsBetween(Window.unboundedPreceding, 0), inside.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.join(sums, [*keys, "_bin"])
    rows = rows.withColumn("real_sites", F.col("_r") + F.sum("r").over(up)).withColumn("decoy_sites", F.col("_d") + F.sum("d").over(up)).filter("r > 0")
    rows = rows.withColumn("fdr", F.least(F.lit(1.0), (F.col("decoy_sites") + pseudo) / F.lit(float(max(1, n_decoys))) / F.col("real_sites")))
    least = rows.groupBy(*keys, "_bin").agg(F.min("fdr").alias("_f"))
    least = least.select(*keys, "_bin", F.min("_f").over(behind).alias("_rest"))
    out = rows.join(least, [*keys, "_bin"]).withColumn("q", F.least(F.lit(1.0), F.min("fdr").over(down), F.col("_rest")))
    return out.select(*keys, (-F.col("_s") if higher_is_better else F.col("_s")).alias("threshold"), "real_sites", "decoy_sites", "fdr", "q")


def with_class_fdr(rows: DataFrame, fdr: DataFrame, site_class: str = "site_class", out: str = "class_fdr") -> DataFrame:
    """``rows`` (candidate, a class) with the FDR of that class for their candidate (``site_count_fdr``)."""
    held = fdr.select(F.col("candidate").cast("string").alias("_c"), F.col("site_class").alias("_k"), F.col("fdr").alias(out))
    return rows.join(held, (F.col("candidate").cast("string") == F.col("_c")) & (F.col(site_class) == F.col("_k")), "left").drop("_c", "_k")


def standardised(scores: DataFrame, score: str, times: str | None = None) -> DataFrame:
    """Add ``z``: the score against the candidate's decoys, a decoy's against the other decoys, null where these are too few or all equal.

    ``scores``: candidate, decoy (its number, null: real), score. Sums by decoy are taken first, so leaving one out is a subtraction.
    A row stands for ``times`` equal ones.
    """
    x, k = F.col(score), F.col(times) if times else F.lit(1)
    own = scores.filter(F.col("decoy").isNotNull() & x.isNotNull()).groupBy("candidate", "decoy").agg(F.sum(k).cast("long").alias("_n1"), F.sum(x * k).alias("_s1"), F.sum(x * x * k).alias("_q1"))
    total = own.groupBy("candidate").agg(F.sum("_n1").alias("_n"), F.sum("_s1").alias("_s"), F.sum("_q1").alias("_q"), F.max("_n1").alias("_most")).filter(F.col("_n") - F.col("_most") >= MIN_DECOY_SCORES)
    rows = scores.join(total.drop("_most"), "candidate", "left").join(own, ["candidate", "decoy"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    n, s, q = (F.col(f"_{k}") - zero(F.col(f"_{k}1")) for k in "nsq")
    mean = F.try_divide(s, n)
    rows = rows.withColumn("_rest", n).withColumn("_mean", mean).withColumn("_var", F.try_divide(q, n) - mean * mean)
    z = F.when((F.col("_rest") >= MIN_DECOY_SCORES) & (F.col("_var") > 1e-12), F.bround((x - F.col("_mean")) / F.sqrt("_var"), 4))
    return rows.withColumn("z", z).select(*scores.columns, "z")


def empirical_p(folds: DataFrame, keys: list[str]) -> DataFrame:
    """keys, p: (shuffles at most as high as the real energy + 1) / (shuffles + 1), null without shuffles. Rows: keys, shuffle (null: real), mfe."""
    real = folds.filter("shuffle IS NULL").select(*keys, F.col("mfe").alias("_real"))
    rows = folds.filter("shuffle IS NOT NULL").join(real, keys)
    p = rows.groupBy(*keys).agg(((F.count_if(F.col("mfe") <= F.col("_real") + 1e-9) + 1) / (F.count(F.lit(1)) + 1)).alias("p"))
    return real.select(*keys).join(p, keys, "left")
