"""Outcomes of planted features against brute force and by hand; what explains false positives; rejected reads."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from locusmill.operators import evaluation

PLACE = "genome string, contig string, strand string, start long, end long, length long, circular boolean"
FEATURE = "feature_id string, category string, expected string, sequence string, " + PLACE
LOCUS = "locus_id string, kind string, pass boolean, total double, rep_start long, rep_end long, " + PLACE


def lone(spark, features, loci):
    """Features (id, category, expected, start, end) and loci (id, start, end, kind, pass, total) on one circular contig of 1,000 bases, representatives as long as their loci."""
    f = spark.createDataFrame([(i, c, x, None, "g", "c", "+", a, z, 1000, True) for i, c, x, a, z in features], FEATURE)
    l = spark.createDataFrame([(i, k, p, t, a, z, "g", "c", "+", a, z, 1000, True) for i, a, z, k, p, t in loci], LOCUS)  # noqa: E741
    return f, l


def test_merged_is_judged_by_other_small_rnas(spark):
    f, l = lone(spark, [("a", "srna", "pass", 100, 130), ("x", "degradation", "any", 105, 120), ("b", "srna", "merged", 300, 340), ("c", "srna", "any", 310, 325)], [("la", 100, 130, "peak", True, 9.0), ("lb", 301, 330, "peak", True, 9.0)])  # noqa: E741
    got = {r["feature_id"]: (r["outcome"], r["as_expected"]) for r in evaluation.outcomes(f.filter("category <> 'degradation'"), l).collect()}
    assert got == {"a": ("pass", True), "b": ("merged", True), "c": ("merged", True)}


def test_own_locus_is_its_representatives(spark):
    f, l = lone(spark, [("a", "srna", "pass", 100, 130), ("w", "srna", "pass", 990, 1012)], [("la", 80, 130, "peak", True, 9.0), ("lw", 985, 1012, "peak", True, 5.0)])  # noqa: E741
    moved = l.withColumn("rep_start", F.when(F.col("locus_id") == "la", 102).otherwise(993 - 1000))
    got = {r["feature_id"]: (r["outcome"], r["best_offset"]) for r in evaluation.outcomes(f, moved).collect()}
    assert got == {"a": ("pass", 2), "w": ("pass", 3)}
    got = {r["feature_id"]: r["outcome"] for r in evaluation.outcomes(f, l).collect()}
    assert got == {"a": "merged", "w": "merged"}  # loci that start elsewhere and cover


def brute(features, loci, length, circular):
    shifts = lambda f: (0, length, -length) if circular[f[4], f[5]] else (0,)
    shared = lambda f, l: max(max(0, min(f[8], l[10] + s) - max(f[7], l[9] + s)) for s in shifts(f))
    out = {}
    for f in features:
        met = [l for l in loci if l[6:9] == f[4:7] and shared(f, l) > 0]
        off = lambda l: ((l[4] - f[7] if f[6] == "+" else f[8] - l[5]) + length // 2) % length - length // 2
        near = [l for l in met if abs(off(l)) <= 3]
        own = [l for l in near if l[3] >= 0.1 * max(x[3] for x in near)]
        covers = lambda l, o: shared(o, l) == o[8] - o[7]
        covering = [l for l in met if covers(l, f)]
        if len(own) > 1:
            seen = "split"
        elif own:
            others = [o for o in features if o is not f and o[1].startswith("srna") and o[4:7] == f[4:7]]
            seen = "background" if own[0][1] == "background" else "merged" if any(covers(own[0], o) for o in others) else "pass" if own[0][2] else "fail"
        elif covering:
            seen = "background" if all(l[1] == "background" for l in covering) else "merged"
        else:
            seen = "partial" if met else "missed"
        fine = not any(l[2] for l in own) if f[2] == "fail" else seen == f[2] or f[2] == "any"
        out[f[0]] = (seen, fine, ",".join(sorted(l[0] for l in met)))
    return out


def test_outcomes_by_brute_force(spark):
    rng, length, circular = random.Random(11), 400, {("g", "m"): True, ("g", "n"): False, ("h", "m"): True}
    features, loci, seen = [], [], Counter()
    for k in range(160):
        place = rng.choice(list(circular))
        a = rng.randint(0, length - 1 if circular[place] else length - 30)
        features.append((f"f{k:03}", rng.choice(["srna_x", "srna", "trf5_a", "trf3_cca"]), rng.choice(evaluation.OUTCOMES + ("any",)), None, *place, rng.choice("+-"), a, a + rng.randint(8, 30)))
    for k in range(90):
        place = rng.choice(list(circular))
        a = rng.randint(0, length - 1 if circular[place] else length - 60)
        z = a + rng.randint(12, 60)
        r = rng.randint(a, z - 10)
        loci.append((f"l{k:03}", rng.choice(["peak", "peak", "background"]), rng.random() < 0.5, float(rng.choice([1, 5, 100])), r, r + 10, *place, rng.choice("+-"), a, z))
    want = brute(features, loci, length, circular)
    f = spark.createDataFrame([(*x, length, circular[x[4], x[5]]) for x in features], FEATURE).repartition(3)
    l = spark.createDataFrame([(*x, length, circular[x[6], x[7]]) for x in loci], LOCUS).repartition(2)  # noqa: E741
    got = {r["feature_id"]: (r["outcome"], r["as_expected"], r["loci"]) for r in evaluation.outcomes(f, l).collect()}
    assert got == want
    seen = Counter(v[0] for v in want.values())
    assert set(seen) == set(evaluation.OUTCOMES)
    # the table of counts
    by = defaultdict(Counter)
    for x in features:
        by[x[1], x[2]][want[x[0]][0]] += 1
    text = {k: ", ".join(f"{o} {n}" for o, n in sorted(c.items(), key=lambda x: (-x[1], x[0]))) for k, c in by.items()}
    assert {(r["category"], r["expected"]): r["observed"] for r in evaluation.outcome_counts(evaluation.outcomes(f, l)).collect()} == text


def test_false_positives_are_explained(spark):
    f, l = lone(spark, [("s", "srna", "any", 100, 120), ("d", "degradation", "any", 300, 330), ("e", "trf5", "any", 320, 360), ("w", "repeat", "any", 995, 1005)], [("l1", 110, 130, "peak", True, 1.0), ("l2", 310, 340, "peak", True, 1.0), ("l3", 600, 620, "peak", True, 1.0), ("l4", 0, 20, "peak", True, 1.0), ("l5", 700, 720, "peak", False, 1.0)])  # noqa: E741
    assert {r["locus_id"]: r["explained_by"] for r in evaluation.false_positives(f, l).collect()} == {"l2": "d,e", "l3": "none", "l4": "w"}


def test_report_columns_and_summary(spark):
    f, l = lone(spark, [("a", "srna", "pass", 100, 120), ("w", "srna", "any", 995, 1015), ("z", "srna", "any", 500, 520)], [("la", 101, 140, "peak", True, 4.0), ("lw", 995, 1015, "peak", False, 2.0)])  # noqa: E741
    f = f.withColumn("sequence", F.when(F.col("feature_id") == "a", "ACGT").when(F.col("feature_id") == "w", ""))
    extra = {"rep_sequence": F.lit("ACGT"), "five_score": F.lit(1.0), "three_score": F.lit(0.5), "class": F.lit("gene")}
    table = evaluation.outcome_table(evaluation.outcomes(f, l), l.withColumns(extra))
    got = {r["feature_id"]: (r["locus_start"], r["locus_end"], r["extra_span"], r["rep_is_canonical"], r["rep_five_offset"], r["outcome"]) for r in table.collect()}
    assert got == {"a": (102, 140, 19, True, 1, "pass"), "w": (996, 15, 0, None, 0, "fail"), "z": (None, None, None, None, None, "missed")}
    assert tuple(evaluation.found_summary(table).first()) == (3, 2 + 1, 2, 1, 1, 1, 1)


def test_expected_column_and_focus(spark):
    f = spark.createDataFrame([("a", "srna", "x", "best", "sev", "", "g"), ("b", "trf3_cca_1", "y", "", "sev", "ev", "g"), ("c", "degradation", "z", "b", "s", "e", "g"), ("d", "srna", "z", "b", "s", "e", "h")], "feature_id string, category string, expected string, expected_best string, expected_severe string, expected_evil string, genome string")
    of = lambda *mode: [r["expected"] for r in evaluation.with_expected(f, *mode).sort("feature_id").limit(2).collect()]
    assert of("best") == ["best", "y"] and of("evil") == ["sev", "sev"] and of("evil", 1) == ["x", "ev"] and of("other") == ["x", "y"]
    genomes = spark.createDataFrame([("g", "focus"), ("h", "exclude")], "genome string, role string")
    assert sorted(r["feature_id"] for r in evaluation.judged_features(f, genomes).collect()) == ["a", "b"]


def test_rejected_reads(spark):
    by = spark.createDataFrame([("a", 6, 10), ("b", 5, 10), ("c", 0, 4)], "feature_id string, evil_rejected long, matched_reads long")
    origin = spark.createDataFrame([("r1", "evil_rejected"), ("r2", "assigned"), ("r3", "evil_rejected")], "read_id string, class string")
    counts = spark.createDataFrame([("r1", 9), ("r1", 4), ("r2", 7), ("r3", 1)], "read_id string, n long")
    judged = spark.createDataFrame([("a", "fail", "missed"), ("b", "pass", "missed"), ("c", "pass", "pass")], "feature_id string, expected string, outcome string")
    sums, rows = evaluation.rejected_reads(by, origin, counts, judged)
    assert [tuple(r) for r in sums.collect()] == [(14, 11, 3)]
    assert sorted(map(tuple, rows.collect())) == [("a", 6, 10, "fail", "missed", True, True), ("b", 5, 10, "pass", "missed", False, False)]
    sums, rows = evaluation.rejected_reads(by.limit(0), origin.filter("class = 'assigned'"), counts, judged)
    assert [tuple(r) for r in sums.collect()] == [(0, 0, 0)] and rows.count() == 0


def test_checked_intervals(spark):
    import pytest

    from locusmill.functions.circular import checked_interval

    rows = spark.createDataFrame([(1, 10), (8, 3), (10, 10)], "a long, z long")
    start, end = checked_interval(F.col("a"), F.col("z"), F.lit(10))
    assert [tuple(r) for r in rows.select(start, end).collect()] == [(0, 10), (7, 13), (9, 10)]
    for a, z in ((0, 5), (3, 11), (11, 2)):
        with pytest.raises(Exception, match="leaves a contig"):
            spark.createDataFrame([(a, z)], "a long, z long").select(start, end).collect()
