"""Operators on small tables with known answers, and order-dependent ones against a plain walk."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusmill.functions import circular, sequences
from locusmill.operators import align, collapse, ends, evaluation, hairpins, intervals, loci, origin, peaks, regions, seeds, shuffles, significance
from locusmill.sources import sequences as seq_files
from locusmill.sources import tables


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_collapse(spark):
    reads = spark.createDataFrame([("a", "acguacguacguacguac"), ("a", "ACGTACGTACGTACGTAC"), ("b", "ACGTACGTACGTACGTAC"), ("b", "TTTTTTTTTTTTTTTTTT"), ("a", "ACGN" * 5), ("a", "ACG"), ("b", None)], "sample string, sequence string")
    got = collapse.collapse(reads, 18, 28)
    assert rows(got, "read_id", "sequence", "total") == [("u000000001", "ACGTACGTACGTACGTAC", 3), ("u000000002", "T" * 18, 1)]
    assert rows(collapse.libraries(reads, 18, 28), "sample", "reads_in", "reads_kept") == [("a", 4, 2), ("b", 3, 2)]


K = "genome string, contig string, strand string, start long, end long"


@pytest.mark.parametrize(("gap", "blocks"), [(0, [(10, 45), (50, 70)]), (5, [(10, 70)])])
def test_merge(spark, gap, blocks):
    df = spark.createDataFrame([("g", "c", "+", s, e) for s, e in ((10, 30), (25, 45), (50, 70), (25, 45))], K)
    assert rows(intervals.merge(df, gap=gap), "start", "end") == blocks


def test_merge_over_bins(spark):
    rng = random.Random(2)
    spans = [(s, s + rng.randint(1, 40)) for s in (rng.randint(0, 3000) for _ in range(150))]
    df = spark.createDataFrame([("g", "c", "+", s, e) for s, e in spans], K)
    want = []
    for s, e in sorted(spans):
        if want and s <= want[-1][1]:
            want[-1][1] = max(want[-1][1], e)
        else:
            want.append([s, e])
    got = intervals.block_starts(df, bin_size=100).groupBy("block_start").agg(F.max("end").alias("end"))
    assert rows(got, "block_start", "end") == [tuple(x) for x in want]


def test_circular_merge_and_coverage(spark):
    df = spark.createDataFrame([("g", "c", "-", 90, 110), ("g", "c", "-", 2, 22), ("g", "c", "-", 40, 60)], K)
    contigs = spark.createDataFrame([("g|c", "g", "c", "focus", 100, True)], "ref string, genome string, contig string, role string, length long, circular boolean")
    got = intervals.circular_merge(intervals.merge(df), contigs)
    assert rows(got, "start", "end", "wraps") == [(40, 60, False), (90, 122, True)]
    cover = intervals.coverage(df.limit(1), contigs, F.lit(2.0)).collect()
    assert sorted(r["position"] for r in cover) == [*range(1, 11), *range(91, 101)]
    assert [(r["position"], r["five_ends"]) for r in cover if r["five_ends"]] == [(10, 2.0)]


def test_overlaps(spark):
    rng = random.Random(4)
    a, b = ([(i, "g", "c", s, s + rng.randint(1, 60)) for i, s in enumerate(rng.randint(0, 500) for _ in range(60))] for _ in range(2))
    cols = "id long, genome string, contig string, start long, end long"
    left, right = spark.createDataFrame(a, cols), spark.createDataFrame(b, cols)
    want = sorted((x[0], y[0]) for x in a for y in b if y[3] < x[4] and y[4] > x[3])
    assert rows(intervals.overlap_join(left, right, ["genome", "contig"], bin_size=16), "id", "r_id") == want
    assert rows(intervals.anti_overlap(left, right, ["genome", "contig"], "id"), "id") == sorted({(x[0],) for x in a} - {(i,) for i, _ in want})


def test_ends(spark):
    profile = spark.createDataFrame([("a", 5, 9.0), ("b", 5, 5.0), ("b", 6, 5.0), ("c", 5, 5.0), ("c", 9, 5.0)], "key string, position long, w double")
    got = {r["key"]: (r["score"], r["top_share"]) for r in ends.end_scores(profile, "key", 0.9, 0.5).collect()}
    assert got == {"a": (1.0, 1.0), "b": (0.5, 0.5), "c": (1 / 3.5, 0.5)}
    # by default half of the reads, and a tenth for a gap
    more = spark.createDataFrame([("one", 5, 5.0), ("one", 6, 5.0), ("two", 5, 4.0), ("two", 9, 4.0), ("two", 7, 1.0), ("none", 3, 0.0)], "key string, position long, w double")
    got = {r["key"]: (round(r["score"], 6), round(r["top_share"], 6)) for r in ends.end_scores(more, "key").collect()}
    assert got == {"one": (1.0, 0.5), "two": (round(1 / 2.3, 6), round(4 / 9, 6)), "none": (0.0, 0.0)}
    assert {r["key"]: r["jitter_share"] for r in ends.jitter_share(more, "key").collect()}["none"] == 0
    assert {r["key"]: r["jitter_share"] for r in ends.jitter_share(profile, "key").collect()} == {"a": 1.0, "b": 1.0, "c": 0.5}


CONTIGS = [("f|m", "f", "m", "focus", 100, True), ("x|n", "x", "n", "exclude", 1000, False), ("h|m", "h", "m", "focus", 500, True)]


def classified(spark, hits, **rules):
    contigs = spark.createDataFrame(CONTIGS, "ref string, genome string, contig string, role string, length long, circular boolean")
    df = spark.createDataFrame([("r", *h) for h in hits], "read_id string, ref string, start long, end long, strand string, mismatches int")
    r = origin.OriginRules(**rules)
    found = origin.distinct_hits(df, contigs)
    got = origin.classify(found, r)
    one = got.first()
    return one["class"], one["genomes"], sorted((x["genome"], x["start"], x["weight"]) for x in origin.placements(found, got, r).collect())


F0, F1, X0, X1, H0 = ("f|m", 10, 31, "+", 0), ("f|m", 50, 71, "+", 0), ("x|n", 5, 26, "+", 0), ("x|n", 5, 26, "+", 1), ("h|m", 7, 28, "+", 0)


@pytest.mark.parametrize(
    ("hits", "rules", "want"),
    [
        ([F0], {}, ("assigned", ["f"], [("f", 10, 1.0)])),
        ([F0, F1], {}, ("assigned", ["f"], [("f", 10, 0.5), ("f", 50, 0.5)])),
        ([F0, F1], {"multimap": "unique"}, ("multimap_dropped", ["f"], [])),
        ([F0, X0], {}, ("ambiguous", ["f", "x"], [])),
        ([F0, X0], {"policy": "split"}, ("ambiguous", ["f", "x"], [("f", 10, 0.5)])),
        ([F0, X0], {"policy": "split", "mode": "severe"}, ("ambiguous", ["f", "x"], [])),
        ([F0, X1], {"mode": "evil", "evil_max_diff": 1}, ("evil_rejected", ["f", "x"], [])),
        ([F0, X1], {"mode": "evil", "evil_max_diff": 1, "max_mismatches": 0}, ("evil_rejected", ["f", "x"], [])),
        ([F0, X1], {"mode": "evil", "evil_max_diff": 0}, ("assigned", ["f"], [("f", 10, 1.0)])),
        ([X0, F0[:4] + (1,)], {}, ("excluded", ["x"], [])),
        ([F0[:4] + (2,)], {"max_mismatches": 1}, ("unmapped", [], [])),
        ([F0, F1, X0], {"max_hits": 2}, ("too_many_hits", [], [])),
        ([F0, H0], {}, ("ambiguous", ["f", "h"], [])),
        ([("f|m", 103, 124, "+", 0), ("f|m", 3, 24, "+", 0)], {}, ("assigned", ["f"], [("f", 3, 1.0)])),
    ],
)
def test_origin(spark, hits, rules, want):
    assert classified(spark, hits, **rules) == want


def test_rules_are_checked():
    for bad in ({"policy": "x"}, {"multimap": "x"}, {"mode": "x"}, {"evil_max_diff": -1}):
        with pytest.raises(ValueError):
            origin.OriginRules(**bad)


def test_poisson(spark):
    df = spark.createDataFrame([(12.0, 10.0), (40.0, 10.0), (0.0, 1.0), (3.0, 0.0), (2000.0, 900.0)], "k double, m double")
    got = [r[0] for r in df.select(sequences.poisson_significant(F.col("k"), F.col("m"), 0.001)).collect()]
    assert got == [False, True, False, True, True]
    assert df.limit(1).select(sequences.poisson_tail(F.col("k"), F.col("m"))).first()[0] == pytest.approx(0.30322, abs=1e-5)
    assert [peaks.stands_out(k, m, 0.001) for k, m in ((12, 10), (40, 10), (0, 1), (3, 0), (2000, 900))] == got


def test_peaks(spark):
    position = np.array([*range(0, 100)])
    reads = np.ones(100)
    reads[30], reads[46], reads[70], reads[74] = 200, 150, 300, 20
    owner, found = peaks.call_peaks(position, reads)
    assert sorted(p.position for p in found) == [30, 46, 70]  # 74 is a satellite of 70
    assert {int(owner[i]) for i in (70, 74)} == {next(k for k, p in enumerate(found) if p.position == 70)}
    owner, found = peaks.call_peaks(np.arange(100), np.ones(100))
    assert not found and (owner == -1).all()
    members = spark.createDataFrame([("g", "c", "+", 0, int(p), int(p) + 20, "s", 1.0, int(n)) for p, n in zip(position, reads)], K.replace("start", "block_start long, start") + ", sample string, weight double, n long")
    got = peaks.peak_claims(members, [*intervals.KEYS, "block_start"])
    assert {r["peak"] for r in got.collect()} == {30, 46, 70, None}
    # cut at wide gaps, the same peaks come out as from the whole block
    far = np.concatenate([position + 1000 * k for k in range(3)])
    owner, whole = peaks.call_peaks(far, np.tile(reads, 3))
    assert sorted(p.position for p in whole) == sorted(p + 1000 * k for k in range(3) for p in (30, 46, 70))
    members = spark.createDataFrame([("g", "c", "+", 0, int(p), int(p) + 20, "s", 1.0, int(n)) for p, n in zip(far, np.tile(reads, 3))], K.replace("start", "block_start long, start") + ", sample string, weight double, n long")
    got = {r["position"]: (r["peak"], round(r["isolation"], 9)) for r in peaks.peak_claims(members, [*intervals.KEYS, "block_start"]).collect()}
    assert got == {int(p): (whole[k].position, round(whole[k].isolation, 9)) if k >= 0 else (None, 1.0) for p, k in zip(far, owner)}


def test_align_matches_brute_force(spark):
    rng = random.Random(1)
    genome = "".join(rng.choice("ACGT") for _ in range(400))
    rc = str.maketrans("ACGT", "TGCA")
    reads = []
    for i in range(15):
        p = rng.randint(0, 378)
        s = list(genome[p : p + 20])
        for j in rng.sample(range(20), i % 4):
            s[j] = rng.choice("ACGT")
        s = "".join(s)
        reads.append((f"r{i}", s if i % 2 else s.translate(rc)[::-1]))
    for v in (0, 2):
        want = []
        for name, s in reads:
            for strand, q in (("+", s), ("-", s.translate(rc)[::-1])):
                for p in range(len(genome) - 19):
                    d = sum(a != b for a, b in zip(q, genome[p : p + 20]))
                    if d <= v:
                        want.append((name, "g", p, p + 20, strand, d))
        got = align.align(spark.createDataFrame(reads, "read_id string, sequence string"), spark.createDataFrame([("g", genome)], "ref string, sequence string"), v, best_only=False)
        assert rows(got, "read_id", "ref", "start", "end", "strand", "mismatches") == sorted(want)


def test_seed_classes(spark):
    guide = "TGAGGTAGTAGGTTGTATAGTT"
    rc = guide[1:8].translate(str.maketrans("ACGT", "TGCA"))[::-1]  # against 2 to 8
    six, off = rc[1:], guide[2:8].translate(str.maketrans("ACGT", "TGCA"))[::-1]
    cases = {"8mer": "GG" + rc + "ACC", "7mer-m8": "GG" + rc + "GCC", "7mer-A1": "GG" + ("C" if rc[0] != "C" else "G") + six + "ACC", "6mer": "GG" + ("C" if rc[0] != "C" else "G") + six + "GCC", "offset-6mer": "GG" + off + ("G" if rc[-1] != "G" else "C") + "GCC"}
    targets = spark.createDataFrame(list(cases.items()), "seq_id string, sequence string")
    got = seeds.sites(spark.createDataFrame([(1, guide), (2, guide[:7])], "guide_id long, guide string"), targets)
    assert rows(got, "seq_id", "site_class") == sorted((c, c) for c in cases)


def test_significance(spark):
    df = spark.createDataFrame([("k", False, x) for x in (1.0, 2.0, 3.0, 4.0)] + [("k", True, x) for x in (2.5, 3.5, 3.6, 9.0)], "key string, is_decoy boolean, s double")
    got = [r["q"] for r in significance.q_values(df, ["key"], "s", 2).orderBy("threshold").collect()]
    assert got == pytest.approx([0, 0, 1 / 6, 3 / 8])
    folds = spark.createDataFrame([("a", None, -5.0), ("a", 1, -6.0), ("a", 2, -4.0), ("b", None, 0.0)], "candidate string, shuffle int, mfe double")
    assert rows(significance.empirical_p(folds, ["candidate"]).na.fill(-1.0), "candidate", "p") == [("a", pytest.approx(2 / 3)), ("b", -1.0)]
    rng = random.Random(3)
    scores = [("c", d, rng.gauss(0, 1)) for d in range(1, 26)] + [("c", None, -3.0)]
    z = {r["decoy"]: r["z"] for r in significance.standardised(spark.createDataFrame(scores, "candidate string, decoy int, s double"), "s").collect()}
    real = np.array([s for _, d, s in scores if d])
    assert z[None] == pytest.approx((-3 - real.mean()) / real.std(), abs=1e-4)
    rest = np.delete(real, 4)
    assert z[5] == pytest.approx((real[4] - rest.mean()) / rest.std(), abs=1e-4)


def test_shuffles_keep_dinucleotides(spark):
    rng = random.Random(8)
    for i in range(40):
        s = "".join(rng.choice("ACGT") for _ in range(rng.randint(1, 40)))
        t = shuffles.shuffled(s, str(i))
        assert sorted(zip(s, s[1:])) == sorted(zip(t, t[1:])) and (s[0], s[-1]) == (t[0], t[-1]) and t == shuffles.shuffled(s, str(i))
    guides = spark.createDataFrame([(f"c{i}", "".join(rng.choice("ACGT") for _ in range(22))) for i in range(5)], "candidate string, guide string")
    got = shuffles.decoys(guides, 4).collect()
    assert len(got) == 20 and not {g["guide"][1:8] for g in got} & {r["guide"][1:8] for r in guides.collect()}
    assert {(g["guide_id"], g["guide"]) for g in shuffles.decoys(guides.repartition(4), 4).collect()} == {(g["guide_id"], g["guide"]) for g in got}


@pytest.mark.parametrize(
    ("structure", "at", "want"),
    [
        ("((((....))))", (0, 4), (1, 4, 1.0, True, "5p", 1.0)),
        ("((((....))))", (8, 12), (1, 4, 1.0, True, "3p", 1.0)),
        ("((((....))))", (2, 10), (1, 4, 1.0, True, "both", 0.5)),
        ("((.((...)).))", (0, 2), (1, 4, 1.0, True, "5p", 1.0)),
        ("(((...)))..((...))", (11, 13), (2, 3, 0.6, False, "NA", 1.0)),
        ("((..((...))..((((...)))).))", (14, 18), (2, 4, 0.5, False, "5p", 0.75)),
        ("......", (0, 3), (0, 0, 0.0, False, "NA", 0.0)),
    ],
)
def test_hairpins(structure, at, want):
    assert hairpins.describe(structure, *at) == want
    for bad in ("(", ")", "(x)"):
        with pytest.raises(ValueError):
            hairpins.partners(bad)


def test_fold_and_windows(spark):
    s, e = hairpins.stacking_fold(["GGGGAAAACCCC"])[0]
    assert s == "((((....))))" and e == -12.0
    contigs = spark.createDataFrame([("c", "ACGTACGTAAACCCGGGTTT", False)], "ref string, sequence string, circular boolean")
    cand = spark.createDataFrame([("x", "c", 8, 11, "+"), ("y", "c", 8, 11, "-")], "candidate string, ref string, start long, end long, strand string")
    got = {(r["candidate"], r["window"]): r for r in hairpins.windows(cand, contigs, 2, 6).collect()}
    assert got["x", "5p"]["sequence"] == "GTAAACCCGGG" and got["x", "3p"]["sequence"] == "GTACGTAAACC"
    for r in got.values():
        mine = r["sequence"][r["cand_from"] : r["cand_to"]]
        assert mine == ("AAA" if r["candidate"] == "x" else "TTT")


def test_outcomes(spark):
    cols = "genome string, contig string, strand string, start long, end long, length long, circular boolean"
    truth = spark.createDataFrame([(f"t{i}", "srna", e, "g", "c", "+", s, s + 20, 1000, True) for i, (s, e) in enumerate(((100, "pass"), (200, "merged"), (225, "merged"), (400, "missed"), (990, "any")))], "feature_id string, category string, expected string, " + cols)
    found = spark.createDataFrame([("l0", 9.0, "peak", True, "g", "c", "+", 101, 121, 1000, True), ("l1", 9.0, "peak", True, "g", "c", "+", 200, 250, 1000, True), ("l2", 9.0, "peak", False, "g", "c", "+", 991, 1009, 1000, True), ("l3", 9.0, "peak", True, "g", "c", "+", 600, 620, 1000, True)], "locus_id string, total double, kind string, pass boolean, " + cols)
    found = found.withColumn("rep_start", F.col("start")).withColumn("rep_end", F.col("end"))
    got = {r["feature_id"]: (r["outcome"], r["as_expected"]) for r in evaluation.outcomes(truth, found).collect()}
    assert got == {"t0": ("pass", True), "t1": ("merged", True), "t2": ("merged", True), "t3": ("missed", True), "t4": ("fail", True)}
    assert rows(evaluation.false_positives(truth, found), "locus_id") == [("l3",)]


def test_annotation(spark):
    cols = "locus_id string, genome string, contig string, strand string, start long, end long, length long, circular boolean"
    found = spark.createDataFrame([("a", "g", "c", "+", 10, 30, 100, False), ("b", "g", "c", "-", 40, 60, 100, False), ("c", "g", "c", "+", 70, 90, 100, False), ("w", "h", "m", "+", 95, 115, 100, True)], cols)
    features = spark.createDataFrame([("g", "c", "+", 0, 100, "gene", "x"), ("g", "c", "-", 20, 35, "tRNA", "t"), ("g", "c", "+", 41, 50, "rRNA", "."), ("g", "c", "?", 42, 43, "rRNA", "r"), ("h", "m", "?", 5, 9, "odd", "."), ("h", "m", ".", 96, 99, "zed", "z")], "genome string, contig string, strand string, start long, end long, type string, name string")
    want = [("a", "gene,tRNA", "t,x", "tRNA", "antisense"), ("b", "gene,rRNA", ".,r,x", "rRNA", "antisense"), ("c", "gene", "x", "gene", "sense"), ("w", "odd,zed", ".,z", "odd", "unstranded")]
    names = ("locus_id", "feature_types", "feature_names", "class", "orientation")
    assert rows(loci.annotate(found, features), *names) == want
    assert rows(loci.annotate(found, features.limit(0)), *names)[0] == ("a", "", "", "intergenic", "")
    assert rows(loci.annotate(found, None), *names)[0] == ("a", "NA", "NA", "NA", "NA")


def test_sites_at_ends_and_other_seeds(spark):
    guide = "UGAGGUAGUAGGUUGUAUAGUU"
    rc = lambda a, b: guide[a - 1 : b].translate(str.maketrans("ACGU", "TGCA"))[::-1]
    g = spark.createDataFrame([("g", guide.lower()), ("short", "ACGUACG")], "guide_id string, guide string")
    targets = {"8mer": rc(2, 8) + "A", "7mer-m8": "AA" + rc(2, 8), "7mer-A1": "AA" + rc(2, 7) + "A", "6mer": "AA" + rc(2, 7), "offset-6mer": rc(3, 8), "far": "C" * 1995 + rc(2, 8) + "A" + "C" * 40, "none": "CCCC"}
    t = spark.createDataFrame(list(targets.items()), "seq_id string, sequence string")
    got = {r["seq_id"]: (r["start"], r["end"], r["t1"], r["site_class"]) for r in seeds.sites(g, t).collect()}
    assert got == {"8mer": (0, 8, 7, "8mer"), "7mer-m8": (2, 9, 9, "7mer-m8"), "7mer-A1": (2, 9, 8, "7mer-A1"), "6mer": (2, 8, 8, "6mer"), "offset-6mer": (0, 6, 7, "offset-6mer"), "far": (1995, 2003, 2002, "8mer")}
    assert {r["seq_id"] for r in seeds.sites(g, t, ("8mer",)).collect()} == {"8mer", "far"}
    other = spark.createDataFrame([("x", "AA" + rc(4, 12) + rc(4, 12))], "seq_id string, sequence string")
    assert rows(seeds.sites(g, other, seed=(4, 12)), "start", "end", "t1", "site_class") == [(2, 11, 13, "seed4-12"), (11, 20, 22, "seed4-12")]


def test_locus_rules(spark):
    with pytest.raises(ValueError):
        loci.LocusRules(five_filter="x")
    d = spark.range(1).select(circular.signed_distance(F.lit(95), F.lit(3), F.lit(100), F.lit(True)), circular.signed_distance(F.lit(3), F.lit(95), F.lit(100), F.lit(False))).first()
    assert tuple(d) == (8, 92)


GFF = """##gff-version 3
c\tx\tgene\t1\t60\t.\t+\t.\tID=g1;Name=my%20gene;
c\tx\tmRNA\t1\t60\t.\t+\t.\tID=m1;Parent=g1
c\tx\texon\t1\t20\t.\t+\t.\tParent=m1
c\tx\texon\t31\t60\t.\t+\t.\tParent=m1
c\tx\tCDS\t11\t20\t.\t+\t.\tParent=m1
c\tx\tCDS\t31\t40\t.\t+\t.\tParent=m1
##FASTA
c\tx\tgene\t1\t60\t.\t+\t.\tID=no
"""


def test_files(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">one first\nACG\nT\n\n>two\nGG\n")
    assert rows(seq_files.read_fasta(spark, str(tmp_path / "a.fa")), "name", "sequence") == [("one", "ACGT"), ("two", "GG")]
    (tmp_path / "a.fq").write_text("@r1 x\nACGT\n+\n+III\n@r2\nGGGG\n+r2\n@III\n")
    assert rows(seq_files.read_fastq(spark, {"s": [str(tmp_path / "a.fq")]}), "sample", "sequence") == [("s", "ACGT"), ("s", "GGGG")]
    sam = spark.createDataFrame([("@HD",), ("r\t16\tc\t11\t9\t5M1I2D3M\t*\t0\t0\tA\tI\tNM:i:2",), ("r\t0\tc\t1\t9\t4M\t*\t0\t0\tA\tI",), ("u\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI",)], "value string")
    assert rows(tables.parse_sam(sam), "start", "end", "strand", "mismatches") == [(0, 4, "+", 0), (10, 20, "-", 2)]
    (tmp_path / "t.tsv").write_text("a\tb\n1\t\n")
    assert rows(tables.read_tsv(spark, str(tmp_path / "t.tsv")), "a", "b") == [("1", "")]


def test_regions(spark, tmp_path):
    (tmp_path / "x.gff").write_text(GFF)
    records = tables.parse_gff(tables.numbered_lines(spark, str(tmp_path / "x.gff")))
    genome = "".join("ACGT"[i % 4] for i in range(60))
    contigs = spark.createDataFrame([("c", genome)], "contig string, sequence string")
    assert rows(regions.regions(regions.transcripts(records), contigs), "region") == [("three_prime_UTR",)]
    got = regions.regions(regions.transcripts(records), contigs, ("five_prime_UTR", "CDS", "three_prime_UTR"))
    parts = {r["region"]: (r["sequence"], r["gene"]) for r in got.collect()}
    assert parts == {"five_prime_UTR": (genome[:10], "my gene"), "CDS": (genome[10:20] + genome[30:40], "my gene"), "three_prime_UTR": (genome[40:60], "my gene")}
    assert rows(tables.features(records, "g"), "type", "name")[-1] == ("mRNA", "m1")


def test_stream(spark, tmp_path):
    from locusmill.streaming import collapse as stream

    schema = "sample string, sequence string"
    for i in range(2):
        spark.createDataFrame([("s", "A" * 20)] * (i + 1), schema).write.mode("append").parquet(str(tmp_path / "in"))
        q = stream.collapse_available(stream.read_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema), str(tmp_path / "out"), str(tmp_path / "cp"), 18, 28)
        q.awaitTermination()
    assert rows(stream.latest_counts(spark, str(tmp_path / "out")), "sample", "n") == [("s", 3)]


def test_math_of_tail():
    assert math.isclose(sum(math.exp(-10) * 10**i / math.factorial(i) for i in range(12)), 1 - 0.30322, abs_tol=1e-5)
