"""Evaluation against planted small RNAs, sites and hairpins."""

import random

import pytest

from locusmill.operators import planted


def owner_by_force(read, features):
    best = None
    for k, (name, seq) in enumerate(features):
        for shift in range(-len(read) + 1, len(seq)):
            both = [(read[x], seq[x + shift]) for x in range(len(read)) if 0 <= x + shift < len(seq)]
            shared = any(all(a == b for a, b in both[i : i + 8]) for i in range(len(both) - 7))
            apart = sum(a != b for a, b in both)
            if shared and len(both) >= 15 and apart <= 2:
                best = min(best or (99, 0, ""), (apart - len(both), k, name))
    return best and best[2]


def test_owners_against_brute_force(spark):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    features = [(f"f{i}", word(22)) for i in range(6)]
    features.append(("twin", features[0][1]))  # a tie: the first one owns
    features.append(("repeat", "AC" * 11))
    reads = ["", "ACGT", "AC" * 10, word(22)]
    for _, s in features:
        for _ in range(12):
            r = list(word(rng.randrange(4)) + s[rng.randrange(6) : len(s) - rng.randrange(6)] + word(rng.randrange(4)))
            for _ in range(rng.randrange(4)):
                r[rng.randrange(len(r))] = rng.choice("ACGT")
            reads.append("".join(r))
    got = planted.owners(
        spark.createDataFrame([(f"r{i}", r) for i, r in enumerate(reads)] + [("null", None)], "read_id string, sequence string"),
        spark.createDataFrame([(n, k, s) for k, (n, s) in enumerate(features)] + [("none", 99, None)], "feature_id string, position int, sequence string"),
    )
    want = {f"r{i}": o for i, r in enumerate(reads) if (o := owner_by_force(r, features))}
    assert {r.read_id: r.feature_id for r in got.collect()} == want
    assert len(want) > 40 and len(want) < len(reads)


def test_reads_by_origin(spark):
    owned = spark.createDataFrame([("r1", "f"), ("r2", "f"), ("r3", "f")], "read_id string, feature_id string")
    origin = spark.createDataFrame([("r1", "assigned"), ("r2", "new_class")], "read_id string, class string")
    counts = spark.createDataFrame([("r1", 5), ("r1", 6), ("r2", 2), ("r3", 1)], "read_id string, n long")
    features = spark.createDataFrame([("f",), ("empty",)], "feature_id string")
    got = {r.feature_id: r for r in planted.reads_by_origin(owned, origin, counts, features).collect()}
    assert (got["f"].assigned, got["f"].other, got["f"].unmapped, got["f"].matched_reads) == (11, 2, 1, 14)
    assert got["empty"].matched_reads == 0


def sites(spark):
    rows = [(1, "c1", "t1", "chr:10-16(+)", "6mer", 2), (2, "c1", "t1", "chr:16-23(+)", "8mer", 1), (3, "c1", "t2", "chr:10-16(+)", "8mer", 1), (4, "c2", "t1", "", "8mer", 2), (5, "c1", "t1", "chr:90-97(-)", "8mer", None)]
    return spark.createDataFrame(rows, "call_id int, candidate string, transcript string, genomic string, site_class string, support int")


def truth(spark):
    rows = [(1, "c1", "t1", 12, 18, "7mer-m8", "extensive"), (2, "c1", "t2", 17, 20, "6mer", None), (3, "c2", "t1", 1, 9, "8mer", "seed"), (4, None, "t1", 10, 16, "6mer", "seed"), (5, "c1", "t2", 16, 20, "8mer", "seed")]
    return spark.createDataFrame(rows, "site_id int, candidate string, transcript string, genomic_start long, genomic_end long, site_class string, pairing string")


def test_planted_sites(spark):
    got = {r.site_id: (r.found_class, r.found, r.support) for r in planted.planted_sites(truth(spark), sites(spark), ("support",)).collect()}
    assert got == {1: ("8mer", True, 1), 2: (None, False, None), 3: (None, False, None), 4: (None, False, None), 5: ("8mer", True, 1)}
    weaker = truth(spark).filter("site_id = 1").replace("7mer-m8", "8mer")
    only = sites(spark).filter("call_id = 1")
    assert [(r.found_class, r.found) for r in planted.planted_sites(weaker, only).collect()] == [("6mer", False)]


def test_support_and_false_calls(spark):
    judged = planted.planted_sites(truth(spark), sites(spark), ("support",))
    assert {(r.pairing, r.sites, r.support_1, r.support_2) for r in planted.support_by_pairing(judged).collect()} == {("extensive", 1, 1, 0), ("seed", 4, 1, 0)}
    got = [(r.level, r.calls, r.not_planted, r.share) for r in planted.false_calls(truth(spark), sites(spark)).sort("level").collect()]
    assert got == [(1, 4, 1, 0.25), (2, 2, 1, 0.5)]
    assert [r.share for r in planted.false_calls(truth(spark), sites(spark).limit(0)).collect()] == [None, None]


def test_candidates_and_hairpins(spark):
    features = spark.createDataFrame([("f1", "ACGT"), ("f2", "GG"), ("f3", None)], "feature_id string, rep_sequence string")
    c = planted.candidates_of(features, spark.createDataFrame([("c1", "ACGT")], "candidate string, sequence string"))
    assert {(r.feature_id, r.candidate) for r in c.collect()} == {("f1", "c1"), ("f2", None), ("f3", None)}
    windows = spark.createDataFrame(
        [("c1", "w1", 0.01, 0.9, True, "5p", True), ("c1", "w2", 0.001, 0.9, True, "3p", False), ("c2", "w1", 0.01, 0.9, True, "3p", True), ("c3", "w1", None, None, True, "5p", True), ("c4", "w1", 0.05, 0.5, False, "5p", True), ("c5", "w1", 0.5, 0.5, True, "5p", True)],
        "candidate string, window string, pvalue double, mfei double, single_hairpin boolean, arm string, best boolean",
    )
    hairpins = spark.createDataFrame([("f1", "c1", "5p"), ("f2", "c2", "5p"), ("f3", "c3", "5p"), ("f4", None, "5p")], "feature_id string, candidate string, arm string")
    got = {r.feature_id: r.found for r in planted.planted_hairpins(hairpins, windows).collect()}
    assert got == {"f1": True, "f2": False, "f3": False, "f4": False}
    assert tuple(planted.background_hairpins(hairpins, windows).first()) == (2, 1)
