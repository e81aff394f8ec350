"""What large tables ask for: no shuffle, broadcast or row that grows with pairs of rows, and the same results."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from locusmill.operators import regions, scoring, seeds, shuffles, significance
from locusmill.plans.handed import QUERIES

DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def joins(df):
    return [line for line in plan(df).splitlines() if "Join" in line]


@pytest.fixture(scope="module")
def pairs(spark):
    rng = random.Random(3)
    text = lambda n, letters="ACGT": "".join(rng.choice(letters) for _ in range(n))
    targets = [("a", text(2400)), ("b", text(1500, "ACGTN")), ("short", text(9)), ("c", text(1003)), ("d", text(1000, "AC"))]
    # guides whose seeds are at both ends and over the edges of pieces
    back = lambda s: s[::-1].translate(str.maketrans("ACGTN", "TGCAN"))
    guides = [text(1) + back(s[p : p + 7]) + text(rng.choice([0, 6, 7, 8, 14])) for _, s in targets for p in (0, 1, 2, len(s) - 7, len(s) - 8, len(s) // 2, max(0, 995 - len(s) % 7)) if len(s[p : p + 7]) == 7]
    whole = [text(1) + back(targets[0][1][p - 8 : p + 7]) for p in (20, 700, 1003)]  # paired up to base 16
    guides += [*whole, *(g[:15] + g[15].translate(str.maketrans("ACGT", "CGTA")) for g in whole)]
    guides += [g[0] + g[1:8].replace("T", "U").lower() + g[8:] for g in guides[:4]] + ["ACGTACG", guides[0], "A" * 12 + "NNNN" + "C" * 6]
    return (
        spark.createDataFrame([(i, i // 3, i % 3 or None, g) for i, g in enumerate(guides)], "guide_id long, candidate long, decoy long, guide string"),
        spark.createDataFrame(targets, "seq_id string, sequence string"),
    )


def rows(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("name", ["fn9_pairing_windows", "fn7_supplementary", "fn6_site_context"])
def test_sites_are_not_joined_again(spark, name):
    assert len(joins(QUERIES[name](spark, DIR))) == 1


def test_context_told_by_windows_is_that_of_cut_stretches(spark, pairs):
    guides, targets = pairs
    regions = targets.withColumn("region", F.lit("CDS")).withColumn("region_id", F.col("seq_id"))
    want = seeds.with_context(seeds.sites(guides, targets).join(guides.select("guide_id", "guide"), "guide_id"), regions)
    columns = ["guide_id", "seq_id", "start", "end", "t1", "site_class", "au_flanks", "supp_pairing"]
    want = rows(want, *columns, "dist_3p")
    assert len(want) > 30 and {r[7] for r in want} == {0, 1, 2, 3, 4} and {r[5] for r in want} == set(seeds.CLASSES)
    got = seeds.sites_in_context(guides, targets, pairing=True)
    assert rows(got, *columns, F.col("n") - F.col("end")) == want


@pytest.mark.parametrize("by", [(), ("seq_id",)])
def test_counts_without_sites_are_those_of_sites(spark, pairs, by):
    guides, targets = pairs
    want = seeds.sites(guides, targets).join(guides.drop("guide"), "guide_id").groupBy("guide_id", "candidate", "decoy", *by, "site_class").agg(F.count("*").alias("n"))
    columns = ["guide_id", "candidate", "decoy", *by, "site_class", "n"]
    got = seeds.site_counts(guides, targets, by=by)
    assert rows(got, *columns) == rows(want, *columns)
    assert rows(seeds.class_counts(got, guides), "candidate", "decoy", "site_class", "n") == rows(seeds.class_counts(seeds.sites(guides, targets), guides), "candidate", "decoy", "site_class", "n")


def broadcasts(df, column):
    return [line for line in joins(df) if "BroadcastHashJoin" in line and column in line]


@pytest.mark.parametrize("name", ["jn1_align", "jn1_reported"])
def test_index_of_contigs_is_not_broadcast(spark, name):
    assert not broadcasts(QUERIES[name](spark, DIR), "kmer")


def test_a_pattern_in_a_long_sequence(spark):
    """Positions in a long sequence take time in proportion, and are those of text search over the edges of pieces."""
    text = "ACGT" * 100_000 + "ACACAG" * 100_000
    got = seeds.windows(spark.createDataFrame([("x", text)], "seq_id string, sequence string"), 3).filter("w = 'ACA'")
    want = [i for i in range(len(text)) if text.startswith("ACA", i)]
    assert sorted(r["at"] for r in got.collect()) == want
    assert "occurrences" not in plan(QUERIES["wn14_occurrences"](spark, DIR)) and "explode(filter" not in plan(QUERIES["wn14_occurrences"](spark, DIR))


def test_regions_come_from_pieces(spark):
    rng = random.Random(4)
    text = {n: "".join(rng.choice("acguACGT") for _ in range(k)) for n, k in (("t1", 3500), ("t2", 900), ("t3", 5))}
    spans = [("t1", "a", 1, 3500, "g"), ("t1", "a", 1, 3500, "g"), ("t1", "b", 990, 1010, ""), ("t1", "b", 1000, 1000, None), ("t2", "a", 1001 - 200, 900, ""), ("t1", "c", 1000, 2001, "h")]
    table = spark.createDataFrame(spans, "transcript string, region string, start int, end int, gene string")
    names = spark.createDataFrame(list(text.items()), "name string, sequence string")
    found = regions.transcript_regions(names, table, whole_if_missing=True)
    up = lambda t: t.upper().replace("U", "T")
    want = Counter((f"{t}|{r}", t, g or t, r, up(text[t])[s - 1 : e]) for t, r, s, e, g in spans)
    want["t3|transcript", "t3", "t3", "transcript", up(text["t3"])] += 1
    assert rows(found, "region_id", "transcript", "gene", "region", "sequence") == want
    # no join carries a line besides: the sequence's pieces meet the spans
    assert any("piece" in line for line in joins(QUERIES["cp2_transcript_regions"](spark, DIR)))


def test_decoys_where_every_seed_is_real(spark, monkeypatch):
    guides = spark.createDataFrame([(f"c{i}", g) for i, g in enumerate(["ACACACACACACACAC", "CACACACACACACACA", "AAAAAAAAAAAA", "ACGTTGCAAC", "GATTACAGATTACAGG"])], "candidate string, guide string")
    names = ("guide_id", "candidate", "decoy", "guide")
    fast = rows(shuffles.decoys(guides, 4), *names)
    real = {g[1:8] for g in ("ACACACACACACACAC", "CACACACACACACACA", "AAAAAAAAAAAA", "ACGTTGCAAC", "GATTACAGATTACAGG")}
    assert [shuffles._all_real(g, real, 2, 8) for g in ("ACACACACACACACAC", "AAAAAAAAAAAA", "GATTACAGATTACAGG", "ACGT")] == [True, True, False, False]
    monkeypatch.setattr(shuffles, "_all_real", lambda *_: False)
    for (i, c, k, s), n in fast.items():
        g = {f"c{j}": x for j, x in enumerate(["ACACACACACACACAC", "CACACACACACACACA", "AAAAAAAAAAAA", "ACGTTGCAAC", "GATTACAGATTACAGG"])}[c]
        drawn = [shuffles.shuffled(g, f"1:{c}:{k}:{t}") for t in range(101)]
        assert n == 1 and s == next((x for x in drawn if x[1:8] not in real), drawn[-1])


def test_equal_scores_are_counted_and_weak_sites_not_looked_up(spark):
    rng = random.Random(6)
    scored = spark.createDataFrame([(rng.randrange(3), rng.choice([None, 1, 2, 3]), rng.choice(["8mer", "7mer-m8"]), rng.randrange(9)) for _ in range(600)], "candidate long, decoy long, site_class string, score long")
    scored = scored.withColumn("is_decoy", F.col("decoy").isNotNull())
    told = scored.groupBy(*scored.columns).agg(F.count("*").alias("times"))
    assert rows(significance.q_values(told, ["candidate", "site_class"], "score", 3, 1, times="times"), "*") == rows(significance.q_values(scored, ["candidate", "site_class"], "score", 3, 1), "*")
    keys = ("candidate", "decoy", "site_class", "score", F.round("z", 6))
    assert set(rows(significance.standardised(told, "score", "times"), *keys)) == set(rows(significance.standardised(scored, "score"), *keys))
    sites = spark.createDataFrame([(0, "t", i, c) for i in range(40) for c in seeds.CLASSES], "candidate long, seq_id string, start int, site_class string")
    real = sites.filter("site_class IN ('8mer', '7mer-m8') AND start % 3 > 0").withColumn("decoy", F.lit(None).cast("long")).withColumn("paired", F.col("start") * 0.5)
    assert rows(scoring.attached(sites, real, scoring.WEAK), "*") == rows(scoring.attached(sites, real), "*")
