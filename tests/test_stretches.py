"""Intervals cut from pieces of contigs, regions and windows made of them, drawn windows, the table of k-mers, annotation read in parts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from locusmill.functions.sequences import reverse_complement
from locusmill.operators import align, calibration, hairpins, regions, stretches
from locusmill.sources import tables


def genome(rng, n, letters="ACGT"):
    return "".join(rng.choice(letters) for _ in range(n))


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_cut_over_pieces(spark):
    rng = random.Random(1)
    contigs = {"a": genome(rng, 103), "b": genome(rng, 40), "c": ""}
    held = stretches.pieces(spark.createDataFrame(list(contigs.items()), "ref string, sequence string"), size=10)
    spans, want = [], {}
    for k in range(60):
        ref = rng.choice("ab")
        parts = []
        for p in range(rng.randint(1, 3)):
            s = rng.randint(0, len(contigs[ref]) - 1)
            e = rng.randint(s, len(contigs[ref]) + 5)
            spans.append((k, p, ref, s, e))
            parts.append(contigs[ref][s:e])
        if "".join(parts):
            want[k] = "".join(parts)
    df = spark.createDataFrame(spans, "row int, part int, ref string, start long, end long")
    assert {r["row"]: r["sequence"] for r in stretches.cut(df, held, ["row"], size=10).collect()} == want
    assert stretches.cut(df.filter("ref = 'c'"), held, ["row"], size=10).count() == 0


def planted_transcripts(rng, contigs, n):
    out = []
    for k in range(n):
        contig = rng.choice(list(contigs))
        cuts = sorted(rng.sample(range(len(contigs[contig])), 2 * rng.randint(1, 5)))
        exons = list(zip(cuts[::2], cuts[1::2]))
        inside = [(s, e) for s, e in exons if rng.random() < 0.7]
        if inside and rng.random() < 0.8:
            inside[0] = (rng.randint(inside[0][0], inside[0][1] - 1), inside[0][1])
        else:
            inside = []
        out.append((f"t{k}", "g", contig, rng.choice("+-"), exons, inside))
    return out


def test_regions_blocks_and_way_back(spark, monkeypatch):
    monkeypatch.setattr(stretches, "PIECE", 50)
    rng = random.Random(4)
    contigs = {"x": genome(rng, 300), "y": genome(rng, 777)}
    found = planted_transcripts(rng, contigs, 40)
    df = spark.createDataFrame(found, f"transcript string, gene string, contig string, strand string, exons {regions.BLOCKS}, cds {regions.BLOCKS}")
    names = ("five_prime_UTR", "CDS", "three_prime_UTR")
    got = regions.regions(df, spark.createDataFrame(list(contigs.items()), "contig string, sequence string"), names, whole_if_missing=True)
    spots = got.select("*", F.explode(F.sequence(F.lit(0), F.char_length("sequence"))).alias("i"))
    spots = spots.withColumn("at", regions.to_genome(F.col("i"), F.col("blocks"), F.col("strand"))).join(df.select("transcript", "exons"), "transcript")
    spots = spots.withColumn("back", regions.to_transcript(F.col("at"), F.col("exons"), F.col("strand")))
    at = {(r["region_id"], r["i"]): (r["at"], r["back"]) for r in spots.collect()}
    want, seen = {}, {r["region_id"]: r for r in got.collect()}
    for t, _, contig, strand, exons, cds in found:
        line = [p for s, e in exons for p in range(s, e)]
        line = line if strand == "+" else line[::-1]
        spans = {"transcript": (0, len(line))}
        if cds:
            ends = [line.index(cds[0][0]), line.index(cds[-1][1] - 1)]
            spans = {"five_prime_UTR": (0, min(ends)), "CDS": (min(ends), max(ends) + 1), "three_prime_UTR": (max(ends) + 1, len(line))}
        for name, (a, z) in spans.items():
            if z > a:
                bases = "".join(contigs[contig][p] for p in line[a:z])
                want[f"{t}|{name}"] = bases if strand == "+" else bases.translate(str.maketrans("ACGT", "TGCA"))
                assert [at[f"{t}|{name}", i] for i in range(z - a)] == [(p, a + i) for i, p in enumerate(line[a:z])]
                assert at[f"{t}|{name}", z - a][0] is None
                b = [(x["s"], x["e"]) for x in seen[f"{t}|{name}"]["blocks"]]
                assert [p for s, e in b for p in (range(s, e) if strand == "+" else range(e - 1, s - 1, -1))] == line[a:z]
    assert {k: r["sequence"] for k, r in seen.items()} == want


def test_site_over_a_junction_and_errors(spark):
    df = spark.createDataFrame([("t", "g", "c", "-", [(2, 6), (10, 14)], [(2, 6), (10, 14)])], f"transcript string, gene string, contig string, strand string, exons {regions.BLOCKS}, cds {regions.BLOCKS}")
    contigs = spark.createDataFrame([("c", "AACCGGTTAACCGGTT")], "contig string, sequence string")
    got = regions.regions(df, contigs, ("CDS",))
    place = regions.genomic(F.col("contig"), F.col("strand"), F.col("blocks"), F.lit(3), F.lit(6))
    assert [tuple(r) for r in got.select("sequence", place).collect()] == [(rc("CCGG" + "CCGG"), "c:5-11(-)")]
    assert got.select(regions.genomic(F.col("contig"), F.col("strand"), F.col("blocks"), F.lit(7), F.lit(9)).alias("x")).first()["x"] == ""
    wrong = df.withColumn("cds", F.expr("array(named_struct('s', 2L, 'e', 6L), named_struct('s', 10L, 'e', 20L))"))
    with pytest.raises(Exception, match="outside of its exons"):
        regions.regions(wrong, contigs, ("CDS",)).collect()


def test_precursor_windows_of_pieces(spark, monkeypatch):
    monkeypatch.setattr(stretches, "PIECE", 16)
    rng = random.Random(9)
    seq = {"lin": genome(rng, 70, "ACGTn"), "circ": genome(rng, 50)}
    contigs = spark.createDataFrame([(k, s, k == "circ") for k, s in seq.items()], "ref string, sequence string, circular boolean")
    cand = [(f"{ref}{a}{strand}", ref, a, a + 8, strand) for ref in seq for a in (0, 3, 20, len(seq[ref]) - 8) for strand in "+-"]
    got = hairpins.windows(spark.createDataFrame(cand, "candidate string, ref string, start long, end long, strand string"), contigs, 5, 13).collect()
    assert len(got) == 2 * len(cand)
    for r in got:
        s = seq[r["ref"]]
        whole = (s + s)[r["win_start"] : r["win_end"]]
        assert r["sequence"] == (whole if r["strand"] == "+" else whole[::-1].translate(str.maketrans("ACGTacgt", "TGCAtgca")))
        own = next(x for x in cand if x[0] == r["candidate"])
        bases = s[own[2] : own[3]]
        assert r["sequence"][r["cand_from"] : r["cand_to"]] == (bases if own[4] == "+" else rc(bases) if "n" not in bases else r["sequence"][r["cand_from"] : r["cand_to"]])


def test_drawn_windows(spark):
    rng = random.Random(2)
    seqs = [(f"s{k}", genome(rng, n)) for k, n in enumerate([19, 20, 45, 60, 100, 250, 400, 700, 1000, 5000])]
    df = spark.createDataFrame(seqs, "seq_id string, sequence string")
    n, length = 6000, 50
    got = calibration.calibration_windows(df.repartition(3), length, n, seed=5).collect()
    by = dict(seqs)
    assert sorted(r["draw"] for r in got) == list(range(n))
    assert all(r["window"] == by[r["seq_id"]][r["start"] : r["start"] + length] and len(r["window"]) == min(length, len(by[r["seq_id"]])) for r in got)
    counts = Counter(r["seq_id"] for r in got)
    total = sum(len(s) for k, s in seqs[1:])
    assert "s0" not in counts
    chi = sum((counts[k] - n * len(s) / total) ** 2 / (n * len(s) / total) for k, s in seqs[1:])
    assert chi < 26.1  # 8 degrees of freedom, 1 in 1,000
    starts = Counter(r["start"] * 10 // (5000 - length + 1) for r in got if r["seq_id"] == "s9")
    each = sum(starts.values()) / 10
    assert sum((starts[k] - each) ** 2 / each for k in range(10)) < 27.9  # 9 degrees
    again = calibration.calibration_windows(df, length, n, seed=5).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    assert sorted(map(tuple, calibration.calibration_windows(df, length, n, seed=6).collect())) != sorted(map(tuple, got))
    assert calibration.calibration_windows(df.filter("seq_id = 's0'"), length, n).count() == 0
    with pytest.raises(ValueError):
        calibration.calibration_windows(df, 0, 5)


def brute(reads, contigs, v):
    out = []
    for i, q in reads:
        for strand, s in (("+", q), ("-", rc(q))):
            for ref, g in contigs:
                for a in range(len(g) - len(s) + 1):
                    off = sum(x != y or x not in "ACGT" for x, y in zip(s, g[a : a + len(s)]))
                    if off <= v:
                        out.append((i, ref, a, a + len(s), strand, off))
    return sorted(out)


@pytest.mark.parametrize("v", [0, 1, 2, 3])
def test_align_over_pieces_letters_and_long_reads(spark, monkeypatch, v):
    monkeypatch.setattr(align, "PIECE", 37)
    rng = random.Random(v)
    g = genome(rng, 300) + "NNRY" + genome(rng, 90) + "N"
    reads = []
    for k in range(40):
        n = rng.choice([4, 9, 18, 23, 31, 45, 70])
        a = rng.randint(0, len(g) - n)
        s = list(g[a : a + n].replace("N", "A").replace("R", "G").replace("Y", "C"))
        for _ in range(rng.randint(0, v)):
            s[rng.randrange(n)] = rng.choice("ACGT")
        s = "".join(s)
        reads.append((f"r{k}", s if rng.random() < 0.5 else rc(s)))
    contigs = [("g", g), ("tiny", "ACG"), ("same", g[:80])]
    r, c = spark.createDataFrame(reads, "read_id string, sequence string"), spark.createDataFrame(contigs, "ref string, sequence string")
    assert sorted(map(tuple, align.align(r, c, v, best_only=False).collect())) == brute(reads, contigs, v)


def test_stored_index_modes_and_limits(spark, tmp_path):
    rng = random.Random(8)
    g = genome(rng, 2500)
    far = list(g[100:120])
    far[3] = "A" if far[3] != "A" else "C"
    g += "".join(far) + genome(rng, 40) + g[700:722] * 3
    reads = [("one", g[100:120]), ("many", g[700:722]), ("none", genome(rng, 20))]
    r, c = spark.createDataFrame(reads, "read_id string, sequence string"), spark.createDataFrame([("g", g)], "ref string, sequence string")
    stored = align.write_index(align.kmer_index(c, align.kmer_sizes(18, 30, 2), 30), str(tmp_path / "index"))
    assert sorted(map(tuple, align.align(r, None, 1, False, stored).collect())) == brute(reads, [("g", g)], 1)
    for wrong in (align.KmerIndex(stored.table, stored.ks, 12), align.KmerIndex(stored.table, (11, 13), 30)):
        with pytest.raises(ValueError):
            align.align(r, None, 1, False, wrong)
    hits, many = align.reported(r, c, 0, max_hits=3)
    assert [x["read_id"] for x in many.collect()] == ["many"] and {x["read_id"] for x in hits.collect()} == {"one"}
    hits, many = align.reported(r, c, 1, max_hits=3)
    assert {(x["read_id"], x["mismatches"]) for x in hits.collect()} == {("one", 0)}
    hits, many = align.reported(r, c, 1, max_hits=3, mode="evil", evil_max_diff=1)
    assert {(x["read_id"], x["mismatches"]) for x in hits.collect()} >= {("one", 0), ("one", 1), ("many", 0)} and many.count() == 0
    with pytest.raises(ValueError):
        align.reported(r, c, 0, 3, "evil", 1)
    assert align.align(r.limit(0), c, 1).count() == 0


def test_annotation_in_parts(spark, tmp_path):
    line = "c\tx\tgene\t{a}\t{b}\t.\t+\t.\tID=g{k};Name=n{k}\r\n"
    first = "##gff-version 3\r\n" + "".join(line.format(a=k + 1, b=k + 9, k=k) for k in range(3000)) + "##FASTA\r\n>c\r\nACGT\r\n" + line.format(a=1, b=2, k="after")
    (tmp_path / "a.gff").write_text(first)
    (tmp_path / "b.gff").write_text("##FASTA\n" + line.format(a=1, b=2, k="b"))
    (tmp_path / "c.gff").write_text("# comment\n" + line.format(a=5, b=7, k="c"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = tables.numbered_lines(spark, [str(tmp_path / f"{x}.gff") for x in "abc"])
        assert lines.select("line.part").distinct().count() > 3
        got = tables.parse_gff(lines)
        assert sorted(r["attributes"].split(";")[0] for r in got.collect()) == sorted([f"ID=g{k}" for k in range(3000)] + ["ID=gc"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_reverse_complement_of_regions_is_that_of_sequences(spark):
    assert spark.range(1).select(reverse_complement(F.lit("AACGTN"))).first()[0] == "NACGTT"
