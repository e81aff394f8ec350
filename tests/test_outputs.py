"""Sinks, settings, region tables and the choice of loci to fold."""

from glob import glob
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from locusmill.functions import sequences as seq
from locusmill.operators import collapse, precursors, regions
from locusmill.sources import outputs, settings
from locusmill.sources.tables import read_tsv


def text_of(folder):
    return "".join(Path(p).read_text() for p in sorted(glob(f"{folder}/part-*")))


def test_weights_and_numbers(spark):
    given = {1.0: "1", 0.5: "0.5", 1 / 3: "0.333333", 1 / 24: "0.0416667", 1 / 7000: "0.000142857", 0.00002: "2e-05", 1 / 30000: "3.33333e-05", 0.1: "0.1"}
    rows = spark.createDataFrame([(w,) for w in given], "w double").select("w", outputs.weight_text(F.col("w")).alias("t")).collect()
    assert {r.w: r.t for r in rows} == given == {w: f"{w:.6g}" for w in given}
    rows = spark.createDataFrame([(3.0,), (2.25,), (-1.0,), (None,)], "x double").select(seq.number_text(F.col("x")).alias("t")).collect()
    assert [r.t for r in rows] == ["3", "2.2", "-1", None]


def test_intervals(spark):
    rows = spark.createDataFrame([("chr:1:10-17(+)",), ("c:5-9",), ("nothing",), (None,)], "t string").select("t", seq.parsed_interval(F.col("t")).alias("i")).collect()
    assert [tuple(r.i) for r in rows] == [("chr:1", 10, 17, "+"), ("c", 5, 9, None), (None,) * 4, (None,) * 4]
    assert spark.range(1).select(seq.interval_text(F.lit("c"), F.lit(10), F.lit(17), F.lit("-"))).first()[0] == "c:10-17(-)"


def test_pairing_windows(spark):
    rows = spark.createDataFrame([("8mer", 10, 18, 17), ("6mer", 11, 17, 17), ("offset-6mer", 10, 16, 17), ("seed2-9", 3, 11, 11)], "c string, start long, end long, t1 long")
    pairing = seq.seed_pairing(F.col("c"), F.col("start"), F.col("end"), F.col("t1"), (2, 9))
    got = rows.select(pairing.alias("p"), seq.pairing_window(pairing, F.lit(20), F.lit(25), 3).alias("w")).collect()
    assert [tuple(r.p) for r in got] == [(2, 8, 10, 16), (2, 7, 11, 16), (3, 8, 10, 15), (2, 9, 3, 10)]
    assert [tuple(r.w) for r in got] == [(0, 21), (0, 21), (0, 20), (0, 15)]


def test_collapsed_files(spark, tmp_path):
    reads = spark.createDataFrame([("s1", "ACGTACGTACGTACGTACGT")] * 2 + [("s2", "ACGTACGTACGTACGTACGT"), ("s2", "TTTTACGTACGTACGTACGT"), ("s2", "AC")], "sample string, sequence string")
    outputs.write_collapsed(collapse.collapse(reads, 18, 28), collapse.counts(reads, 18, 28), collapse.libraries(reads, 18, 28).sort("sample"), ["s1", "s2"], str(tmp_path))
    assert text_of(tmp_path / "collapsed.fasta") == ">u000000001\nACGTACGTACGTACGTACGT\n>u000000002\nTTTTACGTACGTACGTACGT\n"
    rows = read_tsv(spark, str(tmp_path / "counts.tsv")).sort("read_id").collect()
    assert [tuple(r) for r in rows] == [("u000000001", "ACGTACGTACGTACGTACGT", "20", "2", "1"), ("u000000002", "TTTTACGTACGTACGTACGT", "20", "0", "1")]
    assert sorted(tuple(r) for r in read_tsv(spark, str(tmp_path / "libraries.tsv")).collect()) == [("s1", "2", "2"), ("s2", "3", "2")]


def test_origin_files(spark, tmp_path):
    origin = spark.createDataFrame([("r1", "focus", ["b", "a"]), ("r2", "none", [])], "read_id string, class string, genomes array<string>")
    lengths = spark.createDataFrame([("r1", 20), ("r2", 21)], "read_id string, length int")
    counts = spark.createDataFrame([("r1", "s1", 5), ("r2", "s2", 7)], "read_id string, sample string, n long")
    placed = spark.createDataFrame([("r1", "a", "c", 3, 23, "+", 1 / 3, 0)], "read_id string, genome string, contig string, start long, end long, strand string, weight double, mismatches int")
    outputs.write_origin(placed, origin, lengths, counts, ["s1", "s2"], str(tmp_path))
    assert [tuple(r) for r in read_tsv(spark, str(tmp_path / "alignments.tsv")).collect()] == [("r1", "a", "c", "3", "23", "+", "0.333333", "0")]
    assert sorted(tuple(r) for r in read_tsv(spark, str(tmp_path / "origin_summary.tsv")).collect()) == [("focus", "a+b", "5", "0"), ("none", "", "0", "7")]
    assert sorted(tuple(r) for r in read_tsv(spark, str(tmp_path / "origin_lengths.tsv")).collect()) == [("focus", "a+b", "20", "5", "0"), ("none", "", "21", "0", "7")]


def test_candidates_file(spark, tmp_path):
    loci = spark.createDataFrame([("L1", True, "g", "c", "+", 10, 40, 12, 33, "ACGT", 9, "tRNA"), ("L2", False, "g", "c", "+", 1, 2, 1, 2, "A", 1, "NA")], "locus_id string, pass boolean, genome string, contig string, strand string, start long, end long, rep_start long, rep_end long, rep_sequence string, total_count long, annotation_class string")
    outputs.write_candidates(loci, str(tmp_path / "c"))
    assert text_of(tmp_path / "c") == ">L1 g|c:12-33(+) locus=10-40 count=9 class=tRNA\nACGT\n"


def test_regions_there_and_back(spark, tmp_path):
    rows = spark.createDataFrame([("t|CDS", "t", "g", "CDS", "c", "+", [(0, 4), (10, 12)], "ACGTAC"), ("u|CDS", "u", "u", "CDS", "", "", [], "AC")], "region_id string, transcript string, gene string, region string, contig string, strand string, blocks array<struct<s:bigint,e:bigint>>, sequence string")
    outputs.write_regions(rows, str(tmp_path / "r"))
    raw = read_tsv(spark, str(tmp_path / "r")).sort("region_id")
    assert raw.first().blocks == "1-4,11-12"
    back = outputs.regions_of_table(raw).collect()
    assert [(r.region_id, r.length, [tuple(b) for b in r.blocks]) for r in back] == [("t|CDS", 6, [(0, 4), (10, 12)]), ("u|CDS", 2, [])]


def test_regions_of_transcripts(spark):
    fasta = spark.createDataFrame([("t1", "acguACGU"), ("t2", "GGGG")], "name string, sequence string")
    table = spark.createDataFrame([("t1", "CDS", "2", "4", ""), ("t1", "three_prime_UTR", "5", "8", "G1")], "transcript string, region string, start string, end string, gene string")
    of = lambda df: sorted((r.region_id, r.gene, r.sequence) for r in df.collect())
    assert of(regions.transcript_regions(fasta)) == [("t1|transcript", "t1", "ACGTACGT"), ("t2|transcript", "t2", "GGGG")]
    assert of(regions.transcript_regions(fasta, table)) == [("t1|CDS", "t1", "CGT"), ("t1|three_prime_UTR", "G1", "ACGT")]
    assert of(regions.transcript_regions(fasta, table, ("CDS",), True)) == [("t1|CDS", "t1", "CGT"), ("t2|transcript", "t2", "GGGG")]
    for start, end in (("0", "3"), ("4", "9"), ("5", "4")):
        wrong = spark.createDataFrame([("t1", "CDS", start, end)], "transcript string, region string, start string, end string")
        with pytest.raises(Exception, match="outside of transcript t1"):
            regions.transcript_regions(fasta, wrong).collect()


def test_chosen_loci(spark):
    loci = spark.createDataFrame([("L1", True, 5, 9, 6, 8), ("L2", False, 1, 4, 2, 3)], "locus_id string, pass boolean, start long, end long, rep_start long, rep_end long").withColumns({"genome": F.lit("g"), "contig": F.concat(F.lit("c"), "locus_id"), "strand": F.lit("+")})
    found, strange = precursors.selected(loci)
    assert [(r.candidate, r.start, r.end) for r in found.collect()] == [("L1", 6, 8)] and strange.isEmpty()
    named = spark.createDataFrame([("L2",), ("L2",), ("L9",)], "locus_id string")
    found, strange = precursors.selected(loci, named, "locus")
    assert [(r.candidate, r.start, r.end) for r in found.collect()] == [("L2", 1, 4)] and [r[0] for r in strange.collect()] == ["L9"]
    with pytest.raises(ValueError, match="anchor"):
        precursors.selected(loci, anchor="middle")
    contigs = spark.createDataFrame([("g", "cL2", "ACGT", True), ("g", "other", "A", False)], "genome string, contig string, sequence string, circular boolean")
    assert [r.contig for r in precursors.needed_contigs(found, contigs).collect()] == ["cL2"]
    with pytest.raises(ValueError, match=r"g\|cL1"):
        precursors.needed_contigs(precursors.selected(loci)[0], contigs)


def test_reports_of_trimming(spark):
    one = '{"summary": {"fastp_version": "0.23"}, "read1_before_filtering": {"total_reads": 42}}'
    rows = spark.createDataFrame([("a", one), ("b", '{"read1_before_filtering": {"total_reads": 1}}')], "sample string, value string")
    assert [tuple(r) for r in outputs.raw_reads(rows).collect()] == [("a", 42, "0.23"), ("b", 1, "unknown")]
    with pytest.raises(Exception, match="report of c"):
        outputs.raw_reads(spark.createDataFrame([("c", "{}")], "sample string, value string")).collect()


def test_sample_sheets(spark):
    sheet = lambda *rows: spark.createDataFrame(rows, "sample string, fq1 string, fq2 string")
    assert settings.samples(sheet(("a ", "1.fq", ""), ("", "x", ""), ("b", "2.fq", "3.fq"))) == {"a": ["1.fq"], "b": ["2.fq", "3.fq"]}
    for rows, why in (([("a", "1", ""), ("a", "2", "")], "twice"), ([("a", "", "")], "no fq1"), ([("", "1", "")], "no samples")):
        with pytest.raises(ValueError, match=why):
            settings.samples(sheet(*rows))


def test_genome_settings():
    found = settings.genomes({"g": {"fasta": "g.fa", "topology": "circular", "length": [16, 30]}, "host": {"fasta": "h.fa", "role": "exclude"}}, 18, 28)
    assert (found[0].circular, found[0].low, found[0].high, found[1].role, found[1].low) == (True, 16, 30, "exclude", 18)
    assert settings.read_range(found, 18, 28) == (16, 30)
    for spec in ({}, {"a|b": {"fasta": "x"}}, {"a": {}}, {"a": {"fasta": "x", "role": "y"}}, {"a": {"fasta": "x", "topology": "y"}}, {"a": {"fasta": "x", "length": [5, 3]}}, {"a": {"fasta": "x", "role": "exclude"}}, {"a": {"fasta": "x", "targets": "y"}}):
        with pytest.raises(ValueError):
            settings.genomes(spec, 18, 28)
    assert settings.parsed_seed("2-8") == (2, 8)
    with pytest.raises(ValueError, match="START"):
        settings.parsed_seed("8-2")


def test_target_sets():
    sets = {"plant": {}, "germ": {"mode": "bacterial"}}
    spec = {"a": {}, "b": {"target_sets": ["germ"]}, "c": {"targets": "ago"}, "d": {"targets": "none"}, "e": {"role": "exclude"}, "f": {"target_sets": ["what"]}}
    assert [settings.target_sets(spec, sets, g) for g in "abcde"] == [["plant", "germ"], ["germ"], ["plant"], [], []]
    with pytest.raises(ValueError, match="what"):
        settings.target_sets(spec, sets, "f")


def test_candidates_of_genomes(spark):
    c = spark.createDataFrame([("x", "g"), ("y", "h"), ("z", "")], "candidate string, genome string")
    d = spark.createDataFrame([("x1", "x"), ("y1", "y")], "guide_id string, candidate string")
    kept, decoys = settings.of_genomes(c, d, ["g"])
    assert sorted(r.candidate for r in kept.collect()) == ["x", "z"] and [r.guide_id for r in decoys.collect()] == ["x1"]
    assert settings.of_genomes(c, d, [])[0].count() == 3
