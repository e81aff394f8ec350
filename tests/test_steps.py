"""The steps on files, one after the other, by the command line; and what each refuses."""

import gzip
import json
import random

import pytest

from locusmill import cli, steps
from locusmill.sources import settings
from locusmill.sources.tables import read_tsv


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


@pytest.fixture(scope="module")
def run(tmp_path_factory):
    """Two genomes, a small RNA over the origin of a circular one, one on its other strand, and noise, in two samples."""
    d, rng = tmp_path_factory.mktemp("run"), random.Random(7)
    gen = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    mito, other = gen(500), gen(700)
    (d / "m.fa").write_text(f">mt circular\n{mito[:250]}\n{mito[250:]}\n")
    (d / "n.fa").write_text(f">chr1\n{other}\n")
    (d / "m.gff").write_text("##gff-version 3\nmt\tx\tgene\t200\t240\t.\t-\t.\tID=g1;Name=tr%20X\nmt\tx\ttRNA\t200\t240\t.\t-\t.\tID=t1\n##FASTA\n>mt\nACGT\n")
    wrap, minus = (mito + mito)[490:512], rc(mito[205:227])
    for s, scale in (("a", 1), ("b", 2)):
        reads = [wrap] * 60 * scale + [minus] * 40 * scale + [other[50:72]] * 10 + [gen(22) for _ in range(30)] + ["ACGT", "N" * 22]
        rng.shuffle(reads)
        with gzip.open(d / f"{s}.fq.gz", "wt") as f:
            f.writelines(f"@r{k}\n{x}\n+\n{'I' * len(x)}\n" for k, x in enumerate(reads))
        (d / f"{s}.json").write_text(json.dumps({"summary": {"fastp_version": "1"}, "read1_before_filtering": {"total_reads": len(reads) + 5}}))
    truth = d / "truth"
    truth.mkdir()
    names = ["feature_id", "category", "genome", "contig", "strand", "start", "end", "length", "wraps_origin", "expected", "sequence", "total_reads"]
    rows = [("f1", "srna_origin", "mito", "mt", "+", 491, 12, 22, 1, "pass", wrap, 180), ("f2", "srna", "mito", "mt", "-", 206, 227, 22, 0, "pass", minus, 120), ("f3", "srna", "mito", "mt", "+", 300, 320, 21, 0, "missed", "", 0), ("f4", "degradation", "mito", "mt", "+", 300, 320, 21, 0, "any", "", 0)]
    (truth / "features.tsv").write_text("\n".join("\t".join(map(str, r)) for r in (names, *rows)) + "\n")
    return d


def test_run(spark, run):
    d = str(run)
    spec = {"mito": {"fasta": f"{d}/m.fa", "topology": "circular", "annotation": f"{d}/m.gff"}, "nuc": {"fasta": f"{d}/n.fa", "role": "exclude"}}
    said = lambda *argv: cli.run(spark, list(argv))
    rows = lambda path: [r.asDict() for r in read_tsv(spark, f"{d}/{path}").collect()]
    of = ["--collapsed", f"{d}/collapsed", "--reference", f"{d}/reference"]
    said("collapse", "--sample", f"a={d}/a.fq.gz", "--sample", f"b={d}/b.fq.gz", "--out", f"{d}/collapsed")
    said("build-ref", "--spec", json.dumps(spec), "--out", f"{d}/reference")
    contigs = {r["ref"]: r for r in rows("reference/contigs.tsv")}
    assert contigs["mito|mt"]["length"] == "500" and contigs["mito|mt"]["circular"] == "1" and set(contigs) == {"mito|mt", "nuc|chr1"}
    said("align", *of, "--out", f"{d}/aligned")
    said("assign", *of, "--aligned", f"{d}/aligned", "--out", f"{d}/assigned")
    classes = {r["class"]: (int(r["a"]), int(r["b"])) for r in rows("assigned/origin_summary.tsv")}
    assert classes["assigned"] == (100, 200) and classes["excluded"] == (10, 10) and classes["unmapped"] == (30, 30)
    said("discover", *of, "--assigned", f"{d}/assigned", "--out", f"{d}/discovered")
    loci = {r["strand"]: r for r in rows("discovered/loci.tsv")}
    assert (loci["+"]["start"], loci["+"]["end"], loci["+"]["wraps_origin"], loci["+"]["count_b"], loci["+"]["pass"]) == ("491", "12", "1", "120.0", "1")
    assert (loci["-"]["start"], loci["-"]["end"], loci["-"]["annotation_class"], loci["-"]["rep_length"]) == ("206", "227", "tRNA", "22")
    assert sum(float(r["count"]) for r in rows("discovered/locus_reads.tsv")) == 300
    said("coverage", *of, "--assigned", f"{d}/assigned", "--out", f"{d}/coverage")
    depth = {(r["strand"], int(r["position"])): r for r in rows("coverage/coverage.tsv")}
    assert len(depth) == 44 and depth["+", 491]["five_ends"] == "180.0" and depth["+", 12]["depth_a"] == "60.0" and depth["-", 227]["five_ends"] == "120.0" and depth["-", 206]["depth"] == "120.0"
    said("funnel", "--collapsed", f"{d}/collapsed", "--assigned", f"{d}/assigned", "--discovered", f"{d}/discovered", "--out", f"{d}/funnel", "--trimming", f"{d}/a.json", f"{d}/b.json")
    stages = {r["stage"]: (r["a"], r["b"], r["total"]) for r in rows("funnel/funnel.tsv")}
    assert stages == {"raw": ("147", "247", "394"), "trimmed": ("142", "242", "384"), "length_range": ("140", "240", "380"), "mapped": ("110", "210", "320"), "focus": ("100", "200", "300"), "in_peaks": ("100", "200", "300"), "in_passing": ("100", "200", "300")}
    lines = [r["value"] for r in spark.read.text(f"{d}/funnel/funnel_mqc.txt").collect()]
    assert lines[3].startswith("# plot_type") and lines[4].startswith("Sample\tRaw reads\t") and lines[5:] == ["a\t147\t142\t140\t110\t100\t100\t100", "b\t247\t242\t240\t210\t200\t200\t200"]
    lines = [r["value"] for r in spark.read.text(f"{d}/funnel/origin_mqc.txt").collect()]
    assert lines[-3:] == ["Sample\tassigned (mito)\texcluded (nuc)\tunmapped", "a\t100\t10\t30", "b\t200\t10\t30"]
    # targets
    with open(f"{d}/tx.fa", "w") as f:
        guides = [r["rep_sequence"] for r in loci.values()]
        f.writelines(f">tx{k}\nAAAA{rc(g[1:8])}A{'ACGTTGCA' * 9}\n" for k, g in enumerate(guides))
    said("regions", "--transcripts", f"{d}/tx.fa", "--out", f"{d}/regions")
    said("decoys", "--candidates", f"{d}/discovered/candidates.fasta", "--n", "25", "--out", f"{d}/decoys")
    more = ["--candidates", f"{d}/discovered/candidates.fasta", "--regions", f"{d}/regions", "--decoys", f"{d}/decoys/decoys.fasta"]
    said("sites", *more, "--out", f"{d}/sites")
    sites = rows("sites/sites.tsv")
    assert {(r["transcript"], r["site_class"], r["site_start"], r["site_end"]) for r in sites if r["site_class"] == "8mer"} >= {("tx0", "8mer", "5", "12"), ("tx1", "8mer", "5", "12")}
    fdr = {(r["candidate"], r["site_class"]): r for r in rows("sites/fdr.tsv")}
    assert int(fdr["all", "any"]["real_sites"]) == len(sites) and len(fdr) == 3 * 6
    assert all(r["best_class_fdr"] == fdr[r["candidate"], r["best_class"]]["fdr"] for r in rows("sites/targets.tsv"))
    said("score-sites", *more, "--out", f"{d}/scored")
    scored = rows("scored/scored_sites.tsv")
    assert len(scored) == len(sites) and all(float(r["paired"]) < 0 for r in scored if r["site_class"] == "8mer")
    assert {r["candidate"] for r in rows("scored/scored_targets.tsv")} == {r["candidate"] for r in sites}
    assert rows("scored/decoy_scores.tsv") == [] or rows("scored/decoy_scores.tsv")[0]["decoy"].count("__decoy") == 1
    told = said("estimate", *more)
    assert told[0].startswith("8mer: ") and told[-1].endswith("core-hours")
    told = said("precursors", "--reference", f"{d}/reference", "--discovered", f"{d}/discovered", "--out", f"{d}/precursors", "--shuffles", "3", "--flanks", "20", "5")
    windows = rows("precursors/precursors.tsv")
    assert told == [] and len(windows) == 4 and sum(int(r["best"]) for r in windows) == 2
    over = {r["window"]: r for r in windows if r["strand"] == "+"}
    assert (over["5p"]["window_start"], over["5p"]["window_end"], over["5p"]["wraps_origin"]) == ("486", "32", "1")
    assert all(r["sequence"][int(r["candidate_from"]) - 1 : int(r["candidate_to"])] == loci[r["strand"]]["rep_sequence"] for r in windows)
    # evaluation
    (run / "config.yaml").write_text("genomes: x\nassignment:\n  mode: best\n")
    told = said("evaluate", "--truth", f"{d}/truth", *of, "--assigned", f"{d}/assigned", "--discovered", f"{d}/discovered", "--out", f"{d}/evaluation", "--settings", f"{d}/none.yaml", f"{d}/config.yaml")
    assert told == [f"settings from {d}/config.yaml"]
    seen = {r["feature_id"]: (r["outcome"], r["as_expected"], r["rep_is_canonical"], r["rep_five_offset"]) for r in rows("evaluation/smallrnas.tsv")}
    assert seen == {"f1": ("pass", "1", "1", "0"), "f2": ("pass", "1", "1", "0"), "f3": ("missed", "1", "", "")}
    assert rows("evaluation/false_positives.tsv") == []
    assert {r["feature_id"]: r["matched_reads"] for r in rows("evaluation/origin_by_feature.tsv")} == {"f1": "180", "f2": "120"}
    text = [r["value"] for r in spark.read.text(f"{d}/evaluation/summary.txt").collect()]
    assert any("Planted small RNAs on focus genomes: 3, as expected: 3" in x for x in text) and any(x.startswith("Rejected reads: 0") for x in text)


def test_refusals(spark, tmp_path):
    with pytest.raises(ValueError, match="NAME=PATH"):
        steps.named_paths(["a"])
    with pytest.raises(ValueError, match="annotation"):
        steps.target_regions(spark, str(tmp_path / "x"), ["CDS"], genome="g.fa")
    with pytest.raises(ValueError, match="transcripts"):
        steps.target_regions(spark, str(tmp_path / "x"), ["CDS"])
    with pytest.raises(ValueError, match="flanks"):
        steps.fold_precursors(spark, "r", "d", "o", flanks=(3,))
    with pytest.raises(ValueError, match="SAM"):
        steps.assign_origin(spark, "c", "r", "o", steps.origin.OriginRules())
    (tmp_path / "a.fa").write_text(">x|y\nAC\n")
    with pytest.raises(ValueError, match="stand twice"):
        steps.build_reference(spark, {"g": {"fasta": str(tmp_path / "a.fa")}}, 18, 28, str(tmp_path / "o"))
    with pytest.raises(ValueError, match="unknown predictors"):
        cli.run(spark, ["score-sites", "--candidates", "c", "--regions", "r", "--out", "o", "--predictors", "magic"])


def test_settings_of_a_run(tmp_path):
    text = 'a: 1\nassignment:\n  mode: "evil" # why\n  deep:\n    x: y\n  evil_max_diff: 1\n- item: no\nlist:\n  - one\n"quoted key": v\nempty:\n'
    assert settings.scalars(text) == {"a": "1", "assignment.mode": "evil", "assignment.deep.x": "y", "assignment.evil_max_diff": "1", "quoted key": "v"}
    (tmp_path / "c.yaml").write_text(text)
    (tmp_path / "p.yaml").write_text("config:\n  assignment:\n    mode: severe\n  ambiguous: split\n")
    assert settings.run_settings([str(tmp_path / "p.yaml"), str(tmp_path / "c.yaml")])["mode"] == "severe"
    assert settings.run_settings([str(tmp_path / "none"), str(tmp_path / "c.yaml")]) == {"mode": "evil", "evil_max_diff": 1, "ambiguous": "report", "source": str(tmp_path / "c.yaml")}
    assert settings.run_settings([])["source"] == "the defaults"


def test_provenance(spark):
    env = "name: e\ndependencies:\n  - python >=3.9  # why\n  - fastp=0.23.4\n  - pip\nother:\n  - not=1\n"
    assert settings.pins(env) == {"python": ">=3.9", "fastp": "=0.23.4", "pip": ""}
    loci = spark.createDataFrame([("g", 3, 2, 1)], "genome string, loci long, peaks long, passing long")
    made = settings.provenance({"x": {"y": [1, {"z": None}], "e": []}, "on": True, "f": 1e-05}, ["a"], [env], loci, {"spark": "4"})
    want = 'software:\n  spark: "4"\nconda_pins:\n  python: ">=3.9"\n  fastp: "=0.23.4"\n  pip: ""\nsamples:\n  - "a"\nresults:\n  g:\n    loci: 3\n    peak_loci: 2\n    passing: 1\nconfig:\n  x:\n    y:\n      - 1\n      - z: null\n    e: []\n  "on": true\n  f: 1.0e-05'
    assert settings.yaml_text(made) == want
