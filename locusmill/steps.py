"""The steps of an analysis on files. Each checks its arguments, reads the folders of the steps before it, and writes one of its own; all work is Spark's."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusmill.functions.circular import checked_interval, five_prime, half_open
from locusmill.functions.sequences import folding_indices, gc_percent
from locusmill.operators import align, collapse, discovery, evaluation, hairpins, intervals, origin, planted, precursors, regions, reports, scoring, seeds, shuffles, significance
from locusmill.operators.loci import LocusRules
from locusmill.operators.peaks import PeakRules
from locusmill.sources import outputs, settings, tables
from locusmill.sources.sequences import fasta_names, read_candidates, read_decoys, read_fasta, read_fastq, write_fasta


def named_paths(items: list[str]) -> dict[str, list[str]]:
    """``NAME=PATH`` arguments as the files of each name, in their order."""
    out: dict[str, list[str]] = {}
    for item in items:
        name, _, path = item.partition("=")
        if not name or not path:
            raise ValueError(f"a sample is given as NAME=PATH, not {item!r}")
        out.setdefault(name, []).append(path)
    if not out:
        raise ValueError("no samples")
    return out


def _typed(rows: DataFrame, **kinds: str) -> DataFrame:
    """Columns of a table of strings cast; booleans are written 0 and 1, empty fields are null."""
    known = {c: k for c, k in kinds.items() if c in rows.columns}
    value = lambda c, k: (F.nullif(F.col(c), F.lit("")).cast("int") if k == "boolean" else F.nullif(F.col(c), F.lit(""))).cast(k)
    return rows.withColumns({c: value(c, k) for c, k in known.items()})


def collapse_reads(spark: SparkSession, samples: list[str], low: int, high: int, out: str) -> None:
    """Distinct reads of FASTQ files (``NAME=PATH``, several for a sample if need be): ``collapsed.fasta``, ``counts.tsv``, ``libraries.tsv``."""
    if not 1 <= low <= high:
        raise ValueError("read lengths go from a lowest to a highest one")
    paths = named_paths(samples)
    reads = read_fastq(spark, paths)
    outputs.write_collapsed(collapse.collapse(reads, low, high), collapse.counts(reads, low, high), collapse.libraries(reads, low, high).sort("sample"), list(paths), out)


def build_reference(spark: SparkSession, spec: dict, low: int, high: int, out: str) -> None:
    """All genomes' contigs as ``reference.fasta`` with ``contigs.tsv`` and ``genomes.tsv``; a contig name with ``|`` or one that a genome has twice is an error."""
    found = settings.genomes(spec, low, high)
    parts = [read_fasta(spark, g.fasta).select(F.concat(F.lit(f"{g.name}|"), "name").alias("ref"), F.lit(g.name).alias("genome"), F.col("name").alias("contig"), "sequence", F.lit(g.circular).alias("circular")) for g in found]
    contigs = parts[0]
    for p in parts[1:]:
        contigs = contigs.unionByName(p)
    bad = contigs.groupBy("ref").agg(F.count(F.lit(1)).alias("n"), F.max(F.contains("contig", F.lit("|"))).alias("bar")).filter("n > 1 OR bar").limit(5).collect()
    if bad:
        raise ValueError("contig names that hold | or stand twice in a genome: " + ", ".join(r["ref"] for r in bad))
    genomes = spark.createDataFrame([(g.name, g.fasta, g.role, g.circular, g.annotation, g.low, g.high, g.targets) for g in found], "name string, fasta string, role string, circular boolean, annotation string, min_length int, max_length int, targets string")
    outputs.write_reference(contigs, genomes, max(g.high for g in found), out)


@dataclass(frozen=True)
class Reference:
    contigs: DataFrame
    genomes: DataFrame


def load_reference(spark: SparkSession, folder: str) -> Reference:
    genomes = _typed(tables.read_tsv(spark, f"{folder}/genomes.tsv"), circular="boolean", min_length="int", max_length="int").withColumnRenamed("name", "genome")
    contigs = _typed(tables.read_tsv(spark, f"{folder}/contigs.tsv"), length="long", circular="boolean").join(genomes.select("genome", "role"), "genome")
    return Reference(contigs, genomes)


@dataclass(frozen=True)
class Collapsed:
    samples: list[str]
    reads: DataFrame
    counts: DataFrame
    libraries: DataFrame


def load_collapsed(spark: SparkSession, folder: str) -> Collapsed:
    wide = tables.read_tsv(spark, f"{folder}/counts.tsv")
    counts = tables.long_counts(wide, "read_id").withColumn("n", F.col("n").cast("long"))
    return Collapsed(wide.columns[3:], wide.select("read_id", "sequence", F.col("length").cast("int").alias("length")), counts, _typed(tables.read_tsv(spark, f"{folder}/libraries.tsv"), reads_in="long", reads_kept="long"))


def align_reads(spark: SparkSession, collapsed: str, reference: str, mismatches: int, max_hits: int, out: str, mode: str = "best", evil_max_diff: int = 0) -> None:
    """Placements of the collapsed reads on the reference: ``hits.tsv``, and ``excess.tsv``, the reads with too many."""
    fasta = read_fasta(spark, f"{reference}/reference.fasta").select(F.col("name").alias("ref"), "sequence")
    hits, many = align.reported(load_collapsed(spark, collapsed).reads.select("read_id", "sequence"), fasta, mismatches, max_hits, mode, evil_max_diff)
    tables.write_tsv(hits, f"{out}/hits.tsv", ["read_id", "ref", "start", "end", "strand", "mismatches"])
    tables.write_tsv(many, f"{out}/excess.tsv", ["read_id"])


def assign_origin(spark: SparkSession, collapsed: str, reference: str, out: str, rules: origin.OriginRules, aligned: str | None = None, sam: str | None = None, excess: str | None = None) -> None:
    """The genome of origin of each read, from ``align_reads`` or from a SAM and the FASTA of reads with too many hits: alignments, origins, and their summaries by sample."""
    if (aligned is None) == (sam is None):
        raise ValueError("give the folder of align_reads, or a SAM")
    c, ref = load_collapsed(spark, collapsed), load_reference(spark, reference)
    if aligned:
        hits = _typed(tables.read_tsv(spark, f"{aligned}/hits.tsv"), start="long", end="long", mismatches="int")
        many = tables.read_tsv(spark, f"{aligned}/excess.tsv")
    else:
        hits = tables.parse_sam(spark.read.text(sam))
        many = fasta_names(spark, excess).select(F.col("name").alias("read_id")) if excess else c.reads.select("read_id").limit(0)
    found = origin.distinct_hits(hits, ref.contigs.select("ref", "genome", "contig", "role", "length", "circular"))
    judged = origin.classify(found, rules)
    every = origin.with_unaligned(judged, c.reads, many)
    outputs.write_origin(origin.placements(found, judged, rules), every, c.reads.select("read_id", "length"), c.counts, c.samples, out)


def _members(spark: SparkSession, assigned: str, c: Collapsed, ref: Reference) -> DataFrame:
    placed = _typed(tables.read_tsv(spark, f"{assigned}/alignments.tsv"), start="long", end="long", weight="double", mismatches="int")
    rows = placed.join(c.reads.select("read_id", "sequence"), "read_id").join(c.counts, "read_id")
    return discovery.within_lengths(rows, ref.genomes)


def _features(spark: SparkSession, ref: Reference) -> tuple[DataFrame | None, list[str]]:
    noted = [(r["genome"], r["annotation"]) for r in ref.genomes.filter("annotation <> ''").select("genome", "annotation").collect()]  # a row a genome
    parts = [tables.features(tables.parse_gff(tables.numbered_lines(spark, path)), genome) for genome, path in noted]
    if not parts:
        return None, []
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, [g for g, _ in noted]


def discover(spark: SparkSession, collapsed: str, reference: str, assigned: str, out: str, rules: LocusRules = LocusRules(), peaks: PeakRules | None = PeakRules(), gap: int = 0) -> None:
    """Loci of the placed reads: ``loci.tsv``, ``locus_reads.tsv`` and ``candidates.fasta``."""
    c, ref = load_collapsed(spark, collapsed), load_reference(spark, reference)
    features, annotated = _features(spark, ref)
    members = _members(spark, assigned, c, ref)
    found = discovery.discover(members.drop("sequence"), ref.contigs.select("genome", "contig", "length", "circular"), c.libraries, features, rules, peaks, gap, annotated)
    loci = discovery.with_samples(found, c.samples).join(c.reads.select(F.col("read_id").alias("rep_id"), F.col("sequence").alias("rep_sequence")), "rep_id")
    outputs.write_discovery(loci, found.reads.join(c.reads.select("read_id", "sequence"), "read_id"), c.samples, out)


def load_loci(spark: SparkSession, folder: str) -> DataFrame:
    kinds = {c: "long" for c in ("start", "end", "span", "rep_start", "rep_end", "unique_reads")} | {c: "boolean" for c in ("wraps_origin", "expression_pass", "ends_pass", "pass")}
    return _typed(tables.read_tsv(spark, f"{folder}/loci.tsv"), **kinds, **{c: "double" for c in ("total_count", "five_score", "three_score", "isolation")})


def coverage(spark: SparkSession, collapsed: str, reference: str, assigned: str, out: str) -> None:
    """Depth by position, strand and sample on focus genomes: the table ``coverage.tsv``."""
    c, ref = load_collapsed(spark, collapsed), load_reference(spark, reference)
    members = _members(spark, assigned, c, ref).join(ref.genomes.filter("role = 'focus'").select("genome"), "genome", "left_semi")
    contigs = ref.contigs.select("genome", "contig", "length", "circular")
    w = F.col("weight") * F.col("n")
    runs = intervals.sample_runs(members, contigs, w, c.samples)
    five = five_prime(F.col("start"), F.col("end"), F.col("strand"))
    fives = members.join(contigs, ["genome", "contig"]).groupBy("genome", "contig", "strand", (F.pmod(five, F.col("length")) + 1).alias("position")).agg(F.sum(w).alias("five_ends"))
    outputs.write_coverage(outputs.coverage_rows(runs, fives, c.samples), c.samples, f"{out}/coverage.tsv")


def funnel(spark: SparkSession, trimming: list[str], collapsed: str, assigned: str, discovered: str, out: str) -> None:
    """Reads left at each stage: ``funnel.tsv`` and two texts for a report collector. ``trimming``: one trimming report (JSON) a sample, in the order of the samples."""
    c = load_collapsed(spark, collapsed)
    if len(trimming) != len(c.samples):
        raise ValueError(f"{len(c.samples)} samples need one trimming report each, not {len(trimming)}")
    parts = [spark.read.text(p, wholetext=True).select(F.lit(s).alias("sample"), "value") for s, p in zip(c.samples, trimming)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    raw = outputs.raw_reads(every).select("sample", F.col("raw").alias("reads"))
    loci = load_loci(spark, discovered)
    names = [f"count_{s}" for s in c.samples]
    counts = loci.select(F.col("locus_type").alias("kind"), "pass", *[F.col(f"`{n}`").cast("double").alias(n) for n in names]).unpivot(["kind", "pass"], names, "sample", "count").withColumn("sample", F.substring("sample", 7, 1 << 20))
    cls = tables.read_tsv(spark, f"{assigned}/origin.tsv")
    rows = reports.funnel(raw, c.libraries, cls.select("read_id", "class"), c.counts, counts)
    order = F.array_position(F.array(*map(F.lit, reports.STAGES)), F.col("stage"))
    wide = rows.groupBy("stage", "label").pivot("sample", [*c.samples, "total"]).agg(F.first("reads")).na.fill(0).sort(order)
    shown = wide.withColumns({s: outputs.number_text(F.col(f"`{s}`")) for s in [*c.samples, "total"]})
    tables.write_tsv(shown, f"{out}/funnel.tsv", ["stage", "label", *c.samples, "total"])
    outputs.funnel_lines(rows, c.samples).write.text(f"{out}/funnel_mqc.txt")
    summary = tables.read_tsv(spark, f"{assigned}/origin_summary.tsv")
    long = summary.select("class", "genomes", *[F.col(f"`{s}`").cast("double").alias(s) for s in c.samples]).unpivot(["class", "genomes"], c.samples, "sample", "reads")
    outputs.origin_lines(long, c.samples).write.text(f"{out}/origin_mqc.txt")


def target_regions(spark: SparkSession, out: str, wanted: list[str], genome: str = "", annotation: str = "", transcripts: str = "", table: str = "", whole_if_missing: bool = False) -> None:
    """Target regions of a genome and its annotation, or of transcripts: the table ``regions.tsv``."""
    if genome:
        if not annotation:
            raise ValueError("a genome needs its annotation")
        contigs = read_fasta(spark, genome).select(F.col("name").alias("contig"), "sequence")
        found = regions.regions(regions.transcripts(tables.parse_gff(tables.numbered_lines(spark, annotation))), contigs, tuple(wanted), whole_if_missing)
    elif transcripts:
        rows = tables.read_tsv(spark, table) if table else None
        found = regions.transcript_regions(read_fasta(spark, transcripts), rows, tuple(wanted), whole_if_missing)
        found = found.withColumns({"contig": F.lit(""), "strand": F.lit(""), "blocks": F.array().cast(regions.BLOCKS)})
    else:
        raise ValueError("give a genome and its annotation, or transcripts")
    outputs.write_regions(found, f"{out}/regions.tsv")


def make_decoys(spark: SparkSession, candidates: str, n: int, out: str, seed: str = "2-8", random_seed: int = 1) -> None:
    """Shuffles of the candidates that share no seed with any of them: ``decoys.fasta``."""
    first, last = settings.parsed_seed(seed)
    made = shuffles.decoys(read_candidates(spark, candidates).select("candidate", "guide"), n, str(random_seed), first, last)
    write_fasta(made, f"{out}/decoys.fasta", "guide_id", "guide")


def _guides(spark: SparkSession, candidates: str, decoys: str, genomes: list[str]) -> DataFrame:
    """guide_id, candidate, decoy (its place among its candidate's), guide of candidates and their decoys."""
    real = read_candidates(spark, candidates)
    made = read_decoys(spark, decoys) if decoys else real.select(F.col("candidate").alias("guide_id"), "candidate", "guide").limit(0)
    real, made = settings.of_genomes(real, made, genomes)
    number = F.regexp_extract("guide_id", r"__decoy(\d+)$", 1).cast("int")
    return real.select(F.col("candidate").alias("guide_id"), "candidate", F.lit(None).cast("int").alias("decoy"), "guide").unionByName(made.select("guide_id", "candidate", number.alias("decoy"), "guide"))


def _placed_sites(found: DataFrame, held: DataFrame, guides: DataFrame) -> DataFrame:
    """Sites of real guides in every region that has their sequence, with context and place on the genome. ``held``: regions with seq_id."""
    rows = found.join(guides.filter("decoy IS NULL").select("guide_id", "candidate", "guide"), "guide_id")
    rows = seeds.with_context(rows, held)
    place = regions.genomic(F.col("contig"), F.col("strand"), F.col("blocks"), F.col("start"), F.col("end"))
    return rows.withColumn("genomic", place).withColumns({"site_start": F.col("start") + 1, "site_end": F.col("end")})


@dataclass(frozen=True)
class _Targets:
    guides: DataFrame
    held: DataFrame
    targets: DataFrame
    seed: tuple[int, int]
    classes: tuple[str, ...]


def _targets(spark: SparkSession, candidates: str, decoys: str, region_table: str, genomes: list[str], seed: str, classes: list[str]) -> _Targets:
    span = settings.parsed_seed(seed)
    held = outputs.regions_of_table(tables.read_tsv(spark, f"{region_table}/regions.tsv")).withColumn("seq_id", F.sha2("sequence", 256))
    return _Targets(_guides(spark, candidates, decoys, genomes), held, seeds.distinct_sequences(held), span, tuple(classes) or seeds.class_names(span))


def seed_sites(spark: SparkSession, candidates: str, region_table: str, out: str, decoys: str = "", genomes: list[str] = (), seed: str = "2-8", classes: list[str] = ()) -> None:
    """Seed sites of candidates and decoys, targets and the decoys' false discovery rates: ``sites.tsv``, ``targets.tsv``, ``fdr.tsv``."""
    t = _targets(spark, candidates, decoys, region_table, list(genomes), seed, list(classes))
    found = seeds.sites(t.guides.select("guide_id", "guide"), t.targets, t.classes, t.seed)
    fdr = significance.site_count_fdr(seeds.class_counts(found, t.guides, t.classes), pooled=True)
    rows = significance.with_class_fdr(_placed_sites(found, t.held, t.guides), outputs.fdr_text(fdr))
    summary = significance.with_class_fdr(seeds.target_summary(rows, t.classes), outputs.fdr_text(fdr), "best_class", "best_class_fdr")
    outputs.write_sites(rows, summary, fdr, t.classes, out)


def score_sites(
    spark: SparkSession, candidates: str, region_table: str, decoys: str, out: str, predictors: list[scoring.Predictor], genomes: list[str] = (), seed: str = "2-8", classes: list[str] = (), score_weak: bool = False, fdr: float = 0.05,
) -> None:
    """Sites scored by the given predictors against the decoys: ``scored_sites.tsv``, ``scored_targets.tsv``, ``decoy_scores.tsv``, ``curves.tsv``."""
    t = _targets(spark, candidates, decoys, region_table, list(genomes), seed, list(classes))
    jobs = scoring.score_sites(scoring.jobs(t.guides, t.targets, t.seed, t.classes, score_weak), predictors)
    scored, curves = scoring.with_significance(jobs, predictors, scoring.decoys_each(t.guides), fdr)
    found = seeds.sites(t.guides.select("guide_id", "guide"), t.targets, t.classes, t.seed)
    counts = outputs.fdr_text(significance.site_count_fdr(seeds.class_counts(found, t.guides, t.classes), pooled=True))
    rows = scoring.attached(significance.with_class_fdr(_placed_sites(found, t.held, t.guides), counts), scored)
    own = [(p.name, p.ranked, [*[f.split()[0] for f in p.columns.split(", ")], f"{p.name}_z"]) for p in predictors]
    made = scored.filter("decoy IS NOT NULL").drop("decoy").join(t.targets.select("seq_id", F.col("sequence").alias("region_sequence")), "seq_id")
    made = made.select(F.col("guide_id").alias("decoy"), "candidate", "region_sequence", "site_class", (F.col("start") + 1).alias("site_start"), *[c for _, _, cs in own for c in cs])
    outputs.write_scored(rows, scoring.scored_targets(rows, predictors, t.classes), made, curves, own, t.classes, out)


def estimate(spark: SparkSession, candidates: str, region_table: str, decoys: str, seed: str = "2-8", classes: list[str] = (), score_weak: bool = False) -> tuple[DataFrame, DataFrame]:
    """What scoring would take: sites by class, and the costs."""
    t = _targets(spark, candidates, decoys, region_table, [], seed, list(classes))
    found = seeds.sites(t.guides.select("guide_id", "guide"), t.targets, t.classes, t.seed)
    return scoring.class_estimate(found, t.guides, t.classes, score_weak), scoring.cost_estimate(found, t.targets, t.classes, score_weak)


def fold_precursors(
    spark: SparkSession, reference: str, discovered: str, out: str, candidates: str = "", anchor: str = "representative", flanks: tuple[int, int] = (15, 50), shuffled: int = 1000, random_seed: int = 1, fold: hairpins.Fold = hairpins.stacking_fold,
) -> list[str]:
    """The surroundings of loci folded in two windows each: the table ``precursors.tsv``. Named candidates that no locus has are left out, and some of their ids returned."""
    if len(flanks) != 2 or min(flanks) < 0:
        raise ValueError("flanks are two numbers from 0 up, a short and a long one")
    near, far = sorted(flanks)
    ref, loci = load_reference(spark, reference), load_loci(spark, discovered)
    named = fasta_names(spark, candidates).select(F.col("name").alias("locus_id")) if candidates else None
    chosen, unknown = precursors.selected(loci, named, anchor)
    contigs = read_fasta(spark, f"{reference}/reference.fasta").select(F.col("name").alias("ref"), "sequence").join(ref.contigs, "ref")
    contigs = contigs.withColumn("sequence", F.left("sequence", F.col("length").cast("int")))  # without the overhang
    held = precursors.needed_contigs(chosen, contigs.select("genome", "contig", "sequence", "circular")).withColumn("ref", F.concat_ws("|", "genome", "contig"))
    rows = chosen.join(ref.contigs.select("genome", "contig", "length", "ref"), ["genome", "contig"])
    start, end = checked_interval(F.col("start"), F.col("end"), F.col("length"))
    windows = hairpins.windows(rows.select("candidate", "ref", start.alias("start"), end.alias("end"), "strand"), held, near, far)
    folds = hairpins.folded(hairpins.with_shuffles(windows.select("candidate", "window", "sequence"), shuffled, str(random_seed)), fold)
    p = significance.empirical_p(folds.select("candidate", "window", "shuffle", "mfe"), ["candidate", "window"]).withColumnRenamed("p", "pvalue")
    real = hairpins.described(folds.filter("shuffle IS NULL").select("candidate", "window", "structure", "mfe").join(windows, ["candidate", "window"]))
    amfe, mfei = folding_indices(F.col("mfe"), F.col("sequence"))
    real = real.join(p, ["candidate", "window"]).withColumns({"amfe": amfe, "mfei": mfei, "gc": gc_percent(F.col("sequence")), "shuffles": F.lit(shuffled)})
    best = hairpins.best_windows(real.withColumn("p", F.col("pvalue"))).select("candidate", "window", F.lit(True).alias("best"))
    real = real.drop("strand").join(best, ["candidate", "window"], "left").join(rows.withColumnsRenamed({"start": "candidate_start", "end": "candidate_end"}), ["candidate", "ref"])
    written = real.withColumns({
        "best": F.coalesce("best", F.lit(False)), "window_start": F.col("win_start") + 1, "window_end": F.when(F.col("wraps"), F.col("win_end") - F.col("length")).otherwise(F.col("win_end")), "wraps_origin": F.col("wraps"),
        "length": F.col("win_end") - F.col("win_start"), "candidate_from": F.col("cand_from") + 1, "candidate_to": F.col("cand_to"), "in_arm": F.col("arm").isin("5p", "3p"),
    })
    outputs.write_precursors(written, f"{out}/precursors.tsv")
    return [r["locus_id"] for r in unknown.sort("locus_id").limit(10).collect()]


def evaluate(spark: SparkSession, truth: str, results: dict[str, str], out: str, mode: str = "best", evil_max_diff: int = 0) -> None:
    """Results held against planted features (``truth``/features.tsv): ``smallrnas.tsv``, ``false_positives.tsv``, ``origin_by_feature.tsv``, ``outcomes.tsv``, ``rejected.tsv`` and ``summary.txt``.

    ``results``: the folders of the steps, by the names collapsed, reference, assigned, discovered.
    """
    c, ref = load_collapsed(spark, results["collapsed"]), load_reference(spark, results["reference"])
    place = ref.contigs.select("genome", "contig", "length", "circular")

    def placed(rows: DataFrame, wraps: str) -> DataFrame:
        on = rows.drop("length", "circular").join(place, ["genome", "contig"])
        start, end = half_open(F.col("start"), F.col("end"), F.col("length"), F.col("circular") & (F.coalesce(F.col(wraps).cast("int"), F.lit(0)) == 1))
        return on.withColumn("_s", start).withColumn("end", end).withColumn("start", F.col("_s")).drop("_s")

    raw = _typed(tables.read_tsv(spark, f"{truth}/features.tsv"), start="long", end="long", total_reads="long")
    raw = raw if "wraps_origin" in raw.columns else raw.withColumn("wraps_origin", F.lit("0"))
    features = evaluation.with_expected(placed(raw, "wraps_origin"), mode, evil_max_diff)
    loci = placed(load_loci(spark, results["discovered"]), "wraps_origin")
    loci = loci.withColumnsRenamed({"locus_type": "kind", "total_count": "total", "annotation_class": "class"}).withColumn("rep_start", F.col("rep_start") - 1)
    judged = evaluation.judged_features(features, ref.genomes)
    rows = evaluation.outcomes(judged, loci)
    table = evaluation.outcome_table(rows, loci).join(judged.select("feature_id", "total_reads"), "feature_id")
    tables.write_tsv(table.sort("feature_id"), f"{out}/smallrnas.tsv", [*table.columns])
    wrong = evaluation.false_positives(features, loci).withColumn("start", F.col("start") + 1)
    tables.write_tsv(wrong.sort("locus_id"), f"{out}/false_positives.tsv", ["locus_id", "start", "end", "strand", "span", "total", "rep_sequence", "five_score", "class", "explained_by"])
    focus = judged.filter("sequence <> ''").select("feature_id", F.col("feature_id").alias("position"), "sequence")
    owned = planted.owners(c.reads.select("read_id", "sequence"), focus)
    cls = tables.read_tsv(spark, f"{results['assigned']}/origin.tsv").select("read_id", "class")
    by_origin = planted.reads_by_origin(owned, cls, c.counts, focus)
    tables.write_tsv(by_origin.sort("feature_id"), f"{out}/origin_by_feature.tsv", by_origin.columns)
    counts = evaluation.outcome_counts(rows).sort("category", "expected")
    tables.write_tsv(counts, f"{out}/outcomes.tsv", counts.columns)
    sums, lost = evaluation.rejected_reads(by_origin, cls, c.counts, rows)
    tables.write_tsv(lost.sort(F.desc("rejected"), "feature_id"), f"{out}/rejected.tsv", lost.columns)
    text = F.lit(f"Mode {mode}, tolerance {evil_max_diff}\n")
    one = evaluation.found_summary(table).select(F.concat(
        text, F.format_string("Planted small RNAs on focus genomes: %d, as expected: %d\n", "small_rnas", "as_expected"), F.format_string("With a locus: %d; representative is the planted sequence: %d of %d; starts at its 5' end: %d; over 10 bases longer: %d", "found", "canonical", "with_sequence", "exact_five", "embedded"),
    ).alias("value"))
    two = sums.select(F.format_string("Rejected reads: %d, of planted small RNAs: %d, others: %d", "rejected", "explained", "other").alias("value"))
    three = counts.select(F.concat_ws("\t", "category", F.col("features").cast("string"), "expected", "observed").alias("value"))
    four = wrong.agg(F.count(F.lit(1)).alias("n")).select(F.format_string("Passing loci without a planted small RNA: %d", "n").alias("value"))
    lines = [x.select(F.lit(k).alias("at"), "value") for k, x in enumerate((one, three, four, two))]
    every = lines[0]
    for x in lines[1:]:
        every = every.unionByName(x)
    every.repartition(1).sortWithinPartitions("at", "value").select("value").write.text(f"{out}/summary.txt")

