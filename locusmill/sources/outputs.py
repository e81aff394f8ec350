"""What each step writes: FASTA and tab-separated folders that the next step, or a report, reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusmill.functions.sequences import interval_text, number_text, with_overhang
from locusmill.operators.collapse import wide_counts
from locusmill.operators.reports import STAGES
from locusmill.operators.scoring import scored_order, scored_target_order, target_order
from locusmill.sources.sequences import write_fasta
from locusmill.sources.tables import write_tsv

REGION_COLUMNS = ["region_id", "transcript", "gene", "region", "length", "contig", "strand", "blocks", "sequence"]


def weight_text(w: Column, significant: int = 6) -> Column:
    """So many significant digits without closing zeros, with an exponent below 0.0001, as C's ``%.6g`` has it for weights up to 1."""
    digits = significant - 1 - F.floor(F.log10(w))
    scale = F.pow(F.lit(10.0), digits)
    # halves go to the even digit only where the number itself ends there, as sums of powers of two do
    whole = F.when(w * (1 << 30) == F.floor(w * (1 << 30)), F.bround(w * scale)).otherwise(F.round(w * scale))
    fixed = F.regexp_replace(F.format_string("%.10f", whole / scale), r"\.?0+$", "")
    small = F.regexp_replace(F.format_string(f"%.{significant - 1}e", w), r"\.?0+e", "e")
    return F.when(w < 1e-4, small).otherwise(fixed)


def write_collapsed(collapsed: DataFrame, counts: DataFrame, libraries: DataFrame, samples: list[str], folder: str) -> None:
    """``collapsed.fasta``, ``counts.tsv`` (a column for each sample) and ``libraries.tsv``, reads in the order of their ids."""
    rows = collapsed.sort("read_id")
    write_fasta(rows, f"{folder}/collapsed.fasta", "read_id", width=1_000_000)
    wide = collapsed.select("read_id", "sequence", "length").join(wide_counts(counts, samples), "sequence").sort("read_id")
    write_tsv(wide, f"{folder}/counts.tsv", ["read_id", "sequence", "length", *samples])
    write_tsv(libraries, f"{folder}/libraries.tsv", ["sample", "reads_in", "reads_kept"])


def origin_tables(origin: DataFrame, lengths: DataFrame, counts: DataFrame, samples: list[str]) -> tuple[DataFrame, DataFrame]:
    """Counts of samples by class and genomes, and by length too. ``lengths``: read_id, length; ``counts``: read_id, sample, n."""
    label = F.array_join(F.array_sort("genomes"), "+").alias("genomes")
    rows = origin.select("read_id", "class", label).join(lengths, "read_id").join(counts, "read_id")
    table = lambda *keys: rows.groupBy(*keys).pivot("sample", samples).agg(F.sum("n")).na.fill(0, samples).sort(*keys)
    return table("class", "genomes"), table("class", "genomes", "length")


def write_origin(placed: DataFrame, origin: DataFrame, lengths: DataFrame, counts: DataFrame, samples: list[str], folder: str) -> None:
    """``alignments.tsv``, ``origin.tsv``, ``origin_summary.tsv`` and ``origin_lengths.tsv`` of classified reads (operators.origin)."""
    write_tsv(placed.withColumn("weight", weight_text(F.col("weight"))), f"{folder}/alignments.tsv", ["read_id", "genome", "contig", "start", "end", "strand", "weight", "mismatches"])
    write_tsv(origin.withColumn("genomes", F.array_join(F.array_sort("genomes"), "+")), f"{folder}/origin.tsv", ["read_id", "class", "genomes"])
    summary, by_length = origin_tables(origin, lengths, counts, samples)
    write_tsv(summary, f"{folder}/origin_summary.tsv", ["class", "genomes", *samples])
    write_tsv(by_length, f"{folder}/origin_lengths.tsv", ["class", "genomes", "length", *samples])


def candidate_lines(loci: DataFrame) -> DataFrame:
    """value: name, place and counts, then the representative's sequence, of each locus that passes."""
    place = F.concat("genome", F.lit("|"), interval_text(F.col("contig"), F.col("rep_start"), F.col("rep_end"), F.col("strand")))
    facts = [F.concat(F.lit("locus="), "start", F.lit("-"), "end"), F.concat(F.lit("count="), "total_count"), F.concat(F.lit("class="), "annotation_class")]
    return loci.filter("pass").select(F.concat(F.lit(">"), F.concat_ws(" ", "locus_id", place, *facts), F.lit("\n"), "rep_sequence").alias("value"))


def write_candidates(loci: DataFrame, path: str) -> None:
    """Loci that pass, in the order of their ids. Positions are written as they stand in the table, which counts from 1 (``one_based``)."""
    candidate_lines(loci.sort("locus_id")).write.text(path)


def blocks_text(blocks: Column) -> Column:
    """Half-open blocks as ``1-10,21-30``."""
    return F.array_join(F.transform(blocks, lambda b: F.concat_ws("-", (b["s"] + 1).cast("string"), b["e"].cast("string"))), ",")


def parsed_blocks(text: Column) -> Column:
    """``blocks_text`` read back; an empty text has no blocks."""
    some = F.filter(F.split(text, ","), lambda x: x != "")
    return F.transform(some, lambda x: F.struct((F.split_part(x, F.lit("-"), F.lit(1)).cast("long") - 1).alias("s"), F.split_part(x, F.lit("-"), F.lit(2)).cast("long").alias("e")))


def write_regions(regions: DataFrame, path: str) -> None:
    write_tsv(regions.withColumn("length", F.char_length("sequence")).withColumn("blocks", blocks_text(F.col("blocks"))), path, REGION_COLUMNS)


def regions_of_table(rows: DataFrame) -> DataFrame:
    """The regions that ``write_regions`` wrote (``read_tsv``), blocks half-open again."""
    return rows.withColumn("length", F.col("length").cast("int")).withColumn("blocks", parsed_blocks(F.col("blocks"))).select(*REGION_COLUMNS)


def raw_reads(reports: DataFrame) -> DataFrame:
    """sample, raw, version of trimming reports (``sample``, and ``value``: the report's JSON)."""
    at = lambda path: F.get_json_object("value", path)
    raw = at("$.read1_before_filtering.total_reads").cast("long")
    missing = F.raise_error(F.concat(F.lit("no count of raw reads in the report of "), "sample"))
    return reports.select("sample", F.when(raw.isNull(), missing.cast("long")).otherwise(raw).alias("raw"), F.coalesce(at("$.summary.fastp_version"), F.lit("unknown")).alias("version"))


# Columns of the tables that the later steps write.
LOCUS_COLUMNS = [
    "locus_id", "genome", "contig", "start", "end", "strand", "span", "wraps_origin", "locus_type", "rep_id", "rep_sequence", "rep_length", "rep_start", "rep_end", "unique_reads", "total_count", "background_count",
    "samples_passing_rpm", "five_score", "five_dominant_fraction", "five_jitter_fraction", "three_score", "three_dominant_fraction", "isolation", "annotation_class", "annotation_types", "annotation_names",
    "annotation_orientation", "expression_pass", "ends_pass", "pass",
]
READ_COLUMNS = ["locus_id", "read_id", "sequence", "start", "end", "weight", "count"]
SITE_COLUMNS = ["candidate", "region_id", "transcript", "gene", "region", "site_class", "site_start", "site_end", "genomic", "dist_5p", "dist_3p", "au_flanks", "supp_pairing", "near_stop", "class_fdr"]
FDR_COLUMNS = ["candidate", "site_class", "real_sites", "decoy_mean", "decoy_sd", "enrichment", "fdr"]
CURVE_COLUMNS = ["predictor", "score", "site_class", "threshold", "real_sites", "decoy_sites", "expected_false", "fdr"]
PRECURSOR_COLUMNS = [
    "candidate", "genome", "contig", "strand", "candidate_start", "candidate_end", "window", "window_start", "window_end", "wraps_origin", "clipped", "length", "candidate_from", "candidate_to", "sequence", "structure",
    "mfe", "amfe", "gc", "mfei", "shuffles", "pvalue", "hairpin_loops", "stem_pairs", "stem_fraction", "single_hairpin", "in_arm", "arm", "paired_fraction", "best",
]


def write_reference(contigs: DataFrame, genomes: DataFrame, overhang: int, folder: str) -> None:
    """``reference.fasta``, circular contigs with their first ``overhang`` bases once more at the end, ``contigs.tsv`` and ``genomes.tsv``. ``contigs``: ref, genome, contig, sequence, circular."""
    rows = contigs.withColumn("sequence", F.upper("sequence"))
    write_fasta(rows.select(F.col("ref").alias("name"), with_overhang(F.col("sequence"), F.col("circular"), overhang).alias("sequence")), f"{folder}/reference.fasta")
    write_tsv(rows.withColumn("length", F.char_length("sequence")), f"{folder}/contigs.tsv", ["ref", "genome", "contig", "length", "circular"])
    write_tsv(genomes, f"{folder}/genomes.tsv", ["name", "fasta", "role", "circular", "annotation", "min_length", "max_length", "targets"])


def write_discovery(loci: DataFrame, reads: DataFrame, samples: list[str], folder: str) -> None:
    """``loci.tsv``, in the order of ids, ``locus_reads.tsv`` and ``candidates.fasta`` of loci (``discovery.with_samples``, rep_sequence) and their reads (with sequence)."""
    columns = LOCUS_COLUMNS + [f"{c}_{s}" for c in ("count", "rpm", "rpm_genome") for s in samples]
    write_tsv(loci.withColumn("rep_length", F.char_length("rep_sequence")).sort("locus_id"), f"{folder}/loci.tsv", columns)
    write_tsv(reads.sort("locus_id", "read_id", "start"), f"{folder}/locus_reads.tsv", READ_COLUMNS)
    write_candidates(loci, f"{folder}/candidates.fasta")


def _named_counts(rows: DataFrame, classes: tuple[str, ...]) -> DataFrame:
    return rows.withColumnsRenamed({"n_" + c.replace("-", "_"): f"n_{c}" for c in classes})


def fdr_text(fdr: DataFrame) -> DataFrame:
    """``significance.site_count_fdr`` as it is written: means to three digits, rates to four."""
    return fdr.withColumns({**{c: F.bround(c, 3) for c in ("decoy_mean", "decoy_sd", "enrichment")}, "fdr": F.bround("fdr", 4)})


def write_sites(sites: DataFrame, targets: DataFrame, fdr: DataFrame, classes: tuple[str, ...], folder: str) -> None:
    """``sites.tsv``, ``targets.tsv``, in the order of candidates, classes and falling numbers of sites, and ``fdr.tsv``."""
    write_tsv(sites, f"{folder}/sites.tsv", SITE_COLUMNS)
    write_tsv(_named_counts(targets, classes).sort(*target_order()), f"{folder}/targets.tsv", ["candidate", "transcript", "gene", "sites", "best_class", "best_class_fdr", *[f"n_{c}" for c in classes]])
    write_tsv(fdr_text(fdr), f"{folder}/fdr.tsv", FDR_COLUMNS)


def write_scored(sites: DataFrame, targets: DataFrame, decoys: DataFrame, curves: DataFrame, predictors: list[tuple[str, str, list[str]]], classes: tuple[str, ...], folder: str) -> None:
    """``scored_sites.tsv``, ``scored_targets.tsv``, ``decoy_scores.tsv`` and ``curves.tsv``. ``predictors``: name, ranked column, columns of each, the z among them."""
    own = [c for _, _, columns in predictors for c in columns]
    q = [c for name, _, _ in predictors for c in (f"{name}_q", f"{name}_q_candidate")]
    first = predictors[0][1] if predictors else None
    write_tsv(sites.sort(*(scored_order(first) if first else [F.col("candidate")])), f"{folder}/scored_sites.tsv", [*SITE_COLUMNS, *own, *q, "support"])
    best = [c for name, ranked, _ in predictors for c in (f"best_{ranked}", f"best_{name}_q")]
    write_tsv(_named_counts(targets, classes).sort(*scored_target_order()), f"{folder}/scored_targets.tsv", ["candidate", "transcript", "gene", "sites", "best_class", *[f"n_{c}" for c in classes], *best, "max_support", "sites_supported"])
    write_tsv(decoys, f"{folder}/decoy_scores.tsv", ["decoy", "candidate", "region_sequence", "site_class", "site_start", *own])
    write_tsv(curves, f"{folder}/curves.tsv", CURVE_COLUMNS)


def coverage_rows(runs: DataFrame, fives: DataFrame, samples: list[str]) -> DataFrame:
    """A row for each covered position, from 1: runs of ``intervals.sample_runs`` spread out, with the 5' ends (genome, contig, strand, position, five_ends) that lie there."""
    keys = ["genome", "contig", "strand"]
    rows = runs.select("*", F.explode(F.sequence(F.col("start") + 1, F.col("end"))).alias("position")).join(fives, [*keys, "position"], "left")
    depths = ["depth", "five_ends", *[f"depth_{s}" for s in samples]]
    return rows.withColumn("five_ends", F.coalesce("five_ends", F.lit(0.0))).select(*keys, "position", *[F.bround(c, 3).alias(c) for c in depths])


def write_coverage(rows: DataFrame, samples: list[str], path: str) -> None:
    """Covered positions along the contigs, one strand after the other."""
    write_tsv(rows.sort("genome", "contig", "strand", "position"), path, ["genome", "contig", "position", "strand", "depth", "five_ends", *[f"depth_{s}" for s in samples]])


def _table_lines(head: list[str], first: str, rows: DataFrame, names: list[str]) -> DataFrame:
    """value, in order: header lines, the names of the columns, a line a row of ``rows`` (order, then a column for each name)."""
    spark = rows.sparkSession
    top = spark.createDataFrame([(-1, k, line) for k, line in enumerate([*head, "\t".join([first, *names])])], "part int, at long, value string")
    body = rows.select(F.lit(0).alias("part"), F.col("order").cast("long").alias("at"), F.concat_ws("\t", "sample", *[number_text(F.col(f"`{n}`")) for n in names]).alias("value"))
    return top.unionByName(body).repartition(1).sortWithinPartitions("part", "at").select("value")


def funnel_lines(funnel: DataFrame, samples: list[str]) -> DataFrame:
    """``reports.funnel`` as custom content of a report collector: a line a sample, a column a stage."""
    order = F.array_position(F.array(*map(F.lit, samples)), F.col("sample")).alias("order")
    wide = funnel.filter(F.col("sample").isin(samples)).groupBy("sample").pivot("label", list(STAGES.values())).agg(F.first("reads")).na.fill(0)
    head = ["# id: 'locusmill_funnel'", "# section_name: 'Read funnel'", "# description: 'Reads left after each step (fractional where reads are shared among alignments).'", "# plot_type: 'table'"]
    return _table_lines(head, "Sample", wide.select(order, "*"), list(STAGES.values()))


def origin_lines(summary: DataFrame, samples: list[str]) -> DataFrame:
    """``origin_summary`` (class, genomes, sample, reads) as a stacked bar for each sample. Classes and genomes are few and pass the driver as column names."""
    label = F.when(F.col("genomes") == "", F.col("class")).otherwise(F.concat("class", F.lit(" ("), "genomes", F.lit(")")))
    rows = summary.withColumn("label", label)
    names = [r[0] for r in rows.select("label").distinct().sort("label").collect()]
    frame = summary.sparkSession.createDataFrame([(k, s) for k, s in enumerate(samples)], "order int, sample string")
    wide = frame.join(rows.groupBy("sample").pivot("label", names).agg(F.sum("reads")), "sample", "left").na.fill(0)
    head = ["# id: 'locusmill_origin'", "# section_name: 'Read origin'", "# description: 'Genome of origin of the reads in the length range.'", "# plot_type: 'bargraph'", "# pconfig:", "#     id: 'locusmill_origin_plot'", "#     title: 'Read origin'", "#     ylab: 'Reads'"]
    return _table_lines(head, "Sample", wide, names)


def write_precursors(rows: DataFrame, path: str) -> None:
    """Windows of candidates (columns of PRECURSOR_COLUMNS, numbers as numbers), energies to two digits; what can't be told is ``NA``."""
    digits = {"mfe": "%.2f", "amfe": "%.2f", "gc": "%.1f", "mfei": "%.3f", "stem_fraction": "%.3f", "paired_fraction": "%.3f"}
    text = {c: F.coalesce(F.format_string(f, c), F.lit("NA")) for c, f in digits.items()}
    text = {c: F.when(F.col(c).isNull(), "NA").otherwise(x) for c, x in text.items()}
    write_tsv(rows.withColumns(text).withColumn("pvalue", F.when(F.col("pvalue").isNull(), "NA").otherwise(weight_text(F.col("pvalue"), 4))), path, PRECURSOR_COLUMNS)
