"""Transcript regions: coding and untranslated parts, spliced from the genome or cut from transcripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusmill.functions.sequences import interval_text, reverse_complement
from locusmill.operators.stretches import SHORT, cut, pieces
from locusmill.sources.tables import attribute

BLOCKS = "array<struct<s:bigint,e:bigint>>"


def merged(blocks: Column) -> Column:
    """Sorted blocks, overlapping and touching ones joined."""
    empty = F.array().cast(BLOCKS)
    last = lambda a: F.element_at(a, -1)
    return F.aggregate(
        F.array_sort(blocks),
        empty,
        lambda a, b: F.when(F.size(a) == 0, F.array(b)).when(
            b["s"] <= last(a)["e"], F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(last(a)["s"].alias("s"), F.greatest(last(a)["e"], b["e"]).alias("e"))))
        ).otherwise(F.array_append(a, b)),
    )


def transcripts(records: DataFrame) -> DataFrame:
    """transcript, gene, contig, strand, exons (merged), cds (sorted) of GFF3 records (``parse_gff``).

    Children of several parents belong to each; exons are the exon features, or coding and untranslated parts where there are none; transcripts without
    either are dropped. The gene is its Name, else its id, else the transcript's parent, Name or id.
    """
    r = records.select("*", attribute("attributes", "ID").alias("id"), attribute("attributes", "Name").alias("name"), attribute("attributes", "Parent").alias("parents"))
    genes = r.filter("type = 'gene'").select(F.col("id").alias("parent"), F.coalesce("name", "id").alias("gene_name"))
    rna = r.filter("type IN ('mRNA', 'transcript')").select(F.col("id").alias("transcript"), "contig", "strand", F.split("parents", ",")[0].alias("parent"), F.col("name").alias("own"))
    parts = r.filter("type IN ('exon', 'CDS', 'five_prime_UTR', 'three_prime_UTR', 'UTR')").select("type", "start", "end", F.explode(F.split("parents", ",")).alias("transcript"))
    block = F.struct(F.col("start").alias("s"), F.col("end").alias("e"))
    parts = parts.groupBy("transcript").agg(F.collect_list(F.when(F.col("type") == "exon", block)).alias("x"), F.collect_list(F.when(F.col("type") == "CDS", block)).alias("c"), F.collect_list(F.when(F.col("type") != "exon", block)).alias("o"))
    rows = rna.join(parts, "transcript").join(genes, "parent", "left")
    exons = F.when(F.size("x") > 0, merged(F.col("x"))).otherwise(merged(F.col("o")))
    rows = rows.select("transcript", F.coalesce("gene_name", "parent", "own", "transcript").alias("gene"), "contig", "strand", exons.alias("exons"), F.array_sort("c").alias("cds"))
    return rows.filter(F.size("exons") > 0)


def to_transcript(position: Column, blocks: Column, strand: Column) -> Column:
    """A genome position in a transcript's coordinates, null outside of its exons."""
    total = F.aggregate(blocks, F.lit(0).cast("bigint"), lambda a, b: a + b["e"] - b["s"])
    before = F.aggregate(F.filter(blocks, lambda b: b["e"] <= position), F.lit(0).cast("bigint"), lambda a, b: a + b["e"] - b["s"])
    inside = F.get(F.filter(blocks, lambda b: (b["s"] <= position) & (position < b["e"])), 0)
    forward = before + position - inside["s"]
    return F.when(strand == "+", forward).otherwise(total - 1 - forward)


def blocks_of(exons: Column, strand: Column, start: Column, end: Column) -> Column:
    """The genome's blocks, in a transcript's order, of [start, end) in the transcript's coordinates; ``exons`` are merged and ascend."""
    ordered = F.when(strand == "+", exons).otherwise(F.reverse(exons))
    size = lambda b: b["e"] - b["s"]
    none = F.array().cast("array<struct<s:bigint,e:bigint,o:bigint>>")
    laid = F.aggregate(
        ordered,
        F.struct(F.lit(0).cast("bigint").alias("n"), none.alias("x")),
        lambda a, b: F.struct((a["n"] + size(b)).alias("n"), F.array_append(a["x"], F.struct(b["s"].alias("s"), b["e"].alias("e"), a["n"].alias("o"))).alias("x")),
        lambda a: a["x"],
    )
    def piece(b):
        a, z = F.greatest(start, b["o"]) - b["o"], F.least(end, b["o"] + size(b)) - b["o"]
        forward = F.struct((b["s"] + a).alias("s"), (b["s"] + z).alias("e"))
        return F.when(strand == "+", forward).otherwise(F.struct((b["e"] - z).alias("s"), (b["e"] - a).alias("e")))

    return F.filter(F.transform(laid, piece), lambda b: b["s"] < b["e"])


def to_genome(position: Column, blocks: Column, strand: Column) -> Column:
    """The genome position of a region's base, both from 0, by the region's blocks; null beyond them."""
    left = position.cast("bigint")
    found = F.aggregate(
        blocks,
        F.struct(left.alias("left"), F.lit(None).cast("bigint").alias("at")),
        lambda a, b: F.struct((a["left"] - b["e"] + b["s"]).alias("left"), F.when(a["at"].isNull() & (a["left"] >= 0) & (a["left"] < b["e"] - b["s"]), F.when(strand == "+", b["s"] + a["left"]).otherwise(b["e"] - 1 - a["left"])).otherwise(a["at"]).alias("at")),
    )
    return found["at"]


def genomic(contig: Column, strand: Column, blocks: Column, start: Column, end: Column) -> Column:
    """Where [start, end) of a region lies on the genome, over its junctions, as ``chr:10-17(+)``; empty where the region has no such blocks."""
    a, z = to_genome(start, blocks, strand), to_genome(end - 1, blocks, strand)
    return F.coalesce(interval_text(contig, F.least(a, z) + 1, F.greatest(a, z) + 1, F.when(a.isNotNull() & z.isNotNull(), strand)), F.lit(""))


def regions(found: DataFrame, contigs: DataFrame, wanted: tuple[str, ...] = ("three_prime_UTR",), whole_if_missing: bool = False) -> DataFrame:
    """region_id, transcript, gene, region, contig, strand, sequence, blocks of ``transcripts``; ``contigs``: contig, sequence.

    The coding span runs from the first to the last coding base; coding pieces that start outside of the exons don't count, a last base outside of them is an error. A
    transcript without any wanted part is given whole if asked for. ``blocks`` are the genome's, in the transcript's order. Exons are cut from pieces of the contigs.
    """
    exons = found.select("transcript", "contig", F.posexplode("exons").alias("part", "x")).select("transcript", "contig", "part", F.col("x.s").alias("start"), F.col("x.e").alias("end"))
    lines = cut(exons, pieces(contigs, "contig"), ["transcript", "contig"], "contig")
    rows = found.join(lines, ["transcript", "contig"]).withColumn("line", F.upper("sequence"))
    held = merged(F.filter("cds", lambda c: F.exists(F.col("exons"), lambda x: (x["s"] <= c["s"]) & (c["s"] < x["e"]))))
    rows = rows.withColumn("cds", held)
    rows = rows.withColumn("line", F.when(F.col("strand") == "+", F.col("line")).otherwise(reverse_complement(F.col("line"))))
    first, last = F.get("cds", 0)["s"], F.get("cds", F.size("cds") - 1)["e"] - 1
    a, z = (to_transcript(p, F.col("exons"), F.col("strand")) for p in (first, last))
    outside = F.raise_error(F.format_string("the coding part of transcript %s ends outside of its exons", "transcript")).cast("bigint")
    z = F.when((F.size("cds") > 0) & z.isNull(), outside).otherwise(z)
    rows = rows.withColumn("from", F.least(a, z)).withColumn("to", F.greatest(a, z) + 1)
    n = F.char_length("line")
    part = lambda name, s, e: F.struct(F.lit(name).alias("region"), F.substring("line", (s + 1).cast("int"), (e - s).cast("int")).alias("sequence"), blocks_of(F.col("exons"), F.col("strand"), s, e).alias("blocks"))
    parts = {"five_prime_UTR": part("five_prime_UTR", F.lit(0), F.col("from")), "CDS": part("CDS", F.col("from"), F.col("to")), "three_prime_UTR": part("three_prime_UTR", F.col("to"), n), "transcript": part("transcript", F.lit(0), n)}
    chosen = F.filter(F.array(*[parts[w] for w in wanted]), lambda p: F.coalesce(F.char_length(p["sequence"]), F.lit(0)) > 0)
    if whole_if_missing and "transcript" not in wanted:
        chosen = F.when(F.size(chosen) > 0, chosen).otherwise(F.array(parts["transcript"]))
    rows = rows.withColumn("p", F.explode(chosen))
    return rows.select(F.concat_ws("|", "transcript", "p.region").alias("region_id"), "transcript", "gene", "p.region", "contig", "strand", "p.sequence", "p.blocks")


def transcript_regions(transcripts: DataFrame, table: DataFrame | None = None, wanted: tuple[str, ...] = (), whole_if_missing: bool = False) -> DataFrame:
    """region_id, transcript, gene, region, sequence of transcripts (name, sequence; U becomes T).

    Without a table each transcript is one region of that name. ``table``: transcript, region, start, end (from 1, both included) and, if it
    likes, gene; its wanted regions (all without names) are cut out. One that lies outside of its transcript is an error. A transcript without any is given whole if asked for.
    """
    rows = transcripts.select(F.col("name").alias("transcript"), F.translate(F.upper("sequence"), "U", "T").alias("line"))
    named = lambda df, region, gene, sequence: df.select(F.concat_ws("|", "transcript", region).alias("region_id"), "transcript", gene.alias("gene"), region.alias("region"), sequence.alias("sequence"))
    whole = lambda df: named(df, F.lit("transcript"), F.col("transcript"), F.col("line"))
    if table is None:
        return whole(rows)
    gene = F.nullif(F.col("gene"), F.lit("")) if "gene" in table.columns else F.lit(None).cast("string")
    parts = table.select("transcript", "region", (F.col("start").cast("long") - 1).alias("from"), F.col("end").cast("long").alias("to"), gene.alias("_gene"))
    if wanted:
        parts = parts.filter(F.col("region").isin(*wanted))
    # lengths go to the regions, and bases come from the pieces that a region touches: no row holds a whole transcript; equal rows are cut once
    parts = parts.groupBy(*parts.columns).agg(F.count(F.lit(1)).alias("_times")).join(rows.select("transcript", F.char_length("line").alias("_n")), "transcript")
    held = (F.col("from") >= 0) & (F.col("from") < F.col("to")) & (F.col("to") <= F.col("_n"))
    outside = F.raise_error(F.format_string("region %s %s-%s lies outside of transcript %s", "region", F.col("from") + 1, "to", "transcript")).cast("bigint")
    parts = parts.withColumn("start", F.when(F.coalesce(held, F.lit(False)), F.col("from")).otherwise(outside))
    spans = parts.select("transcript", "region", "_gene", "_times", "start", F.col("to").alias("end"), F.lit(0).alias("part"))
    spans = spans.withColumn("_row", F.struct("region", "start", "end", "_gene", "_times"))
    found = cut(spans.select("transcript", "_row", "start", "end", "part"), pieces(rows.select("transcript", F.col("line").alias("sequence")), "transcript", SHORT).hint("merge"), ["transcript", "_row"], "transcript", SHORT)
    found = found.select("transcript", "_row.region", "_row._gene", "sequence", F.explode(F.sequence(F.lit(1), F.col("_row._times").cast("int"))).alias("_time"))
    out = named(found, F.col("region"), F.coalesce("_gene", "transcript"), F.col("sequence"))
    return out.unionByName(whole(rows.join(parts.select("transcript").distinct(), "transcript", "left_anti"))) if whole_if_missing else out
