"""Registered queries of what steps hand on: parsers and texts of formats, orders of tables, and results held against planted ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusmill.functions import circular as circ
from locusmill.functions import sequences as seq
from locusmill.operators import discovery, evaluation, intervals, planted, regions, reports, scoring, seeds
from locusmill.plans import views as v
from locusmill.plans.queries import CLASS_COUNTS, POOLED, QUERIES, SITES, SQL, _best_ctes, query, with_
from locusmill.sources import outputs, tables

__all__ = ["QUERIES", "SQL"]


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _of(names: tuple[str, ...], k: Column) -> Column:
    return F.get(F.array(*map(F.lit, names)), k.cast("int"))


# --- formats --------------------------------------------------------------------------------------


@query(
    "sc8_sam_records",
    """SELECT 'r' || l_orderkey || '.' || l_linenumber AS read_id, 'g|c' || (l_suppkey % 3) AS ref, CAST(l_partkey AS BIGINT) AS "start", CAST(l_partkey + 12 + q % 10 + 1 + q % 4 AS BIGINT) AS "end", CASE WHEN l_linenumber % 3 = 1 THEN '-' ELSE '+' END AS strand,
 CASE WHEN l_partkey % 2 = 0 THEN CAST(q % 4 AS INTEGER) ELSE 0 END AS mismatches FROM (SELECT *, CAST(l_quantity AS INTEGER) AS q FROM lineitem) WHERE l_linenumber % 3 < 2""",
)
def _(spark, d):
    r = v.load(spark, d, "lineitem").withColumn("q", F.col("l_quantity").cast("int"))
    flag = F.when(F.col("l_linenumber") % 3 == 2, "4").otherwise(F.when(F.col("l_linenumber") % 3 == 1, "16").otherwise("0"))
    cigar = _text(5 + F.col("q") % 10, "M2I", 1 + F.col("q") % 4, "D3S4N3=")
    fields = [_text("r", F.col("l_orderkey"), ".", F.col("l_linenumber")), flag, _text("g|c", F.col("l_suppkey") % 3), (F.col("l_partkey") + 1).cast("string"), F.lit("255"), cigar, *[F.lit(x) for x in ("*", "0", "0", "ACGT", "IIII", "XA:i:0")]]
    tag = F.when(F.col("l_partkey") % 2 == 0, _text("\tNM:i:", F.col("q") % 4)).otherwise("")
    lines = r.select(F.concat(F.concat_ws("\t", *fields), tag).alias("value"))
    head = v.load(spark, d, "region").select(_text("@SQ\tSN:", F.col("r_name")).alias("value"))
    return tables.parse_sam(lines.unionByName(head))


GFF_TYPES = ("gene", "region", "tRNA", "contig", "exon")


@query(
    "sc10_flat_features",
    """SELECT 'x' AS genome, 'c' || (p_size % 4) AS contig, CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand, CAST(p_partkey * 10 AS BIGINT) AS "start", CAST(p_partkey * 10 + p_size AS BIGINT) AS "end", ['gene', 'region', 'tRNA', 'contig', 'exon'][p_partkey % 5 + 1] AS type,
 CASE p_partkey % 4 WHEN 0 THEN 'a b;+' || p_partkey WHEN 1 THEN 'g' || p_partkey WHEN 2 THEN 'i' || p_partkey ELSE '.' END AS name FROM part WHERE p_partkey % 5 NOT IN (1, 3) AND p_partkey < 100 + 400 * (p_partkey % 3)""",
)
def _(spark, d):
    p, k = v.load(spark, d, "part"), F.col("p_partkey")
    names = F.when(k % 4 == 0, _text("ID=i", k, ";gene=g;Name=a%20b%3B+", k)).when(k % 4 == 1, _text("gene=g", k, "; ID=i", k, ";")).when(k % 4 == 2, _text("Parent=x;ID=i", k)).otherwise("Parent=x;Alias=y")
    line = F.concat_ws("\t", _text("c", F.col("p_size") % 4), F.lit("src"), _of(GFF_TYPES, k % 5), (k * 10 + 1).cast("string"), (k * 10 + F.col("p_size")).cast("string"), F.lit("."), F.when(F.col("p_size") % 2 == 0, "+").otherwise("-"), F.lit("."), names)
    at = lambda row: F.struct(F.lit(0).alias("part"), row.cast("long").alias("row")).alias("line")
    # three files: each ends for the reader where its sequences begin
    lines = p.select(line.alias("value"), (k % 3).cast("string").alias("file"), at(2 * k))
    stops = spark.range(3).select(F.lit("##FASTA").alias("value"), F.col("id").cast("string").alias("file"), at(2 * (100 + 400 * F.col("id")) - 1))
    notes = p.select(F.lit("# a note\twith\ttabs").alias("value"), F.lit("0").alias("file"), at(2 * k + 1))
    return tables.features(tables.parse_gff(lines.unionByName(stops).unionByName(notes)), "x")


@query(
    "jn9_transcripts",
    with_(v.TRANSCRIPTS.split(",\nline AS")[0], then="""SELECT 't' || t AS transcript, CASE t % 3 WHEN 0 THEN 'name' || (t % 7) WHEN 1 THEN 'g' || (t % 7) ELSE 'gone' END AS gene, contig, strand, string_agg((s + 1) || '-' || e, ',' ORDER BY s) AS exons,
 CASE WHEN t % 4 = 0 THEN '' ELSE string_agg((s + 1 + CASE WHEN k = 0 THEN 5 ELSE 0 END) || '-' || (e - CASE WHEN k = 2 + t % 3 THEN 7 ELSE 0 END), ',' ORDER BY s) END AS cds FROM ex GROUP BY t, contig, strand"""),
)
def _(spark, d):
    t = v.transcripts(spark, d).withColumn("k", F.substring("transcript", 2, 20).cast("int"))
    record = lambda df, type_, start, end, attributes: df.select("contig", F.lit(type_).alias("type"), start.cast("long").alias("start"), end.cast("long").alias("end"), "strand", attributes.alias("attributes"))
    gene = F.when(F.col("k") % 3 == 2, "gone").otherwise(_text("g", F.col("k") % 7, "-", F.col("k")))
    genes = record(t.filter("k % 3 < 2"), "gene", F.lit(0), F.lit(9), F.concat(_text("ID=", gene), F.when(F.col("k") % 3 == 0, _text(";Name=name", F.col("k") % 7)).otherwise("")))
    rna = record(t, "mRNA", F.lit(0), F.lit(9), _text("Parent=", gene, ";ID=", F.col("transcript"), ";Name=own"))
    part = lambda column, type_: record(t.select("contig", "strand", "transcript", F.explode(column).alias("x")), type_, F.col("x.s"), F.col("x.e"), _text("Parent=", F.col("transcript"), ",stray"))
    records = genes.unionByName(rna).unionByName(part("exons", "exon")).unionByName(part("cds", "CDS"))
    found = regions.transcripts(records)
    return found.select("transcript", F.regexp_replace("gene", "^(g\\d+)-\\d+$", "$1").alias("gene"), "contig", "strand", outputs.blocks_text(F.col("exons")).alias("exons"), outputs.blocks_text(F.col("cds")).alias("cds"))


@query("sc6_long_counts", "SELECT 'u' || o_orderkey AS read_id, s AS sample, n FROM (SELECT o_orderkey, unnest(['a', 'b', 'c']) AS s, CAST(unnest([o_custkey % 3, o_custkey % 5, o_orderkey % 2]) AS DOUBLE) AS n FROM orders) WHERE n > 0")
def _(spark, d):
    c, k = F.col("o_custkey"), F.col("o_orderkey")
    wide = v.load(spark, d, "orders").select(_text("u", k).alias("read_id"), F.lit("ACGT").alias("sequence"), F.lit("4").alias("length"), (c % 3).cast("string").alias("a"), (c % 5).cast("string").alias("b"), (k % 2).cast("string").alias("c"))
    return tables.long_counts(wide, "read_id")


@query("sk4_weight_texts", "SELECT l_orderkey, l_linenumber, format('{:.6g}', 1.0::DOUBLE / ((1 + l_partkey) * l_linenumber)) AS weight, format('{:.4g}', 1.0::DOUBLE / (1 + l_partkey)) AS short FROM lineitem")
def _(spark, d):
    w = lambda x: F.lit(1.0) / x
    return v.load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", outputs.weight_text(w((1 + F.col("l_partkey")) * F.col("l_linenumber"))).alias("weight"), outputs.weight_text(w(1 + F.col("l_partkey")), 4).alias("short"))


@query("sc15_blocks_read", with_(v.TRANSCRIPTS.split(",\nline AS")[0], then='SELECT \'t\' || t AS transcript, CAST(s AS BIGINT) AS "start", CAST(e AS BIGINT) AS "end" FROM ex'))
def _(spark, d):
    rows = v.transcripts(spark, d).select("transcript", outputs.blocks_text(F.col("exons")).alias("blocks"))
    back = rows.select("transcript", F.explode(outputs.parsed_blocks(F.col("blocks"))).alias("b"))
    return back.select("transcript", F.col("b.s").alias("start"), F.col("b.e").alias("end"))


@query("fn15_intervals", with_(v.FEATURES, then="""SELECT genome || ':' || contig || ':' || s || '-' || e || CASE WHEN strand = '.' THEN '' ELSE '(' || strand || ')' END AS text, genome || ':' || contig AS contig, s AS "start", e AS "end", CASE WHEN strand <> '.' THEN strand END AS strand FROM features"""))
def _(spark, d):
    f = v.features(spark, d)
    whole = seq.interval_text(F.concat_ws(":", "genome", "contig"), F.col("start"), F.col("end"), F.col("strand"))
    text = F.when(F.col("strand") == ".", F.regexp_replace(whole, r"\(.\)$", "")).otherwise(whole)
    return f.select(text.alias("text")).select("text", seq.parsed_interval(F.col("text")).alias("i")).select("text", "i.*")


@query("fn18_numbers", "SELECT o_orderkey, CASE WHEN x = floor(x) THEN CAST(CAST(x AS BIGINT) AS VARCHAR) ELSE CAST(round_even(x, 1) AS VARCHAR) END AS t FROM (SELECT o_orderkey, o_custkey / 4.0::DOUBLE AS x FROM orders)")
def _(spark, d):
    return v.load(spark, d, "orders").select("o_orderkey", seq.number_text(F.col("o_custkey") / F.lit(4.0)).alias("t"))


@query("fn5_folding_indices", f"SELECT doc_id, round(-100 * m / length(s), 6) AS amfe, round(-100 * m / length(s) / nullif(100.0::DOUBLE * (length(s) - length(translate(s, 'GCgc', ''))) / length(s), 0), 6) AS mfei FROM (SELECT doc_id, substr({v._sql_sequence('doc_id')}, 1, CAST(1 + doc_id % 9 AS BIGINT)) AS s, -(doc_id % 500) / 8.0::DOUBLE AS m FROM documents)")
def _(spark, d):
    k = F.col("doc_id")
    rows = v.load(spark, d, "documents").select("doc_id", F.substring(v.sequence_of(k), F.lit(1), (1 + k % 9).cast("int")).alias("s"), (-(k % 500) / F.lit(8.0)).alias("m"))
    amfe, mfei = seq.folding_indices(F.col("m"), F.col("s"))
    return rows.select("doc_id", F.round(amfe, 6).alias("amfe"), F.round(mfei, 6).alias("mfei"))


@query("pf4_within_lengths", with_(v.MEMBERS, then="""SELECT genome, read_id, s AS "start", e AS "end", length FROM (SELECT *, CAST(e - s AS BIGINT) AS length FROM members) WHERE length BETWEEN 20 + CAST(substr(genome, 2) AS INTEGER) AND 26 + 2 * CAST(substr(genome, 2) AS INTEGER)"""))
def _(spark, d):
    k = F.col("id")
    genomes = spark.range(3).select(_text("g", k).alias("genome"), (20 + k).alias("min_length"), (26 + 2 * k).alias("max_length"))
    rows = v.members(spark, d).withColumn("sequence", F.repeat(F.lit("A"), (F.col("end") - F.col("start")).cast("int")))
    return discovery.within_lengths(rows, genomes).select("genome", "read_id", "start", "end", F.char_length("sequence").cast("long").alias("length"))


@query(
    "pf13_one_based",
    SQL["wn2_circular_merge"][: SQL["wn2_circular_merge"].rindex("SELECT genome, contig, strand, s AS")] + ', merged AS (' + SQL["wn2_circular_merge"][SQL["wn2_circular_merge"].rindex("SELECT genome, contig, strand, s AS") :]
    + """) SELECT genome, contig, strand, "start" + 1 AS first, CASE WHEN "end" > length THEN "end" - length ELSE "end" END AS last, "end" > length AS wraps_origin, "start" AS back_start, "end" AS back_end FROM merged JOIN contigs USING (genome, contig)""",
)
def _(spark, d):
    c = v.contigs(spark, d)
    rows = intervals.circular_merge(intervals.merge(v.members(spark, d), gap=10), c, gap=10).join(c.select("genome", "contig", "length"), ["genome", "contig"])
    first, last, wraps = circ.one_based(F.col("start"), F.col("end"), F.col("length"))
    rows = rows.select("genome", "contig", "strand", "length", first.alias("first"), last.alias("last"), wraps.alias("wraps_origin"))
    start, end = circ.half_open(F.col("first"), F.col("last"), F.col("length"), F.col("wraps_origin"))
    return rows.select("genome", "contig", "strand", "first", "last", "wraps_origin", start.alias("back_start"), end.alias("back_end"))


@query(
    "fn12_checked_intervals",
    "SELECT l_orderkey, l_linenumber, a - 1 AS \"start\", CASE WHEN z < a THEN z + 500 ELSE z END AS \"end\" FROM (SELECT *, 1 + l_partkey % 500 AS a, 1 + (l_partkey + l_suppkey) % 500 AS z FROM lineitem)",
)
def _(spark, d):
    rows = v.load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (1 + F.col("l_partkey") % 500).alias("a"), (1 + (F.col("l_partkey") + F.col("l_suppkey")) % 500).alias("z"))
    start, end = circ.checked_interval(F.col("a"), F.col("z"), F.lit(500))
    return rows.select("l_orderkey", "l_linenumber", start.alias("start"), end.alias("end"))


NEAR, FAR = 15, 50


@query(
    "fn13_precursor_windows",
    with_(
        v.MEMBERS, v.CONTIGS,
        "side AS (SELECT DISTINCT genome, contig, strand, s, e, length, circular, w FROM members JOIN contigs USING (genome, contig), (VALUES ('3p'), ('5p')) x(w))",
        f"wide AS (SELECT *, s - CASE WHEN (w = '5p') = (strand = '+') THEN {NEAR} ELSE {FAR} END AS a, e + CASE WHEN (w = '5p') = (strand = '+') THEN {FAR} ELSE {NEAR} END AS z FROM side)",
        "fit AS (SELECT *, CASE WHEN circular THEN greatest(z - a - length, 0) ELSE 0 END AS o, NOT circular AND (a < 0 OR z > length) AS clipped FROM wide)",
        "trimmed AS (SELECT *, CASE WHEN circular THEN a + (o + 1) // 2 ELSE greatest(a, 0) END AS a2, CASE WHEN circular THEN z - o // 2 ELSE least(z, length) END AS z2 FROM fit)",
        "moved AS (SELECT *, CASE WHEN circular AND a2 < 0 THEN length WHEN circular AND a2 >= length THEN -length ELSE 0 END AS m, CASE WHEN strand = '+' THEN s - a2 ELSE z2 - e END AS lead FROM trimmed)",
        then='SELECT genome, contig, strand, s AS "start", e AS "end", w AS "window", a2 + m AS win_start, z2 + m AS win_end, lead AS cand_from, lead + e - s AS cand_to, circular AND z2 + m > length AS wraps, clipped FROM moved',
    ),
)
def _(spark, d):
    rows = v.members(spark, d).select("genome", "contig", "strand", "start", "end").distinct().join(v.contigs(spark, d).select("genome", "contig", "length", "circular"), ["genome", "contig"])
    both = circ.precursor_windows(F.col("start"), F.col("end"), F.col("strand"), F.col("length"), F.col("circular"), NEAR, FAR)
    return rows.select("genome", "contig", "strand", "start", "end", F.explode(both).alias("w")).select("genome", "contig", "strand", "start", "end", "w.*")


# --- orders ---------------------------------------------------------------------------------------

RANK = "CASE {c} " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(seeds.CLASSES)) + " END"


@query("st3_target_order", SQL["ag12_target_summary"][: SQL["ag12_target_summary"].rindex("SELECT candidate, seq_id")] + "SELECT candidate, transcript, row_number() OVER (PARTITION BY candidate ORDER BY " + RANK.format(c="best_class") + ", sites DESC, transcript) AS place FROM (" + SQL["ag12_target_summary"][SQL["ag12_target_summary"].rindex("SELECT candidate, seq_id") :] + ")")
def _(spark, d):
    w = Window.partitionBy("candidate").orderBy(*scoring.target_order(), "transcript")
    return QUERIES["ag12_target_summary"](spark, d).select("candidate", "transcript", F.row_number().over(w).alias("place"))


def _head(name: str) -> str:
    return SQL[name][: SQL[name].rindex("SELECT candidate, seq_id")]


@query("st4_scored_order", _head("jn8_scored_sites") + "SELECT candidate, seq_id, s AS \"start\", site_class, row_number() OVER (PARTITION BY candidate ORDER BY " + RANK.format(c="site_class") + ", coalesce(support, -1) DESC, coalesce(paired, 0), seq_id, s) AS place FROM attached")
def _(spark, d):
    w = Window.partitionBy("candidate").orderBy(*scoring.scored_order("paired"), "seq_id", "start")
    return QUERIES["jn8_scored_sites"](spark, d).select("candidate", "seq_id", "start", "site_class", F.row_number().over(w).alias("place"))


@query("st5_scored_target_order", _head("ag13_scored_targets") + "SELECT candidate, transcript, row_number() OVER (PARTITION BY candidate ORDER BY coalesce(max_support, -1) DESC, " + RANK.format(c="best_class") + ", transcript) AS place FROM (" + SQL["ag13_scored_targets"][SQL["ag13_scored_targets"].rindex("SELECT candidate, seq_id") :] + ")")
def _(spark, d):
    w = Window.partitionBy("candidate").orderBy(*scoring.scored_target_order(), "transcript")
    return QUERIES["ag13_scored_targets"](spark, d).select("candidate", "transcript", F.row_number().over(w).alias("place"))


# --- reports --------------------------------------------------------------------------------------


@query("ag16_percent_of_raw", f"WITH f AS ({SQL['ag14_funnel']}) SELECT f.stage, f.sample, f.reads, round(100 * f.reads / r.reads, 9) AS percent FROM f JOIN f r ON r.stage = 'raw' AND r.sample = f.sample")
def _(spark, d):
    return reports.shares_of_raw(QUERIES["ag14_funnel"](spark, d)).withColumn("percent", F.round("percent", 9))


@query(
    "sk10_origin_bars",
    _best_ctes + """, bars AS (SELECT sample, CASE WHEN class IN ('unmapped', 'too_many_hits') THEN class ELSE class || ' (' || array_to_string(genomes, '+') || ')' END AS label, sum(n) AS n FROM cls JOIN (SELECT 'o' || o_orderkey AS read_id, o_orderstatus AS sample, 1 + o_orderkey % 4 AS n FROM orders) USING (read_id) GROUP BY ALL)
SELECT value FROM (SELECT 'Sample' || chr(9) || string_agg(DISTINCT label, chr(9) ORDER BY label) AS value FROM bars UNION ALL SELECT sample || chr(9) || string_agg(CAST(n AS VARCHAR), chr(9) ORDER BY label) FROM (SELECT s.sample, l.label, CAST(coalesce(b.n, 0) AS BIGINT) AS n FROM (SELECT unnest(['F', 'O', 'P']) AS sample) s CROSS JOIN (SELECT DISTINCT label FROM bars) l LEFT JOIN bars b ON b.sample = s.sample AND b.label = l.label) GROUP BY sample)""",
)
def _(spark, d):
    from locusmill.plans.queries import RULES, _origin
    from locusmill.operators import origin

    o = v.load(spark, d, "orders")
    counts = o.select(_text("o", F.col("o_orderkey")).alias("read_id"), F.col("o_orderstatus").alias("sample"), (1 + F.col("o_orderkey") % 4).alias("n"))
    lines = outputs.origin_lines(origin.origin_summary(_origin(spark, d, RULES["best"])[1], counts), ["F", "O", "P"])
    return lines.filter(~F.startswith("value", F.lit("#")))


# --- results held against planted ones -----------------------------------------------------------


@query(
    "jn15_read_owners",
    with_(
        v.READS, v.GUIDES,
        "r AS (SELECT DISTINCT sequence AS read FROM reads)",
        "f AS (SELECT guide_id, guide || substr(guide, 3, 4) AS own FROM guides WHERE guide_id % 2 = 0 UNION ALL SELECT 1000000 + row_number() OVER (ORDER BY read), substr(read, 2, 18) || 'ACG' FROM r)",
        "shifts AS (SELECT read, guide_id, own, unnest(range(-(length(read) - 15), length(own) - 14)) AS shift FROM r, f)",
        "laid AS (SELECT *, greatest(0, -shift) AS low, least(length(read), length(own) - shift) - greatest(0, -shift) AS bases FROM shifts)",
        "cmp AS (SELECT *, substr(read, low + 1, bases) AS x, substr(own, low + shift + 1, bases) AS y FROM laid WHERE bases >= 15)",
        "fits AS (SELECT *, hamming(x, y) AS apart FROM cmp WHERE hamming(x, y) <= 2 AND len([i FOR i IN range(1, bases - 6) IF substr(x, i, 8) = substr(y, i, 8)]) > 0)",
        then="SELECT read AS read_id, arg_min(guide_id, (apart - bases, guide_id)) AS feature_id FROM fits GROUP BY read",
    ),
)
def _(spark, d):
    r = v.reads(spark, d).select("sequence").distinct()
    g = v.guides(spark, d).filter("guide_id % 2 = 0").select(F.col("guide_id").alias("feature_id"), F.concat("guide", F.substring("guide", 3, 4)).alias("sequence"))
    numbered = r.select((F.lit(1_000_000) + F.row_number().over(Window.orderBy("sequence"))).cast("long").alias("feature_id"), F.concat(F.substring("sequence", 2, 18), F.lit("ACG")).alias("sequence"))
    features = g.select(F.col("feature_id").cast("long").alias("feature_id"), "sequence").unionByName(numbered).withColumn("position", F.col("feature_id"))
    return planted.owners(r.withColumn("read_id", F.col("sequence")), features)


ORIGINS = (*planted.ORIGIN_CLASSES, "strange")


@query(
    "ag20_reads_by_origin",
    "WITH o AS (SELECT c_custkey % 50 AS f, CASE WHEN o_orderkey % 9 = 8 THEN 'unmapped' ELSE [" + ", ".join(f"'{c}'" for c in ORIGINS) + "][o_orderkey % 9 + 1] END AS class, o_custkey % 6 AS n FROM orders JOIN customer ON o_custkey = c_custkey) SELECT k AS feature_id, "
    + ", ".join(f"CAST(coalesce(sum(n) FILTER (class = '{c}'), 0) AS BIGINT) AS {c}" for c in planted.ORIGIN_CLASSES) + ", CAST(coalesce(sum(n) FILTER (class = 'strange'), 0) AS BIGINT) AS other, CAST(coalesce(sum(n), 0) AS BIGINT) AS matched_reads FROM range(60) r(k) LEFT JOIN o ON f = k GROUP BY k",
)
def _(spark, d):
    o = v.load(spark, d, "orders").join(v.load(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey")), "o_custkey")
    k = F.col("o_orderkey")
    owned = o.select(k.alias("read_id"), (F.col("o_custkey") % 50).cast("long").alias("feature_id"))
    cls = o.filter(k % 9 < 8).select(k.alias("read_id"), _of(ORIGINS, k % 9).alias("class"))
    counts = o.select(k.alias("read_id"), (F.col("o_custkey") % 6).cast("long").alias("n"))
    return planted.reads_by_origin(owned, cls, counts, spark.range(60).withColumnRenamed("id", "feature_id"))


def _planted_sites(spark, d):
    """Planted sites of parts, and called ones of order lines, on common candidates and transcripts."""
    p, k = v.load(spark, d, "part"), F.col("p_partkey")
    sites = p.select(k.alias("site_id"), _text("c", k % 10).alias("candidate"), _text("t", k % 7).alias("transcript"), (k * 13 % 900 + 1).cast("long").alias("genomic_start"), (k * 13 % 900 + 8).cast("long").alias("genomic_end"), _of(seeds.CLASSES, k % 5).alias("site_class"), _of(("seed", "extensive"), k % 2).alias("pairing"))
    s, n = v.load(spark, d, "supplier"), F.col("s_suppkey")
    place = F.when(n % 11 == 0, "").otherwise(_text("chr:", n * 17 % 900 + 1, "-", n * 17 % 900 + 7, "(+)"))
    found = s.select(n.alias("call_id"), _text("c", n % 10).alias("candidate"), _text("t", n % 7).alias("transcript"), place.alias("genomic"), _of(seeds.CLASSES, n % 4 + 1).alias("site_class"), F.when(n % 3 > 0, n % 3).alias("support"))
    return sites, found


PLANTED_SITES = f"""planted AS (SELECT p_partkey AS site_id, 'c' || (p_partkey % 10) AS candidate, 't' || (p_partkey % 7) AS transcript, p_partkey * 13 % 900 + 1 AS a, p_partkey * 13 % 900 + 8 AS z, [{', '.join(f"'{c}'" for c in seeds.CLASSES)}][p_partkey % 5 + 1] AS site_class, ['seed', 'extensive'][p_partkey % 2 + 1] AS pairing FROM part),
calls AS (SELECT s_suppkey AS call_id, 'c' || (s_suppkey % 10) AS candidate, 't' || (s_suppkey % 7) AS transcript, s_suppkey * 17 % 900 + 1 AS ca, s_suppkey * 17 % 900 + 7 AS cz, [{', '.join(f"'{c}'" for c in seeds.CLASSES)}][s_suppkey % 4 + 2] AS call_class, CASE WHEN s_suppkey % 3 > 0 THEN s_suppkey % 3 END AS support FROM supplier WHERE s_suppkey % 11 > 0),
met AS (SELECT * FROM planted JOIN calls USING (candidate, transcript) WHERE ca <= z AND cz >= a),
best AS (SELECT site_id, arg_min(call_class, ({RANK.format(c='call_class')}, ca, cz)) AS found_class, arg_min(struct_pack(x := support), ({RANK.format(c='call_class')}, ca, cz)).x AS support FROM met GROUP BY site_id)"""


@query("jn16_planted_sites", with_(PLANTED_SITES, then=f"SELECT site_id, site_class, found_class, support, coalesce({RANK.format(c='found_class')} <= {RANK.format(c='site_class')}, false) AS found FROM planted LEFT JOIN best USING (site_id)"))
def _(spark, d):
    return planted.planted_sites(*_planted_sites(spark, d), ("support",)).select("site_id", "site_class", "found_class", "support", "found")


@query("ag22_support_by_pairing", with_(PLANTED_SITES, then="SELECT pairing, count(*) AS sites, count(*) FILTER (support >= 1) AS support_1, count(*) FILTER (support >= 2) AS support_2 FROM planted LEFT JOIN best USING (site_id) GROUP BY pairing"))
def _(spark, d):
    return planted.support_by_pairing(planted.planted_sites(*_planted_sites(spark, d), ("support",)))


@query("jn18_false_calls", with_(PLANTED_SITES, then="""SELECT CAST(level AS INTEGER) AS level, count(*) FILTER (support >= level) AS calls, count(*) FILTER (support >= level AND call_id NOT IN (SELECT call_id FROM met)) AS not_planted,
 round(count(*) FILTER (support >= level AND call_id NOT IN (SELECT call_id FROM met)) / nullif(count(*) FILTER (support >= level), 0), 9) AS share FROM calls_all, (VALUES (1), (2)) l(level) GROUP BY level""").replace("SELECT CAST(level", ", calls_all AS (SELECT s_suppkey AS call_id, CASE WHEN s_suppkey % 3 > 0 THEN s_suppkey % 3 END AS support FROM supplier) SELECT CAST(level"))
def _(spark, d):
    return planted.false_calls(*_planted_sites(spark, d)).withColumn("share", F.round("share", 9))


def _hairpins(spark, d):
    o, k = v.load(spark, d, "orders"), F.col("o_orderkey")
    windows = o.select((k % 997).alias("candidate"), k.alias("window"), F.when(k % 5 > 0, (F.col("o_custkey") % 40) / F.lit(400.0)).alias("pvalue"), (F.col("o_custkey") % 7 / F.lit(4.0)).alias("mfei"), (k % 3 > 0).alias("single_hairpin"), _of(("5p", "3p", "both"), k % 3).alias("arm"))
    best = windows.withColumn("best", F.row_number().over(Window.partitionBy("candidate").orderBy("window")) == 1)
    return v.load(spark, d, "supplier").select(F.col("s_suppkey").alias("feature_id"), (F.col("s_suppkey") * 3).cast("long").alias("candidate"), _of(("5p", "3p"), F.col("s_suppkey") % 2).alias("arm")), best


HAIRPINS = """w AS (SELECT o_orderkey % 997 AS candidate, o_orderkey AS "window", CASE WHEN o_orderkey % 5 > 0 THEN o_custkey % 40 / 400.0::DOUBLE END AS pvalue, o_custkey % 7 / 4.0::DOUBLE AS mfei, o_orderkey % 3 > 0 AS single_hairpin, ['5p', '3p', 'both'][o_orderkey % 3 + 1] AS arm FROM orders),
best AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY candidate ORDER BY "window") = 1),
planted AS (SELECT s_suppkey AS feature_id, s_suppkey * 3 AS candidate, ['5p', '3p'][s_suppkey % 2 + 1] AS arm FROM supplier)"""


@query("jn19_planted_hairpins", with_(HAIRPINS, then='SELECT feature_id, p.candidate, p.arm, "window", b.arm AS arm_found, coalesce(pvalue <= 0.05 AND single_hairpin AND b.arm = p.arm, false) AS found FROM planted p LEFT JOIN best b USING (candidate)'))
def _(spark, d):
    return planted.planted_hairpins(*_hairpins(spark, d)).select("feature_id", "candidate", "arm", "window", "arm_found", "found")


@query("cp9_background_hairpins", with_(HAIRPINS, then="SELECT count(*) AS others, count(*) FILTER (pvalue <= 0.05) AS significant FROM best WHERE pvalue IS NOT NULL AND candidate NOT IN (SELECT candidate FROM planted)"))
def _(spark, d):
    return planted.background_hairpins(*_hairpins(spark, d))


@query("jn17_candidates", f"SELECT 'f' || s_suppkey AS feature_id, c.candidate FROM supplier LEFT JOIN (SELECT {v._sql_sequence('p_partkey % 300')} AS sequence, max('p' || p_partkey) AS candidate FROM part GROUP BY 1) c ON {v._sql_sequence('s_suppkey * 5')} = c.sequence")
def _(spark, d):
    f = v.load(spark, d, "supplier").select(_text("f", F.col("s_suppkey")).alias("feature_id"), v.sequence_of(F.col("s_suppkey") * 5).alias("rep_sequence"))
    c = v.load(spark, d, "part").select(_text("p", F.col("p_partkey")).alias("candidate"), v.sequence_of(F.col("p_partkey") % 300).alias("sequence"))
    return planted.candidates_of(f, c)


@query(
    "ag24_rejected_reads",
    """WITH r AS (SELECT l_suppkey AS f, count(*) FILTER (l_linenumber % 3 = 0) AS rejected, count(*) AS matched FROM lineitem GROUP BY l_suppkey)
SELECT CAST(f AS BIGINT) AS feature_id, rejected, matched AS matched_reads, 2 * rejected > matched AS mostly, 2 * rejected > matched AND f % 2 = 1 AS lost FROM r WHERE rejected > 0""",
)
def _(spark, d):
    rows = v.load(spark, d, "lineitem")
    by = rows.groupBy(F.col("l_suppkey").cast("long").alias("feature_id")).agg(F.count_if(F.col("l_linenumber") % 3 == 0).alias(evaluation.REJECTED), F.count(F.lit(1)).alias("matched_reads"))
    judged = by.select("feature_id", F.lit("pass").alias("expected"), F.when(F.col("feature_id") % 2 == 1, "missed").otherwise("pass").alias("outcome"))
    read = F.concat_ws(".", "l_orderkey", "l_linenumber")
    origin = rows.select(read.alias("read_id"), F.when(F.col("l_linenumber") % 3 == 0, evaluation.REJECTED).otherwise("assigned").alias("class"))
    return evaluation.rejected_reads(by, origin, origin.select("read_id", F.lit(1).alias("n")), judged)[1].select("feature_id", "rejected", "matched_reads", "mostly", "lost")
