"""Domain tables derived from the given tables, for the registered queries, each beside the SQL that gives the same rows.

Sequences are digests written in A, C, G and T; everything else is integer arithmetic, so both engines agree exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sequence_of(key: Column) -> Column:
    return F.translate(F.md5(key.cast("string")), "0123456789abcdef", "ACGTACGTACGTACGT")


def _sql_sequence(key: str) -> str:
    return f"translate(md5(CAST({key} AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT')"


def reads(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "events")
    return e.select(F.col("event_type").alias("sample"), F.substring(sequence_of(F.col("user_id")), F.lit(1), (16 + F.col("user_id") % 15).cast("int")).alias("sequence"))


READS = f"reads AS (SELECT event_type AS sample, substr({_sql_sequence('user_id')}, 1, 16 + user_id % 15) AS sequence FROM events)"


def members(spark: SparkSession, d: str) -> DataFrame:
    """Placed reads: genome, contig, strand, sample, start, end, read_id, weight, n."""
    at = (F.col("l_partkey") * 200 + F.col("l_linenumber")).cast("long")
    return load(spark, d, "lineitem").select(
        F.concat(F.lit("g"), (F.col("l_suppkey") % 3).cast("string")).alias("genome"),
        F.concat(F.lit("c"), (F.col("l_suppkey") % 2).cast("string")).alias("contig"),
        F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"),
        F.col("l_returnflag").alias("sample"),
        at.alias("start"),
        (at + 18 + F.col("l_quantity").cast("long") % 18).alias("end"),
        F.concat(F.lit("r"), (F.col("l_orderkey") % 5000).cast("string")).alias("read_id"),
        (F.lit(1.0) / (1 + F.col("l_linenumber") % 2)).alias("weight"),
        (1 + F.col("l_linenumber")).cast("long").alias("n"),
    )


MEMBERS = """members AS (SELECT 'g' || (l_suppkey % 3) AS genome, 'c' || (l_suppkey % 2) AS contig,
  CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, l_returnflag AS sample,
  CAST(l_partkey * 200 + l_linenumber AS BIGINT) AS s,
  CAST(l_partkey * 200 + l_linenumber + 18 + CAST(l_quantity AS BIGINT) % 18 AS BIGINT) AS e,
  'r' || (l_orderkey % 5000) AS read_id, 1.0::DOUBLE / (1 + l_linenumber % 2) AS weight, CAST(1 + l_linenumber AS BIGINT) AS n FROM lineitem)"""


def contigs(spark: SparkSession, d: str) -> DataFrame:
    """ref, genome, contig, role, length, circular; lengths end just before the last placed base."""
    rows = members(spark, d).groupBy("genome", "contig").agg((F.max("end") - 5).alias("length"))
    return rows.select(
        F.concat_ws("|", "genome", "contig").alias("ref"), "genome", "contig", F.when(F.col("genome") == "g1", "exclude").otherwise("focus").alias("role"), "length", (F.col("genome") == "g0").alias("circular")
    )


CONTIGS = "contigs AS (SELECT genome || '|' || contig AS ref, genome, contig, CASE WHEN genome = 'g1' THEN 'exclude' ELSE 'focus' END AS role, max(e) - 5 AS length, genome = 'g0' AS circular FROM members GROUP BY genome, contig)"


def hits(spark: SparkSession, d: str) -> DataFrame:
    """Alignments: the rows of an order are the hits of a read."""
    return load(spark, d, "lineitem").select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("read_id"),
        F.concat(F.lit("g"), (F.col("l_suppkey") % 3).cast("string"), F.lit("|c"), (F.col("l_suppkey") % 2).cast("string")).alias("ref"),
        (F.col("l_partkey") * 200).cast("long").alias("start"),
        (F.col("l_partkey") * 200 + 21).cast("long").alias("end"),
        F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"),
        (F.col("l_quantity").cast("int") % 4).alias("mismatches"),
    )


HITS = """raw_hits AS (SELECT 'o' || l_orderkey AS read_id, 'g' || (l_suppkey % 3) || '|c' || (l_suppkey % 2) AS ref, CAST(l_partkey * 200 AS BIGINT) AS s,
  CAST(l_partkey * 200 + 21 AS BIGINT) AS e, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, CAST(l_quantity AS INTEGER) % 4 AS mm FROM lineitem),
hits AS (SELECT DISTINCT read_id, genome, contig, role, CASE WHEN circular AND s >= length THEN s - length ELSE s END AS s,
  CASE WHEN circular AND s >= length THEN e - length ELSE e END AS e, strand, mm FROM raw_hits JOIN contigs USING (ref))"""


def features(spark: SparkSession, d: str) -> DataFrame:
    """Annotation: genome, contig, strand, start, end, type, name."""
    p = load(spark, d, "part")
    at = (F.col("p_partkey") * 400).cast("long")
    kinds = F.array(*[F.lit(x) for x in ("rRNA", "tRNA", "CDS", "exon", "misc", "gene", "ncRNA")])
    return p.select(
        F.concat(F.lit("g"), (F.col("p_partkey") % 3).cast("string")).alias("genome"),
        F.concat(F.lit("c"), (F.col("p_size") % 2).cast("string")).alias("contig"),
        F.get(F.array(F.lit("+"), F.lit("-"), F.lit(".")), (F.col("p_size") % 3).cast("int")).alias("strand"),
        at.alias("start"),
        (at + 150 + F.col("p_size") * 9).alias("end"),
        F.get(kinds, (F.col("p_partkey") % 7).cast("int")).alias("type"),
        F.when(F.col("p_partkey") % 5 == 0, ".").otherwise(F.col("p_brand")).alias("name"),
    )


FEATURES = """features AS (SELECT 'g' || (p_partkey % 3) AS genome, 'c' || (p_size % 2) AS contig, ['+','-','.'][p_size % 3 + 1] AS strand, CAST(p_partkey * 400 AS BIGINT) AS s,
  CAST(p_partkey * 400 + 150 + p_size * 9 AS BIGINT) AS e, ['rRNA','tRNA','CDS','exon','misc','gene','ncRNA'][p_partkey % 7 + 1] AS type,
  CASE WHEN p_partkey % 5 = 0 THEN '.' ELSE p_brand END AS name FROM part)"""


def scores(spark: SparkSession, d: str) -> DataFrame:
    """Site scores: candidate, decoy (null: real), site_class, score in cents, guide_id."""
    o = load(spark, d, "orders")
    decoy = F.col("o_orderkey") % 21
    return o.select(
        (F.col("o_custkey") % 20).alias("candidate"), F.when(decoy > 0, decoy).alias("decoy"),
        F.get(F.array(F.lit("8mer"), F.lit("7mer-m8"), F.lit("7mer-A1")), (F.col("o_custkey") % 3).cast("int")).alias("site_class"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("score"),
    )


SCORES = "scores AS (SELECT o_custkey % 20 AS candidate, CASE WHEN o_orderkey % 21 > 0 THEN o_orderkey % 21 END AS decoy, ['8mer','7mer-m8','7mer-A1'][o_custkey % 3 + 1] AS site_class, CAST(round(o_totalprice * 100) AS BIGINT) AS score FROM orders)"


def targets(spark: SparkSession, d: str) -> DataFrame:
    """Long sequences: seq_id (a brand), sequence."""
    rows = load(spark, d, "part").groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("p_partkey", sequence_of(F.col("p_partkey")).alias("s")))).alias("x"))
    return rows.select(F.col("p_brand").alias("seq_id"), F.array_join(F.transform("x", lambda y: y["s"]), "").alias("sequence"))


TARGETS = f"targets AS (SELECT p_brand AS seq_id, string_agg({_sql_sequence('p_partkey')}, '' ORDER BY p_partkey) AS sequence FROM part GROUP BY p_brand)"


def planted(spark: SparkSession, d: str) -> DataFrame:
    """Planted features near the blocks of ``members``: feature_id, category, genome, contig, strand, start, end, expected, sequence."""
    p, key, size = load(spark, d, "part"), F.col("p_partkey"), F.col("p_size")
    of = lambda names, k: F.get(F.array(*map(F.lit, names)), k.cast("int"))
    place = [F.concat(F.lit("g"), (key % 3).cast("string")).alias("genome"), F.concat(F.lit("c"), (size % 2).cast("string")).alias("contig"), of(("+", "-"), F.floor(size / 2) % 2).alias("strand")]
    one = p.select(F.concat(F.lit("f"), key).alias("feature_id"), of(("srna_a", "trf5", "degradation", "srna_b", "trf3_cca"), key % 5).alias("category"), *place, (key * 200 + 1 + size % 7).cast("long").alias("start"), (key * 200 + 19 + size % 7 + size % 18).cast("long").alias("end"), of(("pass", "fail", "any", "merged"), size % 4).alias("expected"))
    two = p.select(F.concat(F.lit("h"), key).alias("feature_id"), of(("srna_c", "repeat"), key % 2).alias("category"), *place, (key * 200 + 4).cast("long").alias("start"), (key * 200 + 12).cast("long").alias("end"), F.lit("missed").alias("expected"))
    return one.unionByName(two)


PLANTED = """spots AS (SELECT *, 'g' || (p_partkey % 3) AS genome, 'c' || (p_size % 2) AS contig, ['+', '-'][p_size // 2 % 2 + 1] AS strand FROM part),
planted AS (SELECT 'f' || p_partkey AS feature_id, ['srna_a', 'trf5', 'degradation', 'srna_b', 'trf3_cca'][p_partkey % 5 + 1] AS category, genome, contig, strand, p_partkey * 200 + 1 + p_size % 7 AS s, p_partkey * 200 + 19 + p_size % 7 + p_size % 18 AS e, ['pass', 'fail', 'any', 'merged'][p_size % 4 + 1] AS expected FROM spots
  UNION ALL SELECT 'h' || p_partkey, ['srna_c', 'repeat'][p_partkey % 2 + 1], genome, contig, strand, p_partkey * 200 + 4, p_partkey * 200 + 12, 'missed' FROM spots)"""


def transcripts(spark: SparkSession, d: str) -> DataFrame:
    """Spliced transcripts on the long sequences: transcript, gene, contig, strand, exons, cds. One of four has no coding part."""
    s = F.col("s_suppkey")
    exon = lambda k: F.struct((s * 7 % 50 + k * 60).cast("bigint").alias("s"), (s * 7 % 50 + k * 60 + 20 + s * (k + 1) % 31).cast("bigint").alias("e"))
    exons = F.transform(F.sequence(F.lit(0), (2 + s % 3).cast("int")), exon)
    last = F.size("exons") - 1
    coding = F.transform("exons", lambda x, i: F.struct(F.when(i == 0, x["s"] + 5).otherwise(x["s"]).alias("s"), F.when(i == last, x["e"] - 7).otherwise(x["e"]).alias("e")))
    contig = F.concat(F.lit("Brand#"), (1 + s % 5).cast("string"), (1 + F.floor(s / 5) % 5).cast("string"))
    rows = load(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("t"), s.cast("string")).alias("transcript"), F.concat(F.lit("g"), (s % 7).cast("string")).alias("gene"), contig.alias("contig"), F.when(s % 2 == 0, "+").otherwise("-").alias("strand"), exons.alias("exons"))
    return rows.withColumn("cds", F.when(s % 4 == 0, F.array().cast("array<struct<s:bigint,e:bigint>>")).otherwise(coding)).drop("s_suppkey")


#: tx, ex (an exon a row, with its offset in the transcript), line and reg (the regions' spans in the transcript)
TRANSCRIPTS = """tx AS (SELECT s_suppkey AS t, 'Brand#' || (1 + s_suppkey % 5) || (1 + s_suppkey // 5 % 5) AS contig, CASE WHEN s_suppkey % 2 = 0 THEN '+' ELSE '-' END AS strand, unnest(range(0, 3 + s_suppkey % 3)) AS k FROM supplier),
ex0 AS (SELECT *, t * 7 % 50 + k * 60 AS s, t * 7 % 50 + k * 60 + 20 + t * (k + 1) % 31 AS e FROM tx),
ex AS (SELECT *, coalesce(sum(e - s) OVER (PARTITION BY t ORDER BY CASE WHEN strand = '+' THEN k ELSE -k END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o, sum(e - s) OVER (PARTITION BY t) AS n FROM ex0),
line AS (SELECT t, contig, strand, any_value(n) AS n, CASE WHEN strand = '+' THEN string_agg(substr(sequence, s + 1, e - s), '' ORDER BY k) ELSE reverse(translate(string_agg(substr(sequence, s + 1, e - s), '' ORDER BY k), 'ACGTUN', 'TGCAAN')) END AS line
  FROM ex JOIN targets ON contig = seq_id GROUP BY t, contig, strand HAVING max(e) <= max(length(sequence))),
spans AS (SELECT *, CASE WHEN strand = '+' THEN 5 ELSE 7 END AS cs, n - CASE WHEN strand = '+' THEN 7 ELSE 5 END AS ce FROM line),
reg AS (SELECT t, contig, strand, line, 'five_prime_UTR' AS region, 0 AS a, cs AS z FROM spans WHERE t % 4 > 0 UNION ALL SELECT t, contig, strand, line, 'CDS', cs, ce FROM spans WHERE t % 4 > 0
  UNION ALL SELECT t, contig, strand, line, 'three_prime_UTR', ce, n FROM spans WHERE t % 4 > 0 UNION ALL SELECT t, contig, strand, line, 'transcript', 0, n FROM spans WHERE t % 4 = 0)"""


def guides(spark: SparkSession, d: str) -> DataFrame:
    """guide_id, candidate, decoy (null: real), guide of 22 bases: one of six suppliers is real, the others its decoys."""
    s = load(spark, d, "supplier")
    key = F.col("s_suppkey")
    return s.select(key.alias("guide_id"), F.floor(key / 6).cast("long").alias("candidate"), F.when(key % 6 > 0, key % 6).alias("decoy"), F.substring(sequence_of(key * 7), 1, 22).alias("guide"))


GUIDES = f"guides AS (SELECT s_suppkey AS guide_id, s_suppkey // 6 AS candidate, CASE WHEN s_suppkey % 6 > 0 THEN s_suppkey % 6 END AS decoy, substr({_sql_sequence('s_suppkey * 7')}, 1, 22) AS guide FROM supplier)"
