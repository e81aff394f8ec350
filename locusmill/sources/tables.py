"""Tab-separated tables, alignments and annotation files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Feature types that name whole contigs.
SKIPPED_TYPES = ("region", "chromosome", "source", "databank_entry", "contig", "scaffold")


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings; an empty field stays an empty string."""
    rows = spark.read.csv(path, sep="\t", header=True, inferSchema=False, quote="", escape="", nullValue="\0", emptyValue="")
    return rows.na.fill("")


def write_tsv(df: DataFrame, path: str, columns: list[str], null: str = "") -> None:
    """The named columns in their order; booleans as 0 and 1."""
    kinds = dict(df.dtypes)
    out = [F.coalesce((F.col(c).cast("int") if kinds[c] == "boolean" else F.col(c)).cast("string"), F.lit(null)).alias(c) for c in columns]
    df.select(out).write.csv(path, sep="\t", header=True, quote="", emptyValue="")


def long_counts(wide: DataFrame, key: str = "sequence", fixed: tuple[str, ...] = ("read_id", "sequence", "length")) -> DataFrame:
    """key, sample, n > 0 of a table with a column of counts for each sample."""
    samples = [c for c in wide.columns if c not in fixed]
    rows = wide.select(key, *[F.col(c).cast("double").alias(c) for c in samples]).unpivot([key], samples, "sample", "n")
    return rows.filter("n > 0")


def parse_sam(lines: DataFrame) -> DataFrame:
    """read_id, ref, start, end, strand, mismatches of the aligned records of a SAM text (column ``value``).

    Headers, records with too few fields and unaligned ones are skipped. The end follows the operations that use the reference; without an NM tag there
    are no mismatches.
    """
    f = F.split("value", "\t")
    rows = lines.filter(~F.startswith("value", F.lit("@"))).select(f.alias("f")).filter(F.size("f") >= 11)
    flag = F.get("f", 1).cast("int")
    used = F.aggregate(F.regexp_extract_all(F.get("f", 5), F.lit(r"(\d+)[MDN=X]"), F.lit(1)), F.lit(0), lambda a, x: a + x.cast("int"))
    start = F.get("f", 3).cast("long") - 1
    tag = F.get(F.filter(F.slice("f", 12, F.greatest(F.size("f") - 11, F.lit(0))), lambda x: F.startswith(x, F.lit("NM:i:"))), 0)
    rows = rows.filter(flag.bitwiseAND(4) == 0)
    return rows.select(
        F.get("f", 0).alias("read_id"), F.get("f", 2).alias("ref"), start.alias("start"), (start + used).alias("end"),
        F.when(flag.bitwiseAND(16) != 0, "-").otherwise("+").alias("strand"), F.coalesce(F.substring(tag, 6, 9).cast("int"), F.lit(0)).alias("mismatches"),
    )


def _decoded(c):
    """Percent escapes; a plus stays and text with broken escapes is left alone."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def attribute(attributes: str, key: str):
    """The last value of a key in GFF3 attributes, or null."""
    fields = F.filter(F.split(attributes, ";"), lambda x: F.startswith(F.trim(x), F.lit(key + "=")))
    return _decoded(F.nullif(F.regexp_replace(F.trim(F.try_element_at(fields, F.lit(-1))), f"^{key}=", ""), F.lit("")))


def parse_gff(lines: DataFrame) -> DataFrame:
    """contig, type, start, end, strand, attributes of the records of GFF3 texts (``numbered_lines``), each up to its own ``##FASTA``."""
    stops = lines.filter(F.startswith("value", F.lit("##FASTA"))).groupBy("file").agg(F.min("line").alias("stop"))
    rows = lines.join(stops, "file", "left").filter(F.col("stop").isNull() | (F.col("line") < F.col("stop")))
    f = F.split("value", "\t")
    rows = rows.filter(~F.startswith("value", F.lit("#"))).select(f.alias("f")).filter(F.size("f") >= 9)
    return rows.select(
        F.get("f", 0).alias("contig"), F.get("f", 2).alias("type"), (F.get("f", 3).cast("long") - 1).alias("start"), F.get("f", 4).cast("long").alias("end"), F.get("f", 6).alias("strand"), F.get("f", 8).alias("attributes")
    )


def features(records: DataFrame, genome: str) -> DataFrame:
    """Flat features of a genome: the name is Name, else gene, else ID, else a dot."""
    name = F.coalesce(attribute("attributes", "Name"), attribute("attributes", "gene"), attribute("attributes", "ID"), F.lit("."))
    rows = records.filter(~F.col("type").isin(*SKIPPED_TYPES))
    return rows.select(F.lit(genome).alias("genome"), "contig", "strand", "start", "end", "type", name.alias("name"))


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """value, file, line of text files of any size; ``line`` orders a file's lines: the part of the file that a task reads, and the place in it.

    Files are read in parts as Spark splits them; numbers are the same in each reading of the files with the same settings.
    """
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("row"))
    return rows.select(F.regexp_replace("value", r"\r$", "").alias("value"), "file", F.struct("part", "row").alias("line"))
