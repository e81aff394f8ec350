"""Sequence files. Compression follows the suffix, as Spark's readers do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """name, header, sequence of each record: the name is the header up to its first blank, lines are joined, blank lines skipped.

    Records are separated by a line's leading ``>``, so the parts of a file that Spark reads hold whole records. What
    stands before a file's first header is ignored.
    """
    rows = spark.read.option("lineSep", "\n>").text(path).select("value", F.startswith("value", F.lit(">")).alias("marked"), F.col("_metadata.file_path").alias("file"))
    # only the first piece of a file still has its mark; a file without one at its start has text to ignore
    lines = F.split(F.regexp_replace("value", "^>", ""), "\r?\n")
    header = F.get(lines, 0)
    body = F.array_join(F.transform(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), lambda x: F.trim(x)), "")
    rows = rows.select(F.regexp_extract(header, r"^(\S*)", 1).alias("name"), F.trim(header).alias("header"), body.alias("sequence"), "marked", "file")
    return rows.filter("marked OR name <> ''").select("name", "header", "sequence")


def fasta_names(spark: SparkSession, path: str) -> DataFrame:
    """name of each record."""
    return read_fasta(spark, path).select("name")


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """candidate, genome, guide of a FASTA of candidates: the genome stands before ``|`` in the header's second word; U becomes T."""
    word = F.regexp_extract("header", r"^\S+\s+(\S+)", 1)
    genome = F.when(F.contains(word, F.lit("|")), F.substring_index(word, "|", 1)).otherwise("")
    return read_fasta(spark, path).select(F.col("name").alias("candidate"), genome.alias("genome"), F.translate(F.upper("sequence"), "U", "T").alias("guide"))


def read_decoys(spark: SparkSession, path: str) -> DataFrame:
    """guide_id, candidate, guide of a FASTA of decoys: the candidate stands before ``__decoy``."""
    return read_fasta(spark, path).select(F.col("name").alias("guide_id"), F.substring_index("name", "__decoy", 1).alias("candidate"), F.translate(F.upper("sequence"), "U", "T").alias("guide"))


def read_fastq(spark: SparkSession, paths: dict[str, list[str]]) -> DataFrame:
    """sample, sequence of each read. ``paths``: a sample's files, gzip or plain.

    Files are cut before each line that starts with ``+``, so the sequence is the last line of a piece, behind a header
    with ``@``; pieces that a quality line with a leading ``+`` makes end otherwise. So plain files can be read in parts.
    """
    parts = [spark.read.option("lineSep", "\n+").text(ps).select(F.lit(s).alias("sample"), "value") for s, ps in paths.items()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    lines = F.split("value", "\r?\n")
    rows = rows.select("sample", lines.alias("l"))
    read = (F.size("l") >= 2) & (F.element_at("l", -1) != "") & F.startswith(F.try_element_at("l", F.lit(-2)), F.lit("@"))
    return rows.filter(read).select("sample", F.regexp_replace(F.element_at("l", -1), "\r$", "").alias("sequence"))


def write_fasta(df: DataFrame, path: str, name: str = "name", sequence: str = "sequence", width: int = 80) -> None:
    """``>name`` and the sequence in lines of ``width``."""
    lines = F.regexp_replace(F.regexp_replace(F.col(sequence), f"(.{{{width}}})", "$1\n"), "\n$", "")
    df.select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), lines)).write.text(path)
