"""From raw documents to packed training sequences: five stages, each a written table that the next one reads.

Every stage keeps the columns of ``documents`` (the last one gives pieces of sequences) and works on all that the one before kept.
Null and empty texts and repeated rows pass through the stages as each operator defines it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusmill.llm.common import table, written
from locusmill.llm.curve_packing import pack_along_curve
from locusmill.llm.jaccard import keep_one
from locusmill.llm.mixing import mixed_documents
from locusmill.llm.quality import quality_rules
from locusmill.llm.secret_index import mask_secrets


def _sized(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(columns) if "n_chars" in columns else docs.select(columns)


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the log-likelihood ratio."""
    return quality_rules(docs, table(spark, sf_dir, "labels")).filter("kept").select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of at least 0.8 over five-word shingles join: the one with the least doc_id."""
    return keep_one(docs, n=5, percent=80)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by the kind of secret."""
    return _sized(mask_secrets(docs), docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What a mix with weights 5, 2, 1 takes of each document: a row for every stretch of words and every time it is taken."""
    return _sized(mixed_documents(docs, "source", (5, 2, 1)), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens along a space-filling curve."""
    return pack_along_curve(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", reject_low_quality),
    ("near duplicates", drop_near_copies),
    ("secret scan", hide_secrets),
    ("source mix", mix_sources),
    ("packing", pack),
]
#: SQL can't hash, tokenise and cluster as the stages do; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k}")
    return docs
