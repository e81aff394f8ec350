"""Collapsing reads as files of them arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from locusmill.operators.collapse import kept_reads


def read_stream(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def running_counts(reads: DataFrame, low: int, high: int) -> DataFrame:
    """sequence, sample, n so far. The state holds one row for each distinct sequence and sample."""
    return kept_reads(reads, low, high).groupBy("sequence", "sample").agg(F.count(F.lit(1)).alias("n"))


def collapse_available(reads: DataFrame, table: str, checkpoint: str, low: int, high: int) -> StreamingQuery:
    """Count what has arrived since the last run into a table of counts, one batch of changed rows after the other.

    Each batch is written under its number, so a repeated batch replaces itself; ``latest_counts`` reads the newest.
    """

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{table}/batch={batch}")

    return running_counts(reads, low, high).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()


def latest_counts(spark: SparkSession, table: str) -> DataFrame:
    """The last count written of each sequence and sample."""
    rows = spark.read.parquet(table)
    return rows.groupBy("sequence", "sample").agg(F.max_by("n", "batch").alias("n"))
