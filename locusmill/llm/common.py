"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
import weakref

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as ``spark.checkpoint.dir`` names it.

    Where it is unset, a session in one process gets a temporary folder, one an application; a cluster (``local-cluster`` too) gets an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir is unset: intermediate tables need a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="locusmill-")
    return _own[app]


_own: dict[str, str] = {}


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage and fixes what is read more than once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` gave and that nothing still to be run reads."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(_paths.pop(t))
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def keyed(df: DataFrame, column: str, out: str) -> DataFrame:
    """``df`` with ``out``, a long that no two rows share and that follows ``column``'s order, nulls last.

    That is ``column`` itself if its numbers are no row's twice. Else rows are numbered in its order, equal ones by the hash of all
    columns: either way a number follows from the rows alone, not from how they are dealt. Equal rows get theirs in any order.
    """
    rows, ids = df.agg(F.count(F.lit(1)), F.countDistinct(column)).first()
    if rows == ids and df.schema[column].dataType.simpleString() in ("int", "bigint"):
        return df.withColumn(out, F.col(column).cast("long"))
    order = [F.col(column).asc_nulls_last(), F.xxhash64(*df.columns)]
    return written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(out, F.monotonically_increasing_id()), "keyed")


def n_words(text: Column) -> Column:
    """Number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_start(df: DataFrame, cell: list[str], order: list[str], size: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``size`` over the rows that precede a row in its cell, in the order of ``order``; ``df`` is a narrow table.

    Rows are range-partitioned by cell and order, so that no task sorts a whole cell: a range's rows are summed, ranges are
    summed within their cell, and each row is placed inside its range. Rows that agree in all columns of ``order`` follow in any order; they may fill several ranges.
    """
    keys = [*cell, *order]
    rows = df.withColumn("_mark", F.monotonically_increasing_id())
    ranged = written(rows.repartitionByRange(*keys, "_mark").withColumn("_run", F.spark_partition_id()), "ranges")
    at = [*cell, "_run"]
    sums = ranged.groupBy(*at).agg(F.sum(size).alias("_sum"))
    before = Window.partitionBy(*(cell or [F.lit(1)])).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    sums = sums.withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    inside = Window.partitionBy(*[f"a.{c}" for c in at]).orderBy(*[f"a.{c}" for c in order], "a._mark").rowsBetween(Window.unboundedPreceding, -1)
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in at]
    return (
        ranged.alias("a")
        .join(sums.alias("b"), same)
        .select("a.*", (F.col("b._base") + F.coalesce(F.sum(f"a.{size}").over(inside), F.lit(0))).cast("long").alias(out))
        .drop("_run", "_mark")
    )
