"""Helpers shared by the operators of this package."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.utils import AnalysisException

from cratewise.session import shared_path

#: What separates words, and a word, as the contracts give them.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """A text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: a lost executor
    then costs one file read, and what is used twice is computed once. What was
    shuffled for it is of no use afterwards and is removed at once."""
    spark = df.sparkSession
    path, before = shared_path(spark, name), spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def file_backed(df: DataFrame) -> DataFrame:
    """``df`` itself if it comes straight from files, else a copy in the shared folder."""
    try:
        df.select("_metadata.row_index")
        return df
    except AnalysisException:
        return saved(df, "rows")


def located(df: DataFrame) -> DataFrame:
    """A file-backed table with ``_file`` and ``_row``, which name a row for good."""
    return df.select("*", F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def whole_rows(docs: DataFrame) -> DataFrame:
    """``_doc`` (all columns, so that none can clash), ``_file`` and ``_row`` of a file-backed table."""
    return located(docs.select(F.struct("*").alias("_doc")))


def chosen_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of a file-backed table that ``kept`` (_file, _row) names, all columns as they came."""
    kept = kept.select(F.col("_file").alias("_f"), F.col("_row").alias("_r"))
    same = (F.col("_file") == F.col("_f")) & (F.col("_row") == F.col("_r"))
    return whole_rows(docs).join(kept, same, "left_semi").select("_doc.*")


def bits_for(rows: int, per_bucket: int = 20_000) -> int:
    """Hash bits that leave about ``per_bucket`` rows to a bucket."""
    return max(2, math.ceil(math.log2(max(1, rows) / per_bucket + 1)))


def running_total(df: DataFrame, keys: list[str], order: list[str], value: str, out: str, bits: int) -> DataFrame:
    """Adds the sum of ``value`` over the rows before, within ``keys``, in hash order of ``order``.

    Every group is cut into 2**bits buckets by hash, so that one key with a third
    of all rows is summed by many tasks; only the bucket totals, of bounded
    number for a key, meet in one place. Null keys form a group of their own.
    """
    spread = F.xxhash64(*[F.col(c).cast("string") for c in order])
    rows = df.withColumn("_h", spread).withColumn("_bucket", F.shiftrightunsigned("_h", 64 - bits))
    totals = rows.groupBy(*keys, "_bucket").agg(F.sum(value).alias("_part"))
    before = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_part").over(before), F.lit(0)).alias("_before"),
    )
    same = F.col("_bucket") == F.col("_b")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = W.partitionBy(*keys, "_bucket").orderBy("_h", *order).rowsBetween(W.unboundedPreceding, -1)
    joined = rows.join(totals, same)
    total = F.coalesce(F.sum(value).over(inside), F.lit(0)) + F.col("_before")
    return joined.withColumn(out, total).drop("_h", "_bucket", "_b", "_before", *[f"_k{i}" for i in range(len(keys))])


def ranked(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Adds the global position (from 0) in ``order``, without one task that sorts all rows.

    Rows are dealt by range; each range numbers its own rows after the sum of
    the ranges before it, of which there is one figure per partition.
    """
    dealt = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    dealt = saved(dealt, "ranked")
    counts = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = W.partitionBy("_range").orderBy(*order)
    numbered = dealt.join(F.broadcast(starts), "_range")
    return numbered.withColumn(out, F.row_number().over(inside) - 1 + F.col("_start")).drop("_range", "_start")
