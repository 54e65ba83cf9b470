"""Least and largest values of a column as the footers of Parquet files tell them."""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import contextmanager
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types whose bounds Spark takes from footers; timestamps and texts have none there.
BOUNDED = (T.DateType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)
V1_SOURCES, PUSH_DOWN = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"


class Bounds(NamedTuple):
    least: Any
    largest: Any
    rows: int


@contextmanager
def aggregates_pushed_down(spark: SparkSession):
    """Parquet through the newer source interface, which answers min, max and count from footers."""
    before = {name: spark.conf.get(name) for name in (V1_SOURCES, PUSH_DOWN)}
    others = [s for s in before[V1_SOURCES].split(",") if s.strip().lower() != "parquet"]
    spark.conf.set(V1_SOURCES, ",".join(others))
    spark.conf.set(PUSH_DOWN, "true")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def bounds_query(spark: SparkSession, path: str, column: str) -> DataFrame | None:
    """One row with the bounds of a column; None where its type has no bounds in footers."""
    df = spark.read.parquet(path)
    if column not in df.columns or not isinstance(df.schema[column].dataType, BOUNDED):
        return None
    value = F.col("`" + column.replace("`", "``") + "`")
    return df.agg(F.min(value).alias("least"), F.max(value).alias("largest"), F.count("*").alias("rows"))


class FileBounds:
    """Bounds of the columns of tables that are plain Parquet, by (table, header as it is in the files)."""

    def __init__(self, spark: SparkSession, paths: Mapping[str, str]):
        self.spark, self.paths = spark, dict(paths)

    def of(self, table: str, column: str) -> Bounds | None:
        """None where the footers don't tell; the caller then scans."""
        if table not in self.paths:
            return None
        with aggregates_pushed_down(self.spark):
            found = bounds_query(self.spark, self.paths[table], column)
            if found is None or "PushedAggregation: [MIN" not in found._jdf.queryExecution().executedPlan().toString():
                return None
            return Bounds(*found.first())
