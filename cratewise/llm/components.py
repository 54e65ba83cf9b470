"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cratewise.llm.common import saved


def stars(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that isn't its component's smallest.

    Each round hangs the larger neighbours of a node, then its smaller ones, on
    the smallest neighbour, until nothing changes. A round is one chain of three
    shuffles without a join: what a broadcast or one more stage takes of the
    driver's memory doesn't depend on the rows, and rounds follow each other
    faster than it is given back. Nothing is gathered on the driver but a count
    and a checksum.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, mark = saved(now, "links"), None
    lowest, edge = F.min("v").over(W.partitionBy("u")), F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    while True:
        # Larger neighbours hang on the smallest of the neighbourhood.
        both = now.select(F.inline(edge)).withColumn("m", F.least("u", lowest))
        large = both.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Smaller neighbours, and the node itself, hang on the smallest of them.
        small = large.withColumn("m", lowest)
        small = small.select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))))
        seen = Observation()
        figures = [F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")]
        now = saved(small.filter("u <> v").distinct().observe(seen, *figures), "links")
        new = seen.get
        if new == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = new
