"""A storage layout for day sums: by month, bucketed by the agent's lookup key.

Aggregates by source names and the agent lookup find their rows where they are:
neither moves a row of the fact, whatever its size. The agent dimension lies in as
many buckets. Sources in other layouts work as before, with a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from cratewise.functions.text import clean_text
from cratewise.operators.day_sums import day_sums
from cratewise.operators.mdm import AGENT_KEY
from cratewise.sources.day_store import MONTH, MONTH_OF


class BucketedTables:
    """Catalog tables ``<prefix>_<fact>`` and ``<prefix>_agents``, written anew by every run that asks for them."""

    def __init__(self, spark: SparkSession, prefix: str, buckets: int = 64):
        self.spark, self.prefix, self.buckets = spark, prefix, buckets

    def save(self, df: DataFrame, name: str, by_month: bool) -> DataFrame:
        table = f"{self.prefix}_{name}"
        # Rows of a bucket meet before they are written, so that each bucket of a month is one file.
        dealt = df.repartition(self.buckets, AGENT_KEY)
        writer = dealt.write.mode("overwrite").bucketBy(self.buckets, AGENT_KEY).sortBy(AGENT_KEY)
        (writer.partitionBy(MONTH) if by_month else writer).saveAsTable(table)
        return self.spark.table(table)

    def refreshed(self, name: str, shaped: DataFrame, names: Sequence[str]) -> DataFrame:
        """The day sums of a shaped fact with the agent's lookup key."""
        sums = day_sums(shaped, names).selectExpr("*", f"{clean_text('agent_raw')} as {AGENT_KEY}", MONTH_OF)
        return self.save(sums, name, by_month=True).drop(MONTH)

    def agents(self, dimension: DataFrame) -> DataFrame:
        return self.save(dimension, "agents", by_month=False)
