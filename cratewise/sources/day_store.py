"""Day sums of the facts, kept between runs.

One folder per fact, partitioned by month. A run counts the fact's rows per month
from its day column alone, compares that with the rows its kept sums stand for,
and sums only the months that differ; each is replaced whole. A run over the
same fact with new days therefore reads the months of these days, not the history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise.functions.sql import text
from cratewise.operators.day_sums import ROWS, dated, day_sums, summed

MONTH = "month"
# Rows without a readable day; they still count for the newest cutoff.
UNDATED = "undated"
MONTH_OF = f"coalesce(date_format(event_date, 'yyyy-MM'), '{UNDATED}') as {MONTH}"


class DayStore:
    """``refreshed`` gives a fact's day sums, brought up to date in ``folder``.

    A fact whose figures were corrected without a change of a month's row count
    looks the same; ``rebuild`` sums everything anew.
    """

    def __init__(self, spark: SparkSession, folder: str, rebuild: bool = False):
        self.spark, self.folder, self.rebuild = spark, folder.rstrip("/"), rebuild
        #: The months summed by this run, by fact.
        self.summed: dict[str, list[str]] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def kept(self, name: str, schema) -> DataFrame | None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        if not at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at):
            return None
        return self.spark.read.schema(schema).parquet(self.path(name))

    def refreshed(self, name: str, shaped: DataFrame, names: Sequence[str]) -> DataFrame:
        """The day sums of a shaped fact; one row per month reaches the driver."""
        months = dated(shaped).selectExpr(MONTH_OF).groupBy(MONTH).agg(F.count("*").alias("n"))
        now = {row[MONTH]: row["n"] for row in months.collect()}
        sums = day_sums(shaped, names)
        schema = sums.selectExpr("*", MONTH_OF).schema
        kept = self.kept(name, schema)
        before = {}
        if kept is not None and not self.rebuild:
            before = {row[MONTH]: row["n"] for row in kept.groupBy(MONTH).agg(F.sum(ROWS).alias("n")).collect()}
        changed = sorted(month for month, rows in now.items() if before.get(month) != rows)
        self.summed[name] = changed
        if changed:
            self.write(name, shaped, names, changed, whole=not before)
        present = ", ".join(map(text, now)) or "''"
        return self.spark.read.schema(schema).parquet(self.path(name)).filter(f"{MONTH} in ({present})").drop(MONTH) if now else sums

    def write(self, name: str, shaped: DataFrame, names: Sequence[str], months: Sequence[str], whole: bool) -> None:
        """Replaces the given months; the job's commit publishes them together."""
        if whole:
            sums = day_sums(shaped, names)
        else:
            days = dated(shaped)
            bounds = [f"event_date >= date'{m}-01' and event_date < add_months(date'{m}-01', 1)" for m in months if m != UNDATED]
            bounds += ["event_date is null"] if UNDATED in months else []
            sums = summed(days.filter(" or ".join(f"({b})" for b in bounds)), [*names, "event_date"])
        rows = sums.selectExpr("*", MONTH_OF).repartition(MONTH, *names[:1])
        writer = rows.write.mode("overwrite").partitionBy(MONTH)
        (writer if whole else writer.option("partitionOverwriteMode", "dynamic")).parquet(self.path(name))
