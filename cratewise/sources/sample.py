"""Builds the thirteen input tables from a folder of order and line-item tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise.config import HL_PER_CRATE, REQUIRED_TABLES, ReportConfig

# Columns the input tables are built from; a given schema spares a look at the files.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_orderdate timestamp_ntz",
    "part": "p_partkey bigint, p_brand string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}
UNMATCHED_BRAND = "Brand#25"
# Month and day of a snapshot in the newest year, and the modulus its quantities are cut to.
SNAPSHOTS = ((6, 1, 30), (7, 1, 50))
SALES_FACTOR, SNOP_FACTOR, AOP_FACTOR = 1.10, 1.05, 1.20


def year_range(col: str, year: int) -> Column:
    """Bounds on the raw timestamp, so they reach the file scan."""
    first, after = (F.lit(date(y, 1, 1)).cast("timestamp_ntz") for y in (year, year + 1))
    return (F.col(col) >= first) & (F.col(col) < after)


class SampleTables(Mapping):
    """Input tables over ``<folder>/<table>.parquet``, each built when first asked for.

    The current year is the newest one in which something was shipped or ordered,
    the prior year the one before; the calendar has the days of the year on which
    there ever was an order.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._read: dict[str, DataFrame] = {}
        self._built: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            reader = self.spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else self.spark.read
            self._read[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    @cached_property
    def days(self) -> tuple[date, date]:
        """The newest ship and order dates: two columns, one row each to the driver."""
        newest = [self.table(t).agg(F.max(c).cast("date").alias("day")) for t, c in (("lineitem", "l_shipdate"), ("orders", "o_orderdate"))]
        shipped, ordered = (row["day"] for row in newest[0].unionAll(newest[1]).collect())
        return shipped or ordered or date(1, 1, 1), ordered or shipped or date(1, 1, 1)

    @property
    def year(self) -> int:
        return max(self.days).year

    @property
    def config(self) -> ReportConfig:
        return ReportConfig(default_target_year=self.year)

    def with_names(self, lines: DataFrame) -> DataFrame:
        """Line items with their supplier and brand names."""
        supplier = self.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
        part = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
        return lines.join(supplier, "l_suppkey").join(part, "l_partkey")

    def shipped(self, year: int) -> DataFrame:
        return self.with_names(self.table("lineitem").filter(year_range("l_shipdate", year)))

    @cached_property
    def agents(self) -> DataFrame:
        nation = self.table("nation").select(
            F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("r_regionkey")
        )
        region = self.table("region")
        division = F.when(F.col("s_suppkey") % 10 != 4, F.col("r_name"))
        return (
            self.table("supplier")
            .join(nation, "s_nationkey")
            .join(region, "r_regionkey")
            .select("s_suppkey", "s_name", division.alias("division"))
        )

    def agent_left(self) -> DataFrame:
        return (
            self.agents
            .filter(F.col("s_suppkey") % 10 != 9)
            .select(
                F.col("s_name").alias("Name(S4H_C4C)"),
                F.col("division").alias("DV"),
                F.concat(F.lit("agent-"), F.expr("s_suppkey div 2").cast("string")).alias("Reporting Name"),
                F.struct("s_suppkey").alias("_row_id"),
            )
        )

    def brand_left(self) -> DataFrame:
        is_even = F.substring_index("p_brand", "#", -1).cast("int") % 2 == 0
        return (
            self.table("part")
            .filter(F.col("p_brand") != UNMATCHED_BRAND)
            .select("p_brand")
            .distinct()
            .select(
                F.col("p_brand").alias("Item Description"),
                F.when(is_even, F.concat("p_brand", F.lit(" Beer")))
                .otherwise(F.col("p_brand"))
                .alias("Report Naming"),
                F.struct("p_brand").alias("_row_id"),
            )
        )

    def calendar_mdm(self) -> DataFrame:
        ordered = F.to_date("o_orderdate")
        day = F.try_to_date(F.concat(F.lit(f"{self.year}-"), F.date_format(ordered, "MM-dd")), "yyyy-MM-dd")
        days = self.table("orders").select(day.alias("Date")).filter("Date is not null").distinct()
        flag = F.when(F.dayofweek("Date") != 1, "Yes").otherwise("No")
        return days.select("Date", flag.alias("Working Day"), F.struct("Date").alias("_row_id"))

    def hl_converter(self) -> DataFrame:
        return self.table("part").select("p_brand").distinct().withColumn("HL per Crate", F.lit(HL_PER_CRATE))

    def plant_code(self) -> DataFrame:
        return self.table("nation").select(F.col("n_nationkey").alias("Plant"), F.col("n_name").alias("Name"))

    def shipment(self, year: int) -> DataFrame:
        return self.shipped(year).select(
            F.col("l_shipdate").alias("Date"),
            F.col("s_name").alias("Agent"),
            F.col("p_brand").alias("Item Description"),
            F.col("l_quantity").alias("Invoiced Quantity"),
        )

    def depletion(self, year: int, volume: str) -> DataFrame:
        orders = (
            self.table("orders")
            .filter(year_range("o_orderdate", year))
            .select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
        )
        return (
            # The orders of one year come first, so that the name lookups see fewer rows.
            self.with_names(self.table("lineitem").join(orders, "l_orderkey"))
            .select(
                F.col("o_orderdate").alias("Date"),
                F.upper("s_name").alias("Sales Unit"),
                F.col("p_brand").alias("Product"),
                F.col("l_quantity").alias(volume),
            )
        )

    @cached_property
    def plan_volume(self) -> DataFrame:
        """Prior-year crates by agent, brand and month number, which the targets scale."""
        part = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
        volume = (
            self.table("lineitem")
            .filter(year_range("l_shipdate", self.year - 1))
            .join(part, "l_partkey")
            .groupBy(F.col("l_suppkey").alias("s_suppkey"), "p_brand", F.month("l_shipdate").alias("month"))
            .agg(F.sum("l_quantity").alias("crates"))
        )
        return volume.join(self.agents, "s_suppkey")

    def target(self, month: Column, value: Column, value_name: str, agent: str, brand: str) -> DataFrame:
        return self.plan_volume.select(
            month.alias("Month"),
            F.col("division").alias("Division"),
            F.col("s_name").alias(agent),
            F.col("p_brand").alias(brand),
            value.alias(value_name),
        )

    def sales_target(self) -> DataFrame:
        month = F.col("month").cast("string")
        return self.target(month, F.col("crates") * SALES_FACTOR, "Target", "Sales Unit", "Brand")

    def snop_target(self) -> DataFrame:
        month = F.date_format(F.make_date(F.lit(self.year), "month", F.lit(1)), "MMMM")
        return self.target(month, F.col("crates") * SNOP_FACTOR, "Target Crates", "Agent", "Item Description")

    def aop_target(self) -> DataFrame:
        month = (F.lit(self.year * 100) + F.col("month")).cast("string")
        value = F.col("crates") * AOP_FACTOR * HL_PER_CRATE
        return self.target(month, value, "Target, HL", "Agent", "Item Description")

    def stock(self) -> DataFrame:
        # One column per brand there is: as many as the part table has brands.
        brands = sorted(row[0] for row in self.table("part").select("p_brand").distinct().collect() if row[0])
        per_agent = self.shipped(self.year).groupBy("s_name").pivot("p_brand", brands).agg(F.sum("l_quantity"))
        snapshots = F.array(
            *[F.struct(F.lit(date(self.year, month, day)).alias("day"), F.lit(float(cut)).alias("cut")) for month, day, cut in SNAPSHOTS]
        )
        return per_agent.withColumn("snapshot", F.explode(snapshots)).select(
            F.col("snapshot.day").alias("Reporting Date"),
            F.col("s_name").alias("Agent"),
            *[(F.col(f"`{brand}`") % F.col("snapshot.cut")).alias(f"{brand} Crate 24x33") for brand in brands],
        )

    def build(self, name: str) -> DataFrame:
        if name == "py_shipment":
            return self.shipment(self.year - 1)
        if name == "actual_shipment":
            return self.shipment(self.year)
        if name == "py_depletion":
            return self.depletion(self.year - 1, "Sales")
        if name == "ytd_depletion":
            return self.depletion(self.year, "Depletion")
        return getattr(self, name)()

    def __getitem__(self, name: str) -> DataFrame:
        if name not in REQUIRED_TABLES:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = self.build(name)
        return self._built[name]

    def __iter__(self):
        return iter(REQUIRED_TABLES)

    def __len__(self) -> int:
        return len(REQUIRED_TABLES)


class OddSampleTables(SampleTables):
    """The same tables as an untidy source delivers them.

    Every agent stands twice in the master data, under other names and without a
    division, for some agents first; reporting names differ by what the extract
    evens out; shipments come as text, billed up to two days later; sell-out
    comes in hectolitres.
    """

    def agent_left(self) -> DataFrame:
        pair, even = F.expr("cast(s_suppkey div 2 as string)"), F.col("s_suppkey") % 2 == 0
        named = F.when(even, F.concat(F.lit("agent-"), pair)).otherwise(F.concat(F.lit("AGENT  "), pair))
        turn = F.explode(F.array(F.lit(0), F.lit(1))).alias("turn")
        twice = self.agents.filter(F.col("s_suppkey") % 10 != 9).select("*", named.alias("named"), turn)
        first = F.col("turn") == 0
        place = F.when(F.col("s_suppkey") % 3 == 0, -F.col("turn")).otherwise(F.col("turn"))
        return twice.select(
            F.col("s_name").alias("Name(S4H_C4C)"),
            F.when(first, F.col("division")).alias("DV"),
            F.when(first, F.col("named")).otherwise(F.concat(F.lit("other-"), pair)).alias("Reporting Name"),
            F.struct(place.alias("place"), "s_suppkey").alias("_row_id"),
        )

    def shipment(self, year: int) -> DataFrame:
        billed = F.date_add(F.to_date("l_shipdate"), (F.col("l_orderkey") % 3).cast("int"))
        return self.shipped(year).select(
            F.date_format("l_shipdate", "dd/MM/yyyy").alias("Date"),
            F.date_format(billed, "d-MMM-yyyy").alias("Billing Date"),
            F.col("s_name").alias("Agent"),
            F.col("p_brand").alias("Item Description"),
            F.format_number("l_quantity", 2).alias("Invoiced Quantity"),
        )

    def depletion(self, year: int, volume: str) -> DataFrame:
        rows = super().depletion(year, "Depletion")
        return rows.withColumn("Depletion", F.col("Depletion") * HL_PER_CRATE).withColumnRenamed("Depletion", "Dep HL")
