"""Every operator as a query over the sample tables.

Doubles are rounded once, at the end, so that results compare across engines:
ratios to eight places, volumes to four.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratewise.config import BrandRules, ReportConfig
from cratewise.functions import dates as fd
from cratewise.functions import numbers as fn
from cratewise.functions import text as ft
from cratewise.functions.sql import quoted
from cratewise.operators import calendar as cal
from cratewise.operators import kpi, mdm, metrics, stock, targets
from cratewise.plans import checks
from cratewise.plans.inputs import Inputs
from cratewise.plans.report import ReportBundle
from cratewise.plans.wide import with_report_names
from cratewise.session import configure, shared_path
from cratewise.sources.extract import EXTRACT_COLUMNS, PERIODS, completed, period_columns, read_extract, write_extract
from cratewise.sources.sample import OddSampleTables, SampleTables

# Rules of the family test: words of part names stand in for brand families.
FAMILY_RULES = BrandRules(
    replacements=(("HOT BOLT", "STEEL BOLT"), ("RED", "STEEL")),
    families=("STEEL BOLT", "STEEL", "BOLT", "SMALL"),
    display_names=(("STEEL BOLT", "Steel bolt (hot)"), ("SMALL", "Small parts")),
)
RATIO_MARKS = ("pct", "ratio", "days_of_stock", "Days of Stock", "Days_of_Stock", " Ach", " vs PY", "VS PY", "%")


def is_ratio(name: str) -> bool:
    return any(mark in name for mark in RATIO_MARKS)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to their comparison precision; negative zero becomes zero.

    The order of a sum moves a double's last digits, and with them a value that
    lies on the border of two rounded ones, so these digits go first.
    """
    columns = []
    for field in df.schema.fields:
        value = quoted(field.name)
        if isinstance(field.dataType, T.DoubleType):
            scale = "1e8D" if is_ratio(field.name) else "1e4D"
            value = f"rint(rint({value} * {scale} * 1e4D) / 1e4D) / {scale} + 0.0D as {value}"
        columns.append(value)
    return df.selectExpr(*columns)


class Run:
    """One query's view of the engine over a folder of tables."""

    def __init__(self, spark: SparkSession, folder: str, tables: type[SampleTables] = SampleTables):
        self.sample = tables(configure(spark), folder)

    @cached_property
    def config(self) -> ReportConfig:
        return self.sample.config

    @cached_property
    def inputs(self) -> Inputs:
        return Inputs(self.sample, self.config)

    @cached_property
    def bundle(self) -> ReportBundle:
        return ReportBundle(self.inputs)

    def as_of_orders(self) -> Inputs:
        """The report as it was on the last day with an order, where shipments go on after it."""
        return Inputs(self.sample, self.config.with_options(as_of=min(self.sample.days)))

    def table(self, name: str) -> DataFrame:
        return self.sample.spark.read.parquet(f"{self.sample.folder}/{name}.parquet")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Run], DataFrame]) -> Callable[[Run], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(build(Run(spark, folder)))

    QUERIES[build.__name__] = run
    return build


def odd(run: Run) -> Run:
    """The same run over the tables as an untidy source delivers them."""
    return Run(run.sample.spark, run.sample.folder, OddSampleTables)


def name_sums(conformed: DataFrame, measures: list[str]) -> DataFrame:
    """Measures by division, agent and brand key; groups outside every window are left out."""
    grouped = conformed.groupBy("division", "agent_key", "agent", "brand_kpi_key")
    present = f"max(coalesce({', '.join(measures)}) is not null) as present"
    kept = grouped.agg(F.expr(present), *[F.expr(t) for t in fn.totals(measures)])
    return kept.filter("present").drop("present")


# -- volumes ----------------------------------------------------------------


@query
def shipment_mtd_ytd(run: Run) -> DataFrame:
    return name_sums(run.inputs.shipment(), ["mtd_shipment", "ytd_shipment"])


@query
def shipment_py_mtd_ytd(run: Run) -> DataFrame:
    return name_sums(run.inputs.py_shipment(), ["mtd_py_shipment", "ytd_py_shipment"])


@query
def depletion_mtd_ytd(run: Run) -> DataFrame:
    return name_sums(run.inputs.depletion_sums(), ["mtd_depletion", "ytd_depletion"])


@query
def depletion_py_windows(run: Run) -> DataFrame:
    return name_sums(run.inputs.py_depletion_sums(), metrics.PY_DEPLETION_MEASURES)


@query
def last_day_wtd_shipment(run: Run) -> DataFrame:
    return name_sums(run.inputs.shipment(), ["last_day_shipment", "wtd_shipment"])


@query
def last_day_wtd_depletion(run: Run) -> DataFrame:
    return name_sums(run.inputs.depletion_sums(), ["last_day_depletion", "wtd_depletion"])


@query
def last_day_wtd_depletion_as_of(run: Run) -> DataFrame:
    """The same on the last day with an order, when there is sell-out to see."""
    return name_sums(run.as_of_orders().depletion_sums(), ["last_day_depletion", "wtd_depletion"])


# -- master data and text ---------------------------------------------------


@query
def agent_mdm(run: Run) -> DataFrame:
    return run.inputs.agents


@query
def brand_mdm(run: Run) -> DataFrame:
    return run.inputs.brands.select("brand_key", "reporting_name", "brand_kpi_key")


@query
def agent_conform(run: Run) -> DataFrame:
    """Sell-in with conformed names, its rows counted per source name."""
    keys = ["agent_source_name", "agent", "agent_key", "division", "agent_match", "brand_match"]
    return run.inputs.shipment_counts().groupBy(*keys).agg(F.sum("row_count").alias("row_count"), F.sum("crates").alias("crates"))


@query
def clean_text_keys(run: Run) -> DataFrame:
    padded = "concat(' \\t', text, '   \\n')"
    keys = run.table("documents").selectExpr("doc_id", f"{ft.clean_text(padded)} as key")
    return keys.selectExpr("doc_id", "md5(key) as key_hash", "cast(length(key) as bigint) as key_length")


@query
def proper_text_names(run: Run) -> DataFrame:
    shown = run.table("documents").selectExpr("doc_id", f"{ft.proper_text('text')} as shown")
    return shown.selectExpr("doc_id", "md5(shown) as text_hash", "cast(length(shown) as bigint) as text_length")


@query
def brand_kpi_keys(run: Run) -> DataFrame:
    key = ft.brand_kpi_key("concat(p_name, ' Beer  Crate 24x33 ', p_type)", FAMILY_RULES)
    plain = ft.brand_kpi_key("p_brand", BrandRules())
    keys = run.table("part").selectExpr("p_partkey", f"{key} as brand_kpi_key", f"{plain} as plain_key")
    return keys.selectExpr("*", f"{ft.brand_display_name('brand_kpi_key', FAMILY_RULES)} as brand")


def amount_text() -> Column:
    """Order totals in the spellings a sheet may hold, by order key."""
    plain = F.format_number("o_totalprice", 2)
    style = F.col("o_orderkey") % 8
    return (
        F.when(style == 0, plain)
        .when(style == 1, F.concat(F.lit("-"), plain))
        .when(style == 2, F.concat(F.lit("("), plain, F.lit(")")))
        .when(style == 3, F.concat(F.col("o_orderkey").cast("string"), F.lit("-3")))
        .when(style == 4, F.concat(F.lit("  "), plain, F.lit("\t")))
        .when(style == 5, F.lit("-"))
        .when(style == 6, F.concat(F.col("o_custkey").cast("string"), F.lit("d")))
        .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit("e+2")))
    )


@query
def to_number_compat(run: Run) -> DataFrame:
    orders = run.table("orders").select("o_orderkey", amount_text().alias("t"))
    return orders.selectExpr("o_orderkey", f"{fn.to_number('t', 'compat')} as amount")


@query
def to_number_signed(run: Run) -> DataFrame:
    orders = run.table("orders").select("o_orderkey", amount_text().alias("t"))
    return orders.selectExpr("o_orderkey", f"{fn.to_number('t', 'signed')} as amount")


@query
def unit_and_type_labels(run: Run) -> DataFrame:
    """Unit and target-type spellings, from order priorities as stand-in labels."""
    uom = F.when(F.col("o_orderkey") % 3 == 0, " hl ").when(F.col("o_orderkey") % 3 == 1, "CRATES").otherwise(
        F.col("o_orderpriority")
    )
    kind = (
        F.when(F.col("o_orderkey") % 4 == 0, "sales target")
        .when(F.col("o_orderkey") % 4 == 1, " Snop")
        .when(F.col("o_orderkey") % 4 == 2, "aop ")
        .otherwise(F.col("o_orderstatus"))
    )
    labels = run.table("orders").select(uom.alias("u"), kind.alias("k"))
    labels = labels.selectExpr(f"{ft.normalize_uom('u')} as uom", f"{ft.normalize_target_type('k')} as target_type")
    return labels.groupBy("uom", "target_type").agg(F.count("*").alias("row_count"))


# -- dates ------------------------------------------------------------------


def date_text() -> Column:
    """Order dates in the spellings a sheet may hold, by order key."""
    day, style = F.col("o_orderdate"), F.col("o_orderkey") % 8
    return (
        F.when(style == 0, F.date_format(day, "dd/MM/yyyy"))
        .when(style == 1, F.date_format(day, "yyyy-MM-dd"))
        .when(style == 2, F.date_format(day, "dd-MMM-yyyy"))
        .when(style == 3, F.date_format(day, "dd.MM.yyyy"))
        .when(style == 4, F.concat(F.lit(" "), F.date_format(day, "d/M/yyyy HH:mm")))
        .when(style == 5, F.date_format(day, "yyyyMMdd"))
        .when(style == 6, F.date_format(day, "MMMM d, yyyy"))
        .otherwise(F.concat(F.lit("31/02/"), F.date_format(day, "yyyy")))
    )


@query
def dayfirst_parse(run: Run) -> DataFrame:
    orders = run.table("orders").select("o_orderkey", date_text().alias("t"))
    return orders.selectExpr("o_orderkey", f"{fd.parse_date('t')} as order_day")


def month_text() -> Column:
    """Order months in the spellings a target sheet may hold, by order key."""
    day, style = F.col("o_orderdate"), F.col("o_orderkey") % 10
    return (
        F.when(style == 0, F.month(day).cast("string"))
        .when(style == 1, F.date_format(day, "MMM"))
        .when(style == 2, F.lower(F.date_format(day, "MMMM")))
        .when(style == 3, F.date_format(day, "yyyyMM"))
        .when(style == 4, F.datediff(F.to_date(day), F.lit(fd.SERIAL_ORIGIN).cast("date")).cast("string"))
        .when(style == 5, F.date_format(day, "MMMM yyyy"))
        .when(style == 6, F.date_format(day, "dd/MM/yyyy"))
        .when(style == 7, F.date_format(day, "d-MMM"))
        .when(style == 8, F.date_format(day, "yyyy"))
        .otherwise(F.concat((F.month(day) + 12).cast("string"), F.lit("x")))
    )


@query
def target_month_parse(run: Run) -> DataFrame:
    counted = run.table("orders").groupBy(month_text().alias("month_raw")).agg(F.count("*").alias("row_count"))
    parsed = fd.parse_target_month("month_raw", run.config.default_target_year)
    return counted.selectExpr("*", f"{parsed} as month_start")


@query
def py_day_map(run: Run) -> DataFrame:
    """Order days on the report year's calendar, with the working-day flag found there."""
    days = run.table("orders").groupBy(F.to_date("o_orderdate").alias("order_day")).agg(F.count("*").alias("row_count"))
    mapped = fd.same_day_in_year("order_day", run.config.default_target_year)
    return cal.with_working_day(days.selectExpr("*", f"{mapped} as mapped_day"), "mapped_day", run.inputs.calendar)


@query
def working_day_flag(run: Run) -> DataFrame:
    style = F.col("l_orderkey") % 9
    tokens = ("Yes", " y", "TRUE", "1", "1.0", "No", "working day ", "Working")
    flag = F.lit(None).cast("string")
    for position, token in enumerate(tokens):
        flag = F.when(style == position, F.lit(token)).otherwise(flag)
    counted = run.table("lineitem").groupBy(flag.alias("flag")).agg(F.count("*").alias("row_count"))
    return counted.selectExpr("*", f"{ft.working_day_flag('flag')} as is_working_day")


@query
def month_progress(run: Run) -> DataFrame:
    return run.inputs.month_progress


@query
def month_progress_check(run: Run) -> DataFrame:
    ordered = run.inputs.month_progress.orderBy("month_start")
    return ordered.selectExpr("*", f"{fn.show_percent('ratio')} as shown")


@query
def report_dates(run: Run) -> DataFrame:
    return cal.report_dates(run.inputs.calendar, *cal.last_dates(run.inputs.actual))


@query
def working_day_split(run: Run) -> DataFrame:
    return checks.working_day_split(run.inputs)


@query
def calendar_days(run: Run) -> DataFrame:
    return run.inputs.calendar


@query
def date_range_check(run: Run) -> DataFrame:
    return checks.date_range_check(run.inputs)


# -- targets ----------------------------------------------------------------


@query
def target_conform(run: Run) -> DataFrame:
    conformed = targets.conform_targets(run.inputs.shaped_targets, run.inputs.brands, run.config)
    return conformed.select(
        "target_type", "month_raw", "month_start", "dv", "agent", "original_brand", "brand_key",
        "reporting_name", "brand_match", "source_uom", "target_hl", "target_crates",
    )


@query
def target_to_date(run: Run) -> DataFrame:
    return run.inputs.targets.select(
        "target_type", "month_raw", "agent", "original_brand", "ratio",
        "month_working_days", "elapsed_working_days", "target_hl_to_date", "target_crates_to_date",
    )


@query
def target_totals(run: Run) -> DataFrame:
    return checks.target_totals(run.inputs.phased_targets)


@query
def aop_month_check(run: Run) -> DataFrame:
    return targets.aop_by_month(run.inputs.phased_targets)


@query
def month_parse_check(run: Run) -> DataFrame:
    return checks.month_parse_check(run.inputs.shaped_targets)


@query
def regional_target(run: Run) -> DataFrame:
    return targets.regional_targets(run.inputs.phased_targets)


@query
def regional_target_pivot(run: Run) -> DataFrame:
    return run.bundle.regional_target_pivot()


@query
def selected_target_region(run: Run) -> DataFrame:
    return targets.selected_target_by_region(run.inputs.phased_targets, run.config.selected_target_type)


@query
def regional_actual_vs_target_py(run: Run) -> DataFrame:
    return run.bundle.regional_report()


def target_sums(run: Run, windows: tuple[str, ...]) -> DataFrame:
    columns = [targets.target_column(w, t) for w in windows for t in targets.TARGET_TYPES]
    keys = ("division", "agent_key", "agent", "brand_kpi_key")
    rows = run.inputs.target_sums().na.drop("any", subset=list(keys))
    return rows.groupBy(*keys).agg(*[F.expr(t) for t in fn.totals(columns)])


@query
def target_windows_pivot(run: Run) -> DataFrame:
    return target_sums(run, ("mtd", "ytd", "full_month", "full_year"))


@query
def period_target_pivot(run: Run) -> DataFrame:
    return target_sums(run, ("last_day", "wtd"))


# -- stock ------------------------------------------------------------------


@query
def opening_stock(run: Run) -> DataFrame:
    return stock.opening_stock(run.inputs.stock())


@query
def stock_by_column(run: Run) -> DataFrame:
    return stock.stock_by_column(run.inputs.stock_long)


# -- wide table -------------------------------------------------------------


@query
def key_spine(run: Run) -> DataFrame:
    return metrics.key_spine(run.inputs.metric_parts(), run.config.brand_rules)


@query
def kpi_wide(run: Run) -> DataFrame:
    return run.bundle.kpi_wide


@query
def stock_cover(run: Run) -> DataFrame:
    return kpi.add_stock_cover(run.bundle.metric_table, run.inputs.dates).select(
        *metrics.KEYS, "beginning_stock", "stock_balance", "avg_daily_depletion", "days_of_stock"
    )


@query
def landing(run: Run) -> DataFrame:
    return kpi.add_landing(run.bundle.metric_table, run.inputs.dates).select(
        *metrics.KEYS, "avg_daily_mtd_shipment", "avg_daily_ytd_shipment", "mtd_landing", "yearly_landing"
    )


@query
def achievement(run: Run) -> DataFrame:
    ratios = [c for c in kpi.WIDE_MEASURES if c.endswith("_pct") or "variance" in c]
    return run.bundle.kpi_wide.select(*metrics.KEYS, *ratios)


@query
def uom_report(run: Run) -> DataFrame:
    return with_report_names(run.bundle.uom_report)


@query
def agent_consolidation(run: Run) -> DataFrame:
    return checks.agent_consolidation(run.bundle.key_spine())


@query
def missing_division(run: Run) -> DataFrame:
    return checks.missing_division(run.bundle.key_spine())


@query
def reconciliation(run: Run) -> DataFrame:
    return run.bundle.reconciliation()


@query
def period_source_vs_merged(run: Run) -> DataFrame:
    return checks.period_source_vs_merged(run.inputs, run.bundle.metric_table)


@query
def totals_by_uom(run: Run) -> DataFrame:
    return checks.totals_by_uom(run.bundle.uom_report)


# -- coverage and totals ----------------------------------------------------


@query
def unmatched_brands(run: Run) -> DataFrame:
    """Unmatched brands of the targets and of both sell-in tables."""
    sold = [
        checks.unmatched_brands(rows).withColumn("target_type", F.lit(label))
        for label, rows in (("Actual", run.inputs.shipment(to_date=True)), ("PY", run.inputs.py_shipment(to_date=True)))
    ]
    return checks.unmatched_target_brands(run.inputs.targets).unionByName(sold[0]).unionByName(sold[1])


@query
def unmatched_agents(run: Run) -> DataFrame:
    sold = [
        checks.unmatched_agents(rows).withColumn("source", F.lit(label))
        for label, rows in (("Actual", run.inputs.shipment(to_date=True)), ("PY", run.inputs.py_shipment(to_date=True)))
    ]
    return sold[0].unionByName(sold[1])


@query
def shipment_totals(run: Run) -> DataFrame:
    return checks.shipment_totals(run.inputs)


# -- extract ----------------------------------------------------------------


@query
def final_extract(run: Run) -> DataFrame:
    return run.bundle.final_extract


@query
def growth_ratios(run: Run) -> DataFrame:
    ratios = [name for period in PERIODS for name in period_columns(period) if is_ratio(name)]
    keys = [f"`{name}`" for name in EXTRACT_COLUMNS[:5]]
    return run.bundle.extract_rows.select(*keys, *[f"`{name}`" for name in ratios])


@query
def stock_flag_counts(run: Run) -> DataFrame:
    return run.bundle.extract_rows.groupBy("UOM", "Target Type", "Stock Level Flag").agg(F.count("*").alias("row_count"))


@query
def totals_by_uom_type(run: Run) -> DataFrame:
    return checks.totals_by_uom_type(run.bundle.extract_rows)


@query
def stock_totals(run: Run) -> DataFrame:
    return checks.stock_totals(run.bundle.extract_rows)


@query
def stock_before_after(run: Run) -> DataFrame:
    return checks.stock_before_after(run.bundle.extract_rows)


@query
def period_totals(run: Run) -> DataFrame:
    return checks.period_totals(run.bundle.extract_rows)


@query
def zero_period_rows(run: Run) -> DataFrame:
    return checks.zero_period_rows(checks.period_totals(run.bundle.extract_rows))


@query
def zero_period_agents(run: Run) -> DataFrame:
    """Agents without sell-in on the last day and in its week."""
    return checks.zero_period_rows(checks.period_totals(run.bundle.extract_rows, ("Agent",)))


@query
def totals_by_level(run: Run) -> DataFrame:
    return checks.level_totals(run.bundle.extract_rows)


@query
def extract_completed(run: Run) -> DataFrame:
    """An extract of an earlier layout, without two columns and with one under another name, brought to the schema."""
    earlier = run.bundle.final_extract.drop("WTD_Depletion_PY", "Avg_Daily_Depletion")
    return completed(earlier.withColumnRenamed("Beginning_Stock", "Opening_Stock"))


@query
def extract_labels(run: Run) -> DataFrame:
    return checks.distinct_labels(run.bundle.extract_rows)


# -- untidy sources ---------------------------------------------------------


@query
def odd_report_dates(run: Run) -> DataFrame:
    """Text days, and a cutoff column of its own that runs beyond the last day with volume."""
    return report_dates(odd(run))


@query
def odd_agent_mdm(run: Run) -> DataFrame:
    """Of two rows of an agent the first one counts."""
    return agent_mdm(odd(run))


@query
def odd_depletion(run: Run) -> DataFrame:
    """Sell-out that comes in hectolitres."""
    return depletion_mtd_ytd(odd(run))


@query
def odd_extract(run: Run) -> DataFrame:
    """Names that the extract evens out and sums."""
    return final_extract(odd(run))


PREVIEW_ROWS = 100


@query
def extract_preview(run: Run) -> DataFrame:
    """The rows of largest year-to-date sales, a top-k report over the whole extract."""
    keys = ["UOM", "Target Type", "Division", "Agent", "Brand"]
    order = [F.desc_nulls_last("YTD_Sales"), *[F.asc_nulls_last(name) for name in keys]]
    shown = run.bundle.extract_rows.select(*keys, "YTD_Sales", "YTD_PY", "YTD VS PY Ach")
    return checks.preview(shown, order, PREVIEW_ROWS)


@query
def display_format(run: Run) -> DataFrame:
    styles = {
        "YTD_Sales": 2,
        "MTD_Sales": 0,
        "Avg_Daily_Depletion": 3,
        "YTD VS PY Ach": "+%",
        "MTD Sales vs PY": "%",
    }
    keys = ["UOM", "Target Type", "Division", "Agent", "Brand"]
    return checks.display_text(run.bundle.extract_rows.select(*keys, *[f"`{n}`" for n in styles]), styles)


@query
def extract_csv_roundtrip(run: Run) -> DataFrame:
    """The extract written as CSV and read back with its fixed schema."""
    folder = shared_path(run.sample.spark, "extract")
    write_extract(run.bundle.final_extract, folder, "csv")
    return read_extract(run.sample.spark, folder)
