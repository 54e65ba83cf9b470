"""One run: raw tables in, every report and check out."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cratewise.config import ReportConfig
from cratewise.functions.numbers import total
from cratewise.operators import calendar, metrics, stock, targets
from cratewise.operators.day_sums import day_sums
from cratewise.plans import checks, wide
from cratewise.plans.extract import extract_rows, final_extract
from cratewise.plans.inputs import Inputs
from cratewise.plans.regional import regional_report
from cratewise.session import checkpointed
from cratewise.sources.day_store import DayStore
from cratewise.sources.layout import BucketedTables
from cratewise.sources.catalog import assert_unique_columns, register_views, require_tables, tag_sources


class ReportBundle:
    """Lazy reports over one set of inputs.

    With ``reuse`` the metric table, the conformed stock, the extract rows and
    their totals are checkpointed once, since many outputs read them. While the
    metric table is written, the sell-in sums on both sides of its lookups are
    observed, so that the gate needs no pass of its own.
    """

    def __init__(self, inputs: Inputs, reuse: bool = False):
        self.inputs = inputs
        self.config = inputs.config
        self.reuse = reuse
        self._keep = checkpointed if reuse else lambda df: df
        #: Sell-in totals seen on the way: to_date and mtd of the source, ytd and mtd of the metric table.
        self.observed: dict[str, float] = {}

    @cached_property
    def metric_table(self) -> DataFrame:
        if not self.reuse:
            return wide.metric_table(self.inputs)
        source, final = Observation(), Observation()
        sums = [F.expr(total(f"{p}_shipment", f"final_{p}")) for p in ("ytd", "mtd")]
        table = checkpointed(wide.metric_table(self.inputs, source, kept=True).observe(final, *sums))
        seen = source.get
        self.observed = {"source_ytd": seen["to_date"], "source_mtd": seen["mtd_shipment"], **final.get}
        return table

    @cached_property
    def conformed_stock(self) -> DataFrame:
        return self._keep(self.inputs.stock())

    def opening_stock(self) -> DataFrame:
        return stock.opening_stock(self.conformed_stock)

    @cached_property
    def kpi_wide(self) -> DataFrame:
        return wide.kpi_wide(self.inputs, self.metric_table)

    @cached_property
    def uom_report(self) -> DataFrame:
        return wide.uom_report(self.kpi_wide, self.config.hl_per_crate)

    @cached_property
    def extract_rows(self) -> DataFrame:
        rows = extract_rows(self.metric_table, self.conformed_stock, self.inputs.dates, self.config)
        return self._keep(rows)

    @cached_property
    def final_extract(self) -> DataFrame:
        return assert_unique_columns(final_extract(self.extract_rows))

    def regional_report(self) -> DataFrame:
        return regional_report(self.inputs)

    def regional_target_pivot(self) -> DataFrame:
        return targets.pivot_by_type(self.inputs.phased_targets, ["dv"], "target_crates_to_date")

    def key_spine(self) -> DataFrame:
        return self.metric_table.select(*metrics.KEYS, "division", "agent", "brand")

    def reconciliation(self) -> DataFrame:
        return checks.reconciliation(self.inputs, self.metric_table)

    def assert_reconciled(self) -> None:
        """Raises where the metric table lost or gained sell-in.

        What was observed settles it if it agrees. Tasks that ran twice after a
        lost executor are observed twice, so a difference is looked at again in
        the tables themselves before it raises.
        """
        table = self.metric_table
        if self.observed and checks.same_total(self.observed["source_ytd"], self.observed["final_ytd"]):
            return
        checks.assert_reconciled(checks.reconciliation(self.inputs, table))

    @cached_property
    def level_totals(self) -> DataFrame:
        return self._keep(checks.level_totals(self.extract_rows))

    def reports(self) -> dict[str, DataFrame]:
        """The reports beside the extract, under their headers and in their order."""
        return {
            "regional": self.regional_report(),
            "wide": wide.with_report_names(wide.sorted_report(self.kpi_wide)),
            "two_units": wide.with_report_names(self.uom_report),
        }

    def checks(self) -> dict[str, DataFrame]:
        """Every check table by name."""
        inputs = self.inputs
        shipment, py_shipment = inputs.shipment(to_date=True), inputs.py_shipment(to_date=True)
        by_unit, by_unit_and_type = (checks.at_level(self.level_totals, keys) for keys in (("UOM",), checks.UNIT_AND_TYPE))
        period_totals = by_unit_and_type.select(*checks.UNIT_AND_TYPE, *checks.PERIOD_COLUMNS)
        return {
            "unmatched_target_brands": checks.unmatched_target_brands(inputs.targets),
            "unmatched_actual_agents": checks.unmatched_agents(shipment),
            "unmatched_py_agents": checks.unmatched_agents(py_shipment),
            "unmatched_actual_brands": checks.unmatched_brands(shipment),
            "unmatched_py_brands": checks.unmatched_brands(py_shipment),
            "target_totals": checks.target_totals(inputs.phased_targets),
            "duplicate_calendar_days": calendar.duplicate_calendar_days(inputs.tables["calendar_mdm"]),
            "month_progress": inputs.month_progress.orderBy("month_start"),
            "month_parse": checks.month_parse_check(inputs.shaped_targets),
            "aop_by_month": targets.aop_by_month(inputs.phased_targets),
            "shipment_totals": checks.shipment_totals(inputs),
            "date_range": checks.date_range_check(inputs),
            "stock_by_column": stock.stock_by_column(inputs.stock_long),
            "reconciliation": self.reconciliation(),
            "period_source_vs_merged": checks.period_source_vs_merged(inputs, self.metric_table),
            "agent_consolidation": checks.agent_consolidation(self.key_spine()),
            "missing_division": checks.missing_division(self.metric_table),
            "totals_by_uom": checks.totals_by_uom(self.uom_report),
            "totals_by_level": self.level_totals,
            "totals_by_uom_type": checks.with_total_ratios(by_unit_and_type),
            "stock_totals": checks.shown_stock_totals(by_unit_and_type),
            "stock_before_after": checks.shown_stock_change(by_unit),
            "period_totals": period_totals,
            "zero_period_rows": checks.zero_period_rows(period_totals),
            "zero_period_agents": checks.zero_period_rows(checks.period_totals(self.extract_rows, ("Agent",))),
            "labels": checks.distinct_labels(self.extract_rows),
        }


def build_report(
    tables: Mapping[str, DataFrame],
    config: ReportConfig | None = None,
    *,
    reuse: bool = False,
    reconcile: bool = False,
    store: DayStore | BucketedTables | None = None,
) -> ReportBundle:
    """Checks the table contract and returns the reports of one run.

    ``reuse`` reads every volume fact once and keeps what several reports need;
    with a ``DayStore`` the day sums are kept between runs as well, and only
    months that are new or changed are summed; with ``BucketedTables`` they lie
    so that lookups move none of their rows. ``reconcile`` runs the year-to-date gate at once and raises where the
    metric table lost or gained sell-in.
    """
    require_tables(tables)
    tagged = tag_sources(tables)
    register_views(tagged)
    keep = None
    if reuse:
        keep = store.refreshed if store else lambda name, shaped, by: checkpointed(day_sums(shaped, by))
    keep_agents = store.agents if isinstance(store, BucketedTables) else None
    inputs = Inputs(tagged, config or ReportConfig(), keep, getattr(tables, "bounds", None), keep_agents)
    bundle = ReportBundle(inputs, reuse)
    if reconcile:
        bundle.assert_reconciled()
    return bundle


def register_conformed(inputs: Inputs) -> list[str]:
    """Temporary views of the conformed dimensions and targets."""
    selected = F.col("target_type") == inputs.config.selected_target_type
    views = {
        "dim_agent_reporting": inputs.agents,
        "dim_brand_reporting": inputs.brands,
        "dim_calendar_days": inputs.calendar,
        "fact_target": inputs.targets,
        "selected_target": inputs.targets.filter(selected),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
