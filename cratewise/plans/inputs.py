"""Conformed inputs shared by every report: dimensions, shaped facts, dates."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cratewise import config as names
from cratewise.config import ReportConfig
from cratewise.functions.numbers import total
from cratewise.functions.sql import day
from cratewise.operators import calendar as cal
from cratewise.operators import mdm, metrics, stock, targets, volumes
from cratewise.operators.calendar import ReportDates
from cratewise.operators.day_sums import dated, summed
from cratewise.sources.catalog import optional_col
from cratewise.sources.footers import FileBounds


class Inputs:
    """Lazy frames over the raw tables. Only ``dates`` and the stock snapshot
    day run a job: one row each, which then bounds the file scans as literals.

    With ``keep`` every volume fact is read once, as day sums that ``keep``
    stores (``keep(name, shaped fact, source names)``); without it the fact is
    read by whatever asks for it. ``bounds`` tells what the files' footers know.
    """

    def __init__(
        self,
        tables: Mapping[str, DataFrame],
        config: ReportConfig,
        keep: Callable[[str, DataFrame, Sequence[str]], DataFrame] | None = None,
        bounds: FileBounds | None = None,
        keep_agents: Callable[[DataFrame], DataFrame] | None = None,
    ):
        self.tables = tables
        self.config = config
        self.keep = keep
        self.bounds = bounds
        self.keep_agents = keep_agents or (lambda dimension: dimension)

    def fact(self, name: str, shaped: DataFrame, by: Sequence[str]) -> DataFrame:
        """A volume fact with parsed days, or its day sums."""
        return dated(shaped) if self.keep is None else self.keep(name, shaped, by)

    def footer_date(self, table: str, spellings: Sequence[str]) -> date | None:
        """The newest day of a column by the files' footers; None where they don't tell or it is after ``as_of``."""
        column = optional_col(self.tables[table], spellings)
        found = self.bounds.of(table, column) if self.bounds and column else None
        newest = found.largest if found else None
        # Footers tell dates; a whole number would be no day.
        if not isinstance(newest, date) or (self.config.as_of and newest > self.config.as_of):
            return None
        return newest

    @cached_property
    def agents(self) -> DataFrame:
        return self.keep_agents(mdm.agent_dimension(self.tables["agent_left"]))

    @cached_property
    def brands(self) -> DataFrame:
        return mdm.brand_dimension(self.tables["brand_left"], self.config.brand_rules)

    @cached_property
    def calendar(self) -> DataFrame:
        return cal.calendar_dimension(self.tables["calendar_mdm"])

    @cached_property
    def actual(self) -> DataFrame:
        shaped = volumes.shape_shipment(self.tables["actual_shipment"], "actual_shipment", self.config, with_cutoff=True)
        rows = self.fact("actual_shipment", shaped, volumes.SHIPMENT_NAMES)
        if self.config.as_of is None:
            return rows
        capped = f"least(cutoff_date, {day(self.config.as_of)})"
        return rows.filter(f"event_date <= {day(self.config.as_of)}").withColumn("cutoff_date", F.expr(capped))

    @cached_property
    def prior(self) -> DataFrame:
        shaped = volumes.shape_shipment(self.tables["py_shipment"], "py_shipment", self.config)
        return self.fact("py_shipment", shaped, volumes.SHIPMENT_NAMES)

    @cached_property
    def depletion(self) -> DataFrame:
        shaped = volumes.shape_depletion(self.tables["ytd_depletion"], "ytd_depletion", names.DEPLETION_CRATES, self.config)
        return self.fact("ytd_depletion", shaped, volumes.DEPLETION_NAMES)

    @cached_property
    def prior_depletion(self) -> DataFrame:
        shaped = volumes.shape_depletion(self.tables["py_depletion"], "py_depletion", names.PY_DEPLETION_CRATES, self.config)
        return self.fact("py_depletion", shaped, volumes.DEPLETION_NAMES)

    @cached_property
    def shaped_targets(self) -> DataFrame:
        return targets.shape_targets(
            self.tables["aop_target"], self.tables["sales_target"], self.tables["snop_target"], self.config
        )

    @cached_property
    def dates(self) -> ReportDates:
        # Day sums are at hand and small; of the fact itself the footers may spare a scan.
        known = self.footer_date("actual_shipment", names.CUTOFF_DATE) if self.keep is None else None
        return ReportDates.resolve(cal.report_dates(self.calendar, *cal.last_dates(self.actual, known)))

    @cached_property
    def month_progress(self) -> DataFrame:
        return cal.month_progress(self.calendar, self.dates.last_date)

    @cached_property
    def phased_targets(self) -> DataFrame:
        """Target rows phased to date, for totals that need no brand lookup."""
        return targets.target_to_date(self.shaped_targets, self.month_progress)

    @cached_property
    def targets(self) -> DataFrame:
        """Target rows phased to date, with their brand names."""
        return targets.conform_targets(self.phased_targets, self.brands, self.config)

    @cached_property
    def stock_long(self) -> DataFrame:
        return stock.stock_long(self.tables["stock"], self.config, self.footer_date("stock", names.STOCK_DATE))

    def shipment_counts(self) -> DataFrame:
        """Crates and row_count up to the last date per pair of source names, conformed."""
        rows = self.actual.filter(f"event_date <= {day(self.dates.last_date)}")
        return mdm.conform_shipment(summed(rows, volumes.SHIPMENT_NAMES), self.agents, self.brands, self.config.brand_rules)

    def shipment(self, *, to_date: bool = False, observed: Observation | None = None) -> DataFrame:
        """Sell-in window sums per source-name pair, conformed; ``to_date``
        adds the sum over all rows up to the last date. ``observed`` sees the
        sums as they come from the source, before any lookup."""
        windows = volumes.shipment_windows(self.dates)
        if to_date:
            windows["to_date"] = (None, self.dates.last_date)
        sums = volumes.window_sums(
            self.actual, windows, volumes.SHIPMENT_NAMES, metrics.SHIPMENT_RANKS, until=self.dates.last_date
        )
        if observed is not None:
            sums = sums.observe(observed, *[F.expr(total(name, name)) for name in windows])
        return mdm.conform_shipment(sums, self.agents, self.brands, self.config.brand_rules)

    def py_shipment(self, *, to_date: bool = False) -> DataFrame:
        windows = volumes.py_shipment_windows(self.dates)
        if to_date:
            windows["to_date"] = (None, self.dates.py_cutoff)
        sums = volumes.window_sums(
            self.prior, windows, volumes.SHIPMENT_NAMES, metrics.PY_SHIPMENT_RANKS, until=self.dates.py_cutoff
        )
        return mdm.conform_shipment(sums, self.agents, self.brands, self.config.brand_rules)

    def depletion_sums(self) -> DataFrame:
        sums = volumes.window_sums(
            self.depletion, volumes.depletion_windows(self.dates), volumes.DEPLETION_NAMES, metrics.DEPLETION_RANKS
        )
        return mdm.conform_depletion(sums, self.agents, self.config.brand_rules)

    def py_depletion_sums(self) -> DataFrame:
        sums = volumes.window_sums(
            self.prior_depletion, volumes.py_depletion_windows(self.dates), volumes.DEPLETION_NAMES
        )
        return mdm.conform_depletion(sums, self.agents, self.config.brand_rules)

    def target_sums(self) -> DataFrame:
        sums = targets.target_window_sums(self.shaped_targets, self.calendar, self.dates)
        return targets.conform_target_sums(sums, self.agents, self.brands, self.config)

    def stock(self) -> DataFrame:
        return stock.conform_stock(self.stock_long, self.agents, self.config.brand_rules)

    def metric_parts(self, observed: Observation | None = None) -> list[DataFrame]:
        """Every fact's measures by key; ``observed`` sees the sell-in sums of the source."""
        shipment = self.shipment(to_date=observed is not None, observed=observed)
        return [
            metrics.metric_rows(shipment, metrics.SHIPMENT_MEASURES),
            metrics.metric_rows(self.py_shipment(), metrics.PY_SHIPMENT_MEASURES),
            metrics.metric_rows(self.target_sums(), targets.TARGET_MEASURES),
            metrics.metric_rows(self.stock(), ["beginning_stock"]),
            metrics.metric_rows(self.depletion_sums(), metrics.DEPLETION_MEASURES),
            metrics.metric_rows(self.py_depletion_sums(), metrics.PY_DEPLETION_MEASURES),
        ]
