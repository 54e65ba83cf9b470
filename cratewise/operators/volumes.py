"""Sell-in and sell-out facts: shaping and windowed sums.

A fact is reduced to one row per pair of *source* names before any lookup.
The reduction is a hash aggregate with a map-side part, so a name that holds a
third of all rows arrives as one row per task, and the text rules run once per
name pair instead of once per row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise import config as names
from cratewise.config import ReportConfig
from cratewise.functions.dates import day_or_text
from cratewise.functions.numbers import number_from
from cratewise.functions.sql import day, number, quoted
from cratewise.operators.calendar import ReportDates
from cratewise.operators.mdm import AGENT_KEY
from cratewise.sources.catalog import find_col, optional_col, type_of

SHIPMENT_NAMES = ("agent_raw", "item_raw")
DEPLETION_NAMES = ("agent_raw", "item_raw", "dv_raw")
Window = tuple[date | None, date]


def shape_shipment(df: DataFrame, table: str, config: ReportConfig, with_cutoff: bool = False) -> DataFrame:
    """event_date, agent_raw, item_raw, crates (and cutoff_date); days that are text stay text (see ``day_sums``)."""
    event = find_col(df, names.EVENT_DATE, table)
    crates = find_col(df, names.SHIPMENT_CRATES, table)
    columns = [
        f"{day_or_text(quoted(event), type_of(df, event))} as event_date",
        f"cast({quoted(find_col(df, names.SHIPMENT_AGENT, table))} as string) as agent_raw",
        f"cast({quoted(find_col(df, names.SHIPMENT_ITEM, table))} as string) as item_raw",
        f"{number_from(quoted(crates), type_of(df, crates), config.number_mode)} as crates",
    ]
    if with_cutoff:
        cutoff = find_col(df, names.CUTOFF_DATE, table)
        columns.append(f"{day_or_text(quoted(cutoff), type_of(df, cutoff))} as cutoff_date")
    return df.selectExpr(*columns)


def shape_depletion(df: DataFrame, table: str, crate_names: Sequence[str], config: ReportConfig) -> DataFrame:
    """As ``shape_shipment`` plus dv_raw; a hectolitre column is preferred over crates."""
    event = find_col(df, names.DEPLETION_DATE, table)
    in_hl = optional_col(df, names.DEPLETION_HL)
    volume = in_hl or find_col(df, crate_names, table)
    crates = number_from(quoted(volume), type_of(df, volume), config.number_mode)
    if in_hl:
        crates = f"{crates} / {number(config.hl_per_crate)}"
    division = optional_col(df, names.DIVISION)
    return df.selectExpr(
        f"{day_or_text(quoted(event), type_of(df, event))} as event_date",
        f"cast({quoted(find_col(df, names.DEPLETION_AGENT, table))} as string) as agent_raw",
        f"cast({quoted(find_col(df, names.DEPLETION_ITEM, table))} as string) as item_raw",
        f"cast({quoted(division) if division else 'null'} as string) as dv_raw",
        f"{crates} as crates",
    )


def shipment_windows(dates: ReportDates) -> dict[str, Window]:
    return {
        "last_day_shipment": (dates.report_day, dates.report_day),
        "wtd_shipment": (dates.week_start, dates.report_day),
        "mtd_shipment": (dates.month_start, dates.last_date),
        "ytd_shipment": (dates.year_start, dates.last_date),
    }


def py_shipment_windows(dates: ReportDates) -> dict[str, Window]:
    return {
        "last_day_py_shipment": (dates.py_day, dates.py_day),
        "wtd_py_shipment": (dates.py_week_start, dates.py_day),
        "mtd_py_shipment": (dates.py_month_start, dates.py_cutoff),
        "ytd_py_shipment": (dates.py_year_start, dates.py_cutoff),
    }


def depletion_windows(dates: ReportDates) -> dict[str, Window]:
    return {
        "last_day_depletion": (dates.report_day, dates.report_day),
        "wtd_depletion": (dates.week_start, dates.report_day),
        "mtd_depletion": (dates.month_start, dates.last_date),
        "ytd_depletion": (dates.year_start, dates.last_date),
    }


def py_depletion_windows(dates: ReportDates) -> dict[str, Window]:
    """The month and year windows of prior-year sell-out end on the report day."""
    return {
        "last_day_py_depletion": (dates.py_day, dates.py_day),
        "wtd_py_depletion": (dates.py_week_start, dates.py_day),
        "mtd_py_depletion": (dates.py_month_start, dates.py_day),
        "ytd_py_depletion": (dates.py_year_start, dates.py_day),
    }


def in_window(window: Window) -> str:
    start, end = window
    until = f"event_date <= {day(end)}"
    return until if start is None else f"event_date >= {day(start)} and {until}"


def source_rank(windows: Mapping[str, Window], ranks: Mapping[str, int]) -> str:
    """Position of the first listed window a row falls into, null for none."""
    ordered = sorted(ranks, key=ranks.get)
    branches = " ".join(f"when {in_window(windows[name])} then {ranks[name]}" for name in ordered)
    return f"case {branches} end"


def window_sums(
    fact: DataFrame,
    windows: Mapping[str, Window],
    by: Sequence[str],
    ranks: Mapping[str, int] | None = None,
    until: date | None = None,
) -> DataFrame:
    """One conditional sum per window and source-name pair, in one pass over a fact or its day sums.

    A window sum is null where the pair has no row in it. ``ranks`` numbers the
    windows whose rows make a key part of the report. ``until`` cuts rows
    before any window is looked at.
    """
    if AGENT_KEY in fact.columns and by:
        by = [AGENT_KEY, *by]
    starts = [start for start, _ in windows.values()]
    last = max(end for _, end in windows.values())
    kept = in_window((None if None in starts else min(starts), min(last, until) if until else last))
    aggregates = [f"sum(if({in_window(window)}, crates, null)) as {name}" for name, window in windows.items()]
    if ranks:
        aggregates.append(f"min({source_rank(windows, ranks)}) as rank")
    return fact.filter(kept).groupBy(*by).agg(*[F.expr(aggregate) for aggregate in aggregates])
