"""Targets: conform three sources, phase them by working days, pivot by type."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise import config as names
from cratewise.config import TARGET_TYPES, ReportConfig
from cratewise.functions.dates import month_text, parse_target_month
from cratewise.functions.numbers import number_from, total, totals
from cratewise.functions.sql import day, number, quoted, text
from cratewise.operators.calendar import ReportDates, month_progress
from cratewise.operators.mdm import add_agent_fields, add_brand_fields
from cratewise.sources.catalog import find_col, type_of

# Column suffix per target type.
TYPE_SUFFIX = {"AOP": "aop", "SNOP": "snop", "Sales Target": "sales"}
TARGET_WINDOWS = ("last_day", "wtd", "mtd", "ytd", "full_month", "full_year")


def target_column(window: str, target_type: str) -> str:
    return f"{window}_target_{TYPE_SUFFIX[target_type]}"


TARGET_MEASURES = [target_column(w, t) for w in TARGET_WINDOWS for t in TARGET_TYPES]


def _shape(df: DataFrame, target_type: str, agent: str, brand: str, value: str, uom: str, mode: str) -> DataFrame:
    return df.selectExpr(
        f"{text(target_type)} as target_type",
        f"{month_text('Month', type_of(df, 'Month'))} as month_raw",
        "cast(Division as string) as dv",
        f"cast({quoted(agent)} as string) as agent",
        f"cast({quoted(brand)} as string) as item_raw",
        f"{text(uom)} as source_uom",
        f"{number_from(quoted(value), type_of(df, value), mode)} as source_value",
    )


def shape_targets(aop: DataFrame, sales: DataFrame, snop: DataFrame, config: ReportConfig) -> DataFrame:
    """The three sources in one shape; AOP comes in hectolitres under fixed headers."""
    mode, factor = config.number_mode, number(config.hl_per_crate)
    shaped = [_shape(aop, "AOP", "Agent", "Item Description", "Target, HL", "HL", mode)]
    for df, target_type, table in ((sales, "Sales Target", "sales_target"), (snop, "SNOP", "snop_target")):
        agent = find_col(df, names.TARGET_AGENT, table)
        brand = find_col(df, names.TARGET_BRAND, table)
        value = find_col(df, names.TARGET_CRATES, table)
        shaped.append(_shape(df, target_type, agent, brand, value, "Crates", mode))
    union = reduce(DataFrame.unionByName, shaped)
    return union.selectExpr(
        *[name for name in union.columns if name != "source_value"],
        f"{parse_target_month('month_raw', config.default_target_year)} as month_start",
        f"if(source_uom = 'HL', source_value, source_value * {factor}) as target_hl",
        f"if(source_uom = 'HL', source_value / {factor}, source_value) as target_crates",
    )


def conform_targets(shaped: DataFrame, dim_brand: DataFrame, config: ReportConfig) -> DataFrame:
    """Target rows with brand key, reporting name and match flag."""
    return add_brand_fields(shaped, dim_brand, config.brand_rules)


def target_to_date(targets: DataFrame, progress: DataFrame) -> DataFrame:
    """Adds the month's day counts and the part of each target due so far.

    The progress table has one row per month of the calendar, so its broadcast
    is bounded.
    """
    joined = targets.join(F.broadcast(progress), "month_start", "left")
    kept = [name for name in joined.columns if name != "ratio"]
    return joined.selectExpr(
        *kept,
        "coalesce(ratio, 0.0D) as ratio",
        "target_hl * coalesce(ratio, 0.0D) as target_hl_to_date",
        "target_crates * coalesce(ratio, 0.0D) as target_crates_to_date",
    )


def period_target(period_days: str) -> str:
    """Target crates spread over the month's working days, times the period's."""
    spread = f"target_crates / month_working_days * coalesce({period_days}, 0)"
    return f"if(coalesce(month_working_days, 0) = 0, 0.0D, {spread})"


def target_window_sums(
    shaped: DataFrame, calendar: DataFrame, dates: ReportDates, by: Sequence[str] = ("dv", "agent", "item_raw")
) -> DataFrame:
    """All eighteen target measures per source-name group, in one pass.

    The year windows take every target row, whatever its year.
    """
    periods = {
        "last_day_days": (dates.report_day, dates.report_day),
        "wtd_days": (dates.week_start, dates.report_day),
    }
    phased = target_to_date(shaped, month_progress(calendar, dates.last_date, periods))
    current = f"month_start = {day(dates.month_start)}"
    values = {
        "last_day": period_target("last_day_days"),
        "wtd": period_target("wtd_days"),
        "mtd": f"if({current}, target_crates_to_date, null)",
        "ytd": "target_crates_to_date",
        "full_month": f"if({current}, target_crates, null)",
        "full_year": "target_crates",
    }
    sums = [
        f"sum(if(target_type = {text(t)}, {values[w]}, null)) as {target_column(w, t)}"
        for w in TARGET_WINDOWS
        for t in TARGET_TYPES
    ]
    return phased.groupBy(*by).agg(*[F.expr(s) for s in sums], F.expr(f"min(if({current}, 4, 5)) as rank"))


def conform_target_sums(
    sums: DataFrame, dim_agent: DataFrame, dim_brand: DataFrame, config: ReportConfig
) -> DataFrame:
    """Names of ``target_window_sums``; measures of rows without a full pivot key are null."""
    named = add_brand_fields(sums, dim_brand, config.brand_rules).withColumnRenamed("agent", "agent_raw")
    keyed = add_agent_fields(named, dim_agent, "dv")
    keys = ["division", "agent_key", "agent", "brand_kpi_key"]
    complete = " and ".join(f"{name} is not null" for name in keys)
    return keyed.selectExpr(*keys, "rank", *[f"if({complete}, {m}, null) as {m}" for m in TARGET_MEASURES])


def pivot_by_type(df: DataFrame, index: Sequence[str], value: str) -> DataFrame:
    """Sums of ``value`` with one column per target type; rows with a null index are dropped."""
    wide = df.na.drop("any", subset=list(index)).groupBy(*index).pivot("target_type", list(TARGET_TYPES))
    return wide.agg(F.sum(value)).na.fill(0.0, subset=list(TARGET_TYPES))


def regional_targets(targets: DataFrame) -> DataFrame:
    return targets.groupBy("dv", "target_type").agg(
        F.expr(total("target_crates", "full_target_crates")),
        F.expr(total("target_crates_to_date", "target_crates_to_date")),
    )


def selected_target_by_region(targets: DataFrame, target_type: str) -> DataFrame:
    selected = targets.filter(f"target_type = {text(target_type)}")
    return selected.groupBy("dv").agg(
        F.expr(total("target_crates_to_date", "target_crates_to_date")),
        F.expr(total("target_hl_to_date", "target_hl_to_date")),
        F.expr(total("target_crates", "full_target_crates")),
    )


def aop_by_month(targets: DataFrame) -> DataFrame:
    keys = ["month_raw", "month_start", "month_working_days", "elapsed_working_days", "ratio"]
    sums = totals(["target_hl", "target_crates", "target_hl_to_date", "target_crates_to_date"])
    return (
        targets.filter("target_type = 'AOP'")
        .groupBy(*keys)
        .agg(*[F.expr(s) for s in sums])
        .withColumnsRenamed(
            {
                "target_hl": "full_aop_hl",
                "target_crates": "full_aop_crates",
                "target_hl_to_date": "aop_hl_to_date",
                "target_crates_to_date": "aop_crates_to_date",
            }
        )
        .orderBy(F.asc_nulls_last("month_start"))
    )
