"""Derived KPIs of the wide table and their report names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from cratewise.functions.numbers import clip_lower, safe_divide
from cratewise.functions.sql import number, quoted
from cratewise.operators.calendar import ReportDates

TARGETS = ("aop", "snop", "sales")
# Spelling of name parts in report headers.
HEADER_WORDS = {
    "wtd": "WTD", "mtd": "MTD", "ytd": "YTD", "py": "PY", "aop": "AOP", "snop": "SNOP",
    "vs": "vs", "of": "of", "pct": "%",
}

PERIOD_BLOCK = [
    f"{period}_{measure}"
    for period in ("last_day", "wtd")
    for measure in ("shipment", "py_shipment", "depletion", "py_depletion", "target_aop", "target_snop", "target_sales")
]
WIDE_MEASURES = (
    PERIOD_BLOCK
    + ["mtd_py_depletion", "ytd_py_depletion", "beginning_stock"]
    + ["mtd_shipment", "mtd_py_shipment", "mtd_achievement_vs_py_pct", "mtd_variance_vs_py", "mtd_depletion"]
    + ["stock_balance", "avg_daily_depletion", "days_of_stock", "mtd_landing"]
    + [n for t in TARGETS for n in (f"mtd_target_{t}", f"mtd_achievement_vs_{t}_pct")]
    + ["ytd_shipment", "ytd_py_shipment", "ytd_achievement_vs_py_pct", "ytd_variance_vs_py", "ytd_depletion"]
    + [n for t in TARGETS for n in (f"ytd_target_{t}", f"ytd_achievement_vs_{t}_pct")]
    + ["yearly_landing"]
    + [n for t in TARGETS for n in (f"full_year_target_{t}", f"yearly_landing_vs_{t}_pct")]
    + [n for t in TARGETS for n in (f"full_month_target_{t}", f"mtd_landing_vs_{t}_pct")]
    + ["avg_daily_mtd_shipment", "avg_daily_ytd_shipment"]
)
# Ratios and day counts keep their value in every unit.
UNITLESS = [m for m in WIDE_MEASURES if m.endswith("_pct")] + ["days_of_stock"]
VOLUMES = [m for m in WIDE_MEASURES if m not in UNITLESS]


def report_name(name: str) -> str:
    """``mtd_landing_vs_aop_pct`` -> ``MTD Landing vs AOP %``."""
    return " ".join(HEADER_WORDS.get(word, word.capitalize()) for word in name.split("_"))


def stock_balance(beginning: str, shipped: str, depleted: str) -> str:
    return clip_lower(f"({beginning} + {shipped} - {depleted})")


def stock_flag(days: str) -> str:
    return (
        f"case when {days} > 10 then 'Over-stocked' when {days} between 6 and 10 then 'Optimal' "
        f"when {days} < 6 then 'Low Stock' else 'No Depletion' end"
    )


def with_values(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    return df.selectExpr("*", *[f"{value} as {quoted(name)}" for name, value in values.items()])


def add_stock_cover(df: DataFrame, dates: ReportDates) -> DataFrame:
    balanced = with_values(
        df,
        {
            "stock_balance": stock_balance("beginning_stock", "mtd_shipment", "mtd_depletion"),
            "avg_daily_depletion": f"mtd_depletion / {dates.elapsed_cal_days}",
        },
    )
    return with_values(balanced, {"days_of_stock": safe_divide("stock_balance", "avg_daily_depletion")})


def add_landing(df: DataFrame, dates: ReportDates) -> DataFrame:
    """Month and year forecasts: volume so far plus the daily average over the remaining working days."""
    averages = with_values(
        df,
        {
            "avg_daily_mtd_shipment": f"mtd_shipment / {dates.elapsed_wd}",
            "avg_daily_ytd_shipment": f"ytd_shipment / {dates.elapsed_year_wd}",
        },
    )
    return with_values(
        averages,
        {
            "mtd_landing": f"mtd_shipment + avg_daily_mtd_shipment * {dates.remaining_wd}",
            "yearly_landing": f"ytd_shipment + avg_daily_ytd_shipment * {dates.remaining_year_wd}",
        },
    )


def add_achievement(df: DataFrame) -> DataFrame:
    """Variance and plain ratios against the prior year and the three targets."""
    values = {}
    for period in ("mtd", "ytd"):
        sold, prior = f"{period}_shipment", f"{period}_py_shipment"
        values[f"{period}_variance_vs_py"] = f"{sold} - {prior}"
        values[f"{period}_achievement_vs_py_pct"] = safe_divide(sold, prior)
        for target in TARGETS:
            values[f"{period}_achievement_vs_{target}_pct"] = safe_divide(sold, f"{period}_target_{target}")
    for target in TARGETS:
        values[f"mtd_landing_vs_{target}_pct"] = safe_divide("mtd_landing", f"full_month_target_{target}")
        values[f"yearly_landing_vs_{target}_pct"] = safe_divide("yearly_landing", f"full_year_target_{target}")
    return with_values(df, values)


def add_kpis(df: DataFrame, dates: ReportDates) -> DataFrame:
    return add_achievement(add_landing(add_stock_cover(df, dates), dates))


def expand_units(df: DataFrame, volumes: Sequence[str], hl_per_crate: float) -> DataFrame:
    """Each row once in crates and once in hectolitres."""
    units = f"array(struct('Crates' as uom, 1.0D as factor), struct('HL' as uom, {number(hl_per_crate)} as factor))"
    rows = df.selectExpr("*", f"inline({units})")
    kept = [f"{name} * factor as {name}" if name in volumes else name for name in df.columns]
    return rows.selectExpr(*kept, "uom")
