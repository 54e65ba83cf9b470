"""The final extract: normalized names, two units, three target types, ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.config import BrandRules, ReportConfig
from cratewise.functions.numbers import growth, safe_divide, totals
from cratewise.functions.sql import quoted, text
from cratewise.functions.text import brand_display_name, flat_text, normalize_target_type, normalize_uom, shown_text
from cratewise.operators import kpi
from cratewise.operators.calendar import ReportDates
from cratewise.operators.metrics import (
    DEPLETION_MEASURES,
    PERIOD_NAMES,
    PY_DEPLETION_MEASURES,
    PY_SHIPMENT_MEASURES,
    SHIPMENT_MEASURES,
)
from cratewise.operators.targets import target_column
from cratewise.plans.wide import NAMES
from cratewise.sources.extract import EXTRACT_COLUMNS, FLAG, KEYS, PERIODS

# Target types in the extract, with the type name of the target table.
EXTRACT_TYPES = {"Sales": "Sales Target", "SNOP": "SNOP", "AOP": "AOP"}
EXTRACT_TARGETS = [target_column(p, t) for p in PERIOD_NAMES for t in EXTRACT_TYPES.values()]
EXTRACT_VOLUMES = (
    SHIPMENT_MEASURES
    + PY_SHIPMENT_MEASURES
    + DEPLETION_MEASURES
    + PY_DEPLETION_MEASURES
    + EXTRACT_TARGETS
    + ["beginning_stock"]
)


def normalize_names(df: DataFrame) -> DataFrame:
    others = [name for name in df.columns if name not in NAMES]
    flat = df.selectExpr(*[f"{flat_text(name)} as {name}" for name in NAMES], *others)
    return flat.selectExpr(*[f"{shown_text(name)} as {name}" for name in NAMES], *others)


def exact_stock(conformed_stock: DataFrame, rules: BrandRules) -> DataFrame:
    """Opening stock by the names the extract shows, not yet summed."""
    named = conformed_stock.selectExpr("*", f"{brand_display_name('brand_kpi_key', rules)} as brand")
    return normalize_names(named.selectExpr(*NAMES, "beginning_stock as exact_stock"))


def collapse_names(metric_table: DataFrame, conformed_stock: DataFrame, rules: BrandRules) -> DataFrame:
    """Sums per normalized name triple, with the stock of the source beside the carried one.

    Sums of sums are one sum, so the aggregation before and after the name
    cleanup is done once. Stock rows ride in the same aggregate and only fill
    triples the table has; null names group with null names.
    """
    carried = normalize_names(metric_table.selectExpr(*NAMES, *EXTRACT_VOLUMES)).selectExpr("*", "true as in_table")
    rows = carried.unionByName(exact_stock(conformed_stock, rules), allowMissingColumns=True)
    sums = totals([*EXTRACT_VOLUMES, "exact_stock"])
    summed = rows.groupBy(*NAMES).agg(*[F.expr(s) for s in sums], F.expr("max(in_table) as in_table"))
    return summed.filter("in_table").drop("in_table")


def expand_types(df: DataFrame) -> DataFrame:
    """Each row once per target type, carrying that type's four targets."""
    options = [
        ", ".join(
            [f"{text(shown)} as target_type"]
            + [f"{target_column(p, source)} as {p}_target" for p in PERIOD_NAMES]
        )
        for shown, source in EXTRACT_TYPES.items()
    ]
    structs = ", ".join(f"struct({option})" for option in options)
    kept = [name for name in df.columns if name not in EXTRACT_TARGETS]
    return df.selectExpr(*kept, f"inline(array({structs}))")


def expand(collapsed: DataFrame, dates: ReportDates, hl_per_crate: float) -> DataFrame:
    """Six rows per name triple: two units by three target types, under extract names."""
    daily = f"mtd_depletion / {dates.elapsed_cal_days} as avg_daily_depletion"
    in_crates = collapsed.selectExpr("*", daily)
    both = kpi.expand_units(in_crates, EXTRACT_VOLUMES + ["exact_stock", "avg_daily_depletion"], hl_per_crate)
    columns = [
        *[f"{name} as {name.capitalize()}" for name in NAMES],
        f"{normalize_uom('uom')} as UOM",
        f"{normalize_target_type('target_type')} as `Target Type`",
    ]
    for period, name in zip(PERIODS, PERIOD_NAMES, strict=True):
        volume = period.replace(" ", "_")
        columns += [
            f"{name}_shipment as {volume}_Sales",
            f"{name}_target as {volume}_Target",
            f"{name}_py_shipment as {volume}_PY",
            f"{name}_depletion as {volume}_Depletion",
            f"{name}_py_depletion as {volume}_Depletion_PY",
        ]
    stock = ["beginning_stock as Carried_Stock", "exact_stock as Beginning_Stock"]
    return expand_types(both).selectExpr(*columns, *stock, "avg_daily_depletion as Avg_Daily_Depletion")


def growth_ratios() -> dict[str, str]:
    ratios = {}
    for period in PERIODS:
        volume = period.replace(" ", "_")
        sales, target, depletion = f"{volume}_Sales", f"{volume}_Target", f"{volume}_Depletion"
        vs_py = "YTD VS PY Ach" if period == "YTD" else f"{period} Sales vs PY"
        ratios[f"{period} Ach"] = growth(sales, target)
        ratios[vs_py] = growth(sales, f"{volume}_PY")
        ratios[f"{period} Depletion Ach"] = growth(depletion, target)
        ratios[f"{period} Depletion vs PY"] = growth(depletion, f"{volume}_Depletion_PY")
    return ratios


def add_ratios_and_stock(df: DataFrame) -> DataFrame:
    """Growth ratios, the balance from the exact stock, cover in days and the level flag."""
    balance = kpi.stock_balance("Beginning_Stock", "MTD_Sales", "MTD_Depletion")
    rows = kpi.with_values(df, {**growth_ratios(), "Stock_per_Agent": balance})
    rows = kpi.with_values(rows, {"Days of Stock": safe_divide("Stock_per_Agent", "Avg_Daily_Depletion")})
    return kpi.with_values(rows, {FLAG: kpi.stock_flag("`Days of Stock`")})


def extract_rows(
    metric_table: DataFrame, conformed_stock: DataFrame, dates: ReportDates, config: ReportConfig
) -> DataFrame:
    """The expanded rows, before the columns are cut to the extract's."""
    collapsed = collapse_names(metric_table, conformed_stock, config.brand_rules)
    return add_ratios_and_stock(expand(collapsed, dates, config.hl_per_crate))


def final_extract(rows: DataFrame) -> DataFrame:
    order = [F.asc_nulls_last(quoted(name)) for name in ("UOM", "Target Type") + KEYS[:3]]
    ordered = rows.orderBy(*order, F.desc_nulls_last("MTD_Sales"))
    return ordered.select(*[quoted(name) for name in EXTRACT_COLUMNS])
