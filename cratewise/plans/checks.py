"""Data-quality checks as DataFrames; two of them raise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratewise.functions.dates import same_day_in_year
from cratewise.functions.numbers import growth, safe_divide, show_number, show_percent, total, totals
from cratewise.functions.sql import day, number, quoted, text
from cratewise.operators import volumes
from cratewise.operators.calendar import daily_volume, with_working_day
from cratewise.operators.day_sums import rows_of
from cratewise.plans.inputs import Inputs
from cratewise.plans.wide import with_report_names

# Measures of the per-unit total check, in its order.
TOTAL_MEASURES = (
    "mtd_shipment", "mtd_py_shipment", "mtd_depletion",
    "ytd_shipment", "ytd_py_shipment", "ytd_depletion", "stock_balance",
    "mtd_target_aop", "mtd_target_snop", "mtd_target_sales",
    "ytd_target_aop", "ytd_target_snop", "ytd_target_sales",
)
PERIOD_MEASURES = (
    "last_day_shipment", "wtd_shipment", "last_day_py_shipment", "wtd_py_shipment",
    "last_day_depletion", "wtd_depletion", "last_day_py_depletion", "wtd_py_depletion",
)
UNIT_AND_TYPE = ("UOM", "Target Type")
# Levels of the totals, in the order of their grouping ids.
LEVELS = (UNIT_AND_TYPE, ("UOM",), ("Target Type",), ())
TOTAL_COLUMNS = (
    "MTD_Sales", "MTD_Target", "MTD_Depletion", "YTD_Sales", "YTD_Target", "YTD_Depletion",
    "MTD_PY", "YTD_PY", "Beginning_Stock", "Stock_per_Agent", "Avg_Daily_Depletion",
)
PERIOD_COLUMNS = (
    "Last_Day_Sales", "Last_Day_Target", "Last_Day_Depletion",
    "WTD_Sales", "WTD_Target", "WTD_Depletion", "MTD_Sales", "YTD_Sales",
)
# Display styles: decimals of a plain number, "%" or "+%".
Styles = Mapping[str, int | str]


def metric_values(row: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """A single row turned into (metric, value) rows."""
    pairs = ", ".join(f"struct({text(name)} as metric, {value} as value)" for name, value in values.items())
    return row.selectExpr(f"inline(array({pairs}))")


def one_row(frames: Sequence[DataFrame]) -> DataFrame:
    """Sums of every column over the union of the frames."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return rows.selectExpr(*totals(rows.columns))


def summed_by(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(t) for t in totals(columns)])


# -- coverage lists ---------------------------------------------------------


def unmatched_target_brands(target_rows: DataFrame) -> DataFrame:
    missing = target_rows.filter(F.col("brand_match") == "Not Matched")
    return missing.select("target_type", "original_brand", "brand_key").distinct()


def unmatched_agents(conformed: DataFrame) -> DataFrame:
    missing = conformed.filter(F.col("agent_match") == "Not Matched")
    return missing.select("agent_source_name", "agent", "agent_key").distinct()


def unmatched_brands(conformed: DataFrame) -> DataFrame:
    missing = conformed.filter(F.col("brand_match") == "Not Matched")
    return missing.select("original_brand", "brand_key").distinct()


def agent_consolidation(spine: DataFrame) -> DataFrame:
    """Distinct keys and brands per agent name."""
    counted = spine.groupBy("agent").agg(
        F.countDistinct("agent_key").alias("source_key_count"),
        F.countDistinct("brand_kpi_key").alias("brand_count"),
    )
    return counted.orderBy(F.desc("source_key_count"), F.asc_nulls_last("agent"))


def missing_division(wide: DataFrame) -> DataFrame:
    return wide.filter(F.col("division").isNull()).select("division", "agent", "brand").distinct()


def month_parse_check(shaped_targets: DataFrame) -> DataFrame:
    return shaped_targets.select("month_raw", "month_start").distinct().orderBy(F.asc_nulls_last("month_start"))


# -- control totals ---------------------------------------------------------


def target_totals(target_rows: DataFrame) -> DataFrame:
    columns = ("target_hl", "target_crates", "target_hl_to_date", "target_crates_to_date")
    return summed_by(target_rows, ["target_type"], columns)


def shipment_totals(inputs: Inputs) -> DataFrame:
    """Actual, selected target and prior year with both variances, as (metric, value)."""
    dates = inputs.dates
    actual = inputs.actual.filter(f"event_date <= {day(dates.last_date)}").selectExpr("crates as actual")
    prior = inputs.prior.filter(f"event_date <= {day(dates.py_cutoff)}").selectExpr("crates as py")
    selected = inputs.phased_targets.filter(f"target_type = {text(inputs.config.selected_target_type)}")
    row = one_row([one_row([actual]), one_row([prior]), one_row([selected.selectExpr("target_crates_to_date as target")])])
    return metric_values(
        row,
        {
            "Actual Shipment Crates To Date": "actual",
            "Selected Target Crates To Date": "target",
            "Variance vs Target": "actual - target",
            "PY Shipment Crates Same Period": "py",
            "Variance vs PY": "actual - py",
        },
    )


def reconciliation(inputs: Inputs, table: DataFrame) -> DataFrame:
    """Sell-in of the metric table against all sell-in rows up to the last date."""
    windows = {
        "source_ytd": (None, inputs.dates.last_date),
        "source_mtd": (inputs.dates.month_start, inputs.dates.last_date),
    }
    source = volumes.window_sums(inputs.actual, windows, ())
    final = one_row([table.selectExpr("ytd_shipment as final_ytd", "mtd_shipment as final_mtd")])
    values = {}
    for period in ("ytd", "mtd"):
        shown = period.upper()
        values[f"Source {shown} Shipment Crates"] = f"source_{period}"
        values[f"Final {shown} Shipment Crates"] = f"final_{period}"
        values[f"{shown} Difference"] = f"final_{period} - source_{period}"
    return metric_values(one_row([source, final]), values)


def same_total(source: float, final: float) -> bool:
    """Whether two totals round to the same whole number, halves to even."""
    return round(source) == round(final)


def assert_reconciled(check: DataFrame) -> None:
    """Raises unless the rounded year-to-date totals agree."""
    names = ("Source YTD Shipment Crates", "Final YTD Shipment Crates")
    chosen = check.filter(F.col("metric").isin(*names)).selectExpr("metric", "bround(value, 0) as value")
    found = {row["metric"]: row["value"] for row in chosen.take(len(names))}
    source, final = (found[name] for name in names)
    if source != final:
        raise ValueError(f"YTD shipment mismatch. Source = {source:,.0f}, final table = {final:,.0f}.")


def period_source_vs_merged(inputs: Inputs, table: DataFrame) -> DataFrame:
    """Last-day and week totals of the sources beside those of the metric table."""
    dates = inputs.dates
    sources = [
        (inputs.actual, volumes.shipment_windows(dates), dates.last_date),
        (inputs.prior, volumes.py_shipment_windows(dates), dates.py_cutoff),
        (inputs.depletion, volumes.depletion_windows(dates), None),
        (inputs.prior_depletion, volumes.py_depletion_windows(dates), None),
    ]
    parts = [
        volumes.window_sums(fact, {k: w for k, w in windows.items() if k in PERIOD_MEASURES}, (), until=until)
        for fact, windows, until in sources
    ]
    merged = one_row([table.selectExpr(*[f"{m} as merged_{m}" for m in PERIOD_MEASURES])])
    lines = ", ".join(
        f"struct({text(m)} as metric, {m} as source_crates, merged_{m} as merged_crates)" for m in PERIOD_MEASURES
    )
    factor = number(inputs.config.hl_per_crate)
    return (
        one_row([*parts, merged])
        .selectExpr(f"inline(array({lines}))")
        .selectExpr(
            "*",
            f"source_crates * {factor} as source_hl",
            f"merged_crates * {factor} as merged_hl",
            "merged_crates - source_crates as difference",
        )
    )


def working_day_split(inputs: Inputs) -> DataFrame:
    """Sell-in of both years by working and other days; a prior-year day takes the
    flag of the same day in the current year."""
    dates = inputs.dates
    facts = {
        "Actual Shipment": (inputs.actual, dates.last_date, "event_date"),
        "PY Shipment": (inputs.prior, dates.py_cutoff, same_day_in_year("event_date", dates.last_date.year)),
    }
    parts = []
    for label, (fact, until, calendar_day) in facts.items():
        kept = fact.filter(f"event_date <= {day(until)}")
        daily = kept.groupBy("event_date").agg(F.expr(f"{rows_of(kept)} as row_count"), F.expr(total("crates", "crates")))
        parts.append(daily.selectExpr(f"{text(label)} as source", f"{calendar_day} as day", "row_count", "crates"))
    flagged = with_working_day(parts[0].unionByName(parts[1]), "day", inputs.calendar)
    return flagged.groupBy("source", "is_working_day").agg(
        F.expr("sum(row_count) as row_count"), F.expr(total("crates", "crates"))
    )


def date_range_check(inputs: Inputs) -> DataFrame:
    """Date range and row counts of sell-in up to the last date."""
    dates = inputs.dates
    report_day = day(dates.report_day)
    daily = daily_volume(inputs.actual).filter(f"event_date <= {day(dates.last_date)}")
    return daily.selectExpr(
        "sum(positive_rows) as positive_rows",
        "min(event_date) as min_date",
        "max(event_date) as max_date",
        f"coalesce(sum(if(event_date = {report_day}, row_count, null)), 0) as last_day_rows",
        f"coalesce(sum(if(event_date between {day(dates.week_start)} and {report_day}, row_count, null)), 0) as wtd_rows",
    )


def totals_by_uom(report: DataFrame) -> DataFrame:
    """Thirteen totals per unit as (uom, metric, value)."""
    summed = with_report_names(summed_by(report, ["uom"], TOTAL_MEASURES))
    return summed.unpivot(["UOM"], None, "metric", "value")


def with_total_ratios(summed: DataFrame) -> DataFrame:
    """Totals per unit and type with the ratios of the totals."""
    return summed.selectExpr(
        *map(quoted, (*UNIT_AND_TYPE, *TOTAL_COLUMNS)),
        f"{growth('MTD_Sales', 'MTD_Target')} as `MTD Ach`",
        f"{growth('YTD_Sales', 'YTD_Target')} as `YTD Ach`",
        f"{safe_divide('Stock_per_Agent', 'Avg_Daily_Depletion')} as `Days of Stock`",
    )


def totals_by_uom_type(extract: DataFrame) -> DataFrame:
    return with_total_ratios(summed_by(extract, UNIT_AND_TYPE, TOTAL_COLUMNS))


MEAN_COVER = "avg(`Days of Stock`) as Days_of_Stock"


def shown_stock_totals(summed: DataFrame) -> DataFrame:
    columns = ["Beginning_Stock", "Avg_Daily_Depletion", "Stock_per_Agent as Stock_Balance", "Days_of_Stock"]
    return summed.selectExpr(*map(quoted, UNIT_AND_TYPE), *columns)


def stock_totals(extract: DataFrame) -> DataFrame:
    sums = totals(["Beginning_Stock", "Avg_Daily_Depletion", "Stock_per_Agent"])
    return shown_stock_totals(extract.groupBy(*UNIT_AND_TYPE).agg(*[F.expr(s) for s in [*sums, MEAN_COVER]]))


def shown_stock_change(summed: DataFrame) -> DataFrame:
    return summed.selectExpr(
        "UOM", "Carried_Stock as Beginning_Stock_Before", "Beginning_Stock as Beginning_Stock_After",
        "Stock_per_Agent as Stock_Balance_After", "MTD_Sales", "MTD_Depletion",
    )


def stock_before_after(rows: DataFrame) -> DataFrame:
    """Stock per unit before and after the source figures replace the carried ones."""
    columns = ["Carried_Stock", "Beginning_Stock", "Stock_per_Agent", "MTD_Sales", "MTD_Depletion"]
    return shown_stock_change(summed_by(rows, ["UOM"], columns))


def period_totals(extract: DataFrame, more_keys: Sequence[str] = ()) -> DataFrame:
    return summed_by(extract, [*UNIT_AND_TYPE, *more_keys], PERIOD_COLUMNS)


def zero_period_rows(totals: DataFrame) -> DataFrame:
    """Groups whose last-day and week sell-in are both zero."""
    return totals.filter((F.col("Last_Day_Sales") == 0) & (F.col("WTD_Sales") == 0))


def level_totals(rows: DataFrame) -> DataFrame:
    """All totals of the extract at every level of LEVELS, in one aggregate.

    ``level`` names the keys a row is summed by; the other key is null there.
    """
    columns = dict.fromkeys([*TOTAL_COLUMNS, *PERIOD_COLUMNS, "Carried_Stock"])
    sets = [[F.col(quoted(k)) for k in level] for level in LEVELS]
    grouped = rows.groupingSets(sets, *[F.col(quoted(k)) for k in UNIT_AND_TYPE])
    names = " ".join(f"when {number} then {text(level_name(level))}" for number, level in zip((0, 1, 2, 3), LEVELS, strict=True))
    summed = grouped.agg(F.grouping_id().alias("_id"), *[F.expr(t) for t in [*totals(columns), MEAN_COVER]])
    return summed.selectExpr(f"case _id {names} end as level", *[quoted(c) for c in summed.columns if c != "_id"])


def level_name(keys: Sequence[str]) -> str:
    return " and ".join(keys) or "All"


def at_level(levels: DataFrame, keys: Sequence[str]) -> DataFrame:
    return levels.filter(F.col("level") == level_name(keys)).drop("level")


def distinct_labels(extract: DataFrame) -> DataFrame:
    """The units and target types an extract holds."""
    return extract.select("UOM", F.col("Target Type")).distinct()


# -- display ----------------------------------------------------------------


def display_text(df: DataFrame, styles: Styles) -> DataFrame:
    """Chosen columns as text for reading; null shows as zero."""
    shown = []
    for name in df.columns:
        style, value = styles.get(name), f"coalesce({quoted(name)}, 0.0D)"
        if style is None:
            shown.append(quoted(name))
        elif isinstance(style, int):
            shown.append(f"{show_number(value, style)} as {quoted(name)}")
        else:
            shown.append(f"{show_percent(value, style == '+%')} as {quoted(name)}")
    return df.selectExpr(*shown)


def preview(df: DataFrame, order: Sequence[Column], rows: int) -> DataFrame:
    """The first rows of a report in its order."""
    return df.orderBy(*order).limit(rows)


