"""Operators and reports on hand-made tables: null keys, duplicates, unmatched
names, zero denominators, and every documented hazard."""

from datetime import date

import pytest

from cratewise.config import ReportConfig
from cratewise.operators import calendar as cal
from cratewise.operators import kpi, mdm, metrics, stock, targets, volumes
from cratewise.plans import checks
from cratewise.plans.inputs import Inputs
from cratewise.plans.report import ReportBundle, build_report, register_conformed
from cratewise.sources.extract import EXTRACT_COLUMNS
from mini import CONFIG, TABLES, mini_tables


@pytest.fixture(scope="module")
def bundle(spark):
    return build_report(mini_tables(spark), CONFIG, reuse=True, reconcile=True)


@pytest.fixture(scope="module")
def inputs(bundle):
    return bundle.inputs


@pytest.fixture(scope="module")
def wide(bundle):
    rows = bundle.kpi_wide.collect()
    return {(row["agent_key"], row["brand_kpi_key"]): row for row in rows}


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_agent_dimension_keeps_first_and_drops_blank_sources(inputs):
    assert rows_of(inputs.agents.select("agent_source_key", "agent_key", "agent", "division")) == [
        ("BETA", "BETA", "Beta", None),
        ("DEP ALPHA", "ALPHA", "Alpha", "South"),
        ("S4H ALPHA", "ALPHA", "Alpha", "North"),
    ]


def test_brand_dimension_keeps_missing_names_null(inputs):
    assert rows_of(inputs.brands.select("brand_key", "reporting_name", "brand_kpi_key")) == [
        ("ALE", None, None),
        ("LAGER BEER CRATE 24X33", "Lager Beer", "LAGER"),
        ("LAGER", "Lager Beer", "LAGER"),
    ]


def test_report_dates(inputs):
    dates = inputs.dates
    assert (dates.last_date, dates.report_day) == (date(2026, 3, 18), date(2026, 3, 17))
    assert (dates.week_start, dates.py_week_start) == (date(2026, 3, 16), date(2025, 3, 16))
    assert (dates.month_start, dates.month_end) == (date(2026, 3, 1), date(2026, 3, 31))
    assert (dates.py_cutoff, dates.py_month_start, dates.py_year_start) == (
        date(2025, 3, 18), date(2025, 3, 1), date(2025, 1, 1),
    )
    assert (dates.elapsed_cal_days, dates.elapsed_wd, dates.remaining_wd) == (18, 15, 11)
    assert (dates.elapsed_year_wd, dates.remaining_year_wd) == (39, 11)


def test_cutoff_and_event_column_may_differ(spark):
    headers = ["Date", "Billing Date", "Agent", "Brand", "Qty"]
    rows = [("20/03/2026", "18/03/2026", "a", "b", "5"), ("12/03/2026", "17/03/2026", "a", "b", "2"), (None, None, "a", "b", "1")]
    tables = mini_tables(spark, actual_shipment=(headers, rows))
    dates = Inputs(tables, CONFIG).dates
    assert (dates.last_date, dates.report_day) == (date(2026, 3, 18), date(2026, 3, 12))


def test_no_positive_volume_falls_back_to_the_last_date(spark):
    rows = [("18/03/2026", "a", "b", "0"), ("17/03/2026", "a", "b", "0")]
    tables = mini_tables(spark, actual_shipment=(TABLES["actual_shipment"][0], rows))
    assert Inputs(tables, CONFIG).dates.report_day == date(2026, 3, 18)


def test_blank_dates_raise(spark):
    rows = [("nothing", "a", "b", "1")]
    tables = mini_tables(spark, actual_shipment=(TABLES["actual_shipment"][0], rows))
    with pytest.raises(ValueError, match="No shipment has a readable date"):
        Inputs(tables, CONFIG).dates
    stock_rows = [("never", "a", "1", "2")]
    tables = mini_tables(spark, stock=(TABLES["stock"][0], stock_rows))
    with pytest.raises(ValueError, match="No stock row has a readable snapshot day"):
        Inputs(tables, CONFIG).stock_long
    tables = mini_tables(spark, stock=(["Reporting Date", "Agent"], [("01/03/2026", "a")]))
    with pytest.raises(ValueError, match="no column of a brand"):
        Inputs(tables, CONFIG).stock_long


def test_calendar_duplicates_count_once(spark):
    headers, rows = TABLES["calendar_mdm"]
    doubled = mini_tables(spark, calendar_mdm=(headers, rows + [("16/03/2026", "yes"), ("junk", "yes")]))
    calendar = cal.calendar_dimension(doubled["calendar_mdm"])
    assert calendar.count() == 59
    assert rows_of(cal.duplicate_calendar_days(doubled["calendar_mdm"])) == [(date(2026, 3, 16), 2)]


def test_month_progress(inputs, spark):
    progress = {row["month_start"]: row for row in inputs.month_progress.collect()}
    assert progress[date(2026, 2, 1)]["ratio"] == 1.0
    march = progress[date(2026, 3, 1)]
    assert (march["month_working_days"], march["elapsed_working_days"]) == (26, 15)
    assert march["ratio"] == 15 / 26
    future = cal.month_progress(inputs.calendar, date(2026, 1, 15))
    assert {row["ratio"] for row in future.collect()} == {0.0}
    idle = spark.sql("select date'2026-03-01' as date, date'2026-03-01' as month_start, false as is_working_day")
    assert cal.month_progress(idle, date(2026, 3, 18)).first()["ratio"] == 0.0


def test_targets_phase_and_match(inputs):
    rows = {(r["target_type"], r["month_raw"], r["agent"]): r for r in inputs.targets.collect()}
    current = rows[("Sales Target", "3", "S4H ALPHA")]
    assert current["target_crates_to_date"] == 260 * (15 / 26)
    assert rows[("Sales Target", "2", "S4H ALPHA")]["target_crates_to_date"] == 100.0
    aop = rows[("AOP", "202603", "s4h alpha")]
    assert (aop["target_hl"], round(aop["target_crates"], 9)) == (7.92, 100.0)
    unknown = rows[("SNOP", "x", "S4H ALPHA")]
    assert (unknown["month_start"], unknown["ratio"], unknown["target_crates"]) == (None, 0.0, 0.0)
    beyond = rows[("AOP", "Apr", "Lone")]
    assert (beyond["month_working_days"], beyond["ratio"], beyond["brand_match"]) == (None, 0.0, "Not Matched")
    assert rows[("SNOP", "March", "S4H ALPHA")]["target_crates"] == 1300.0


def test_targets_without_division_keep_the_key_but_no_value(wide):
    lone = wide[("LONE", "STOUT")]
    assert lone["division"] is None
    assert lone["full_year_target_sales"] == 0.0
    assert lone["beginning_stock"] == 5.0


def test_wide_measures(wide):
    alpha = wide[("ALPHA", "LAGER")]
    # Two source names meet; the division is the sell-in one, read first.
    assert (alpha["division"], alpha["agent"], alpha["brand"]) == ("North", "Alpha", "Lager")
    assert (alpha["last_day_shipment"], alpha["wtd_shipment"]) == (10.0, 13.0)
    assert (alpha["mtd_shipment"], alpha["ytd_shipment"]) == (33.0, 33.0)
    assert (alpha["last_day_py_shipment"], alpha["wtd_py_shipment"], alpha["ytd_py_shipment"]) == (5.0, 5.0, 5.0)
    assert alpha["mtd_depletion"] == pytest.approx(10.0)
    assert (alpha["wtd_depletion"], alpha["last_day_py_depletion"], alpha["mtd_py_depletion"]) == (0.0, 8.0, 8.0)
    assert alpha["beginning_stock"] == 1000.0
    assert alpha["stock_balance"] == pytest.approx(1023.0)
    assert alpha["days_of_stock"] == pytest.approx(1023.0 / (10 / 18))
    assert alpha["mtd_landing"] == pytest.approx(33 + 33 / 15 * 11)
    assert alpha["yearly_landing"] == pytest.approx(33 + 33 / 39 * 11)
    assert alpha["mtd_target_sales"] == pytest.approx(150.0)
    assert alpha["full_month_target_sales"] == 260.0
    assert alpha["full_year_target_sales"] == 360.0
    assert alpha["ytd_target_sales"] == pytest.approx(250.0)
    assert alpha["last_day_target_sales"] == pytest.approx(10.0)
    assert alpha["wtd_target_sales"] == pytest.approx(20.0)
    assert alpha["mtd_achievement_vs_py_pct"] == pytest.approx(33 / 5)
    assert alpha["mtd_achievement_vs_sales_pct"] == pytest.approx(33 / 150)


def test_signs_vanish_in_compat_and_unmatched_brand_name_falls_back(wide):
    ale = wide[("ALPHA", "ALE")]
    assert (ale["mtd_shipment"], ale["ytd_shipment"]) == (0.0, 7.0)
    assert (ale["mtd_achievement_vs_py_pct"], ale["days_of_stock"]) == (0.0, 0.0)


def test_signed_mode_keeps_signs(spark):
    signed = ReportBundle(Inputs(mini_tables(spark), CONFIG.with_options(number_mode="signed")))
    ale = signed.metric_table.filter("brand_kpi_key = 'ALE'").first()
    assert ale["ytd_shipment"] == -7.0


def test_null_keys_are_rows_of_their_own(wide):
    assert wide[(None, "LAGER")]["mtd_shipment"] == 4.0
    assert wide[("BETA", None)]["mtd_shipment"] == 2.0


def test_spine_leaves_out_keys_only_prior_year_depletion_has(wide):
    assert ("PY DEP ONLY", "LAGER") not in wide
    assert wide[("PY ONLY", "LAGER")]["ytd_py_shipment"] == 6.0
    new = wide[("NEW AGENT", "LAGER")]
    assert (new["division"], new["ytd_depletion"], new["mtd_depletion"]) == ("Coast", pytest.approx(20.0), 0.0)


def test_opening_stock_takes_the_newest_snapshot(bundle, inputs):
    found = {(r["agent_key"], r["brand_kpi_key"]): r["beginning_stock"] for r in bundle.opening_stock().collect()}
    assert found == {("ALPHA", "LAGER"): 1000.0, ("LONE", "STOUT"): 5.0}
    assert rows_of(stock.stock_by_column(inputs.stock_long)) == [("Lager Crate 24x33", 1000.0), ("Stout", 5.0)]


def test_extract_overwrites_stock_by_division(bundle):
    rows = {
        (r["Division"], r["Agent"], r["Brand"], r["UOM"], r["Target Type"]): r for r in bundle.final_extract.collect()
    }
    assert len(rows) == 6 * len({key[:3] for key in rows})
    alpha = rows[("North", "Alpha", "Lager", "Crates", "Sales")]
    # The stock row belongs to the South division of the other source name.
    assert (alpha["Beginning_Stock"], alpha["Stock_per_Agent"]) == (0.0, pytest.approx(23.0))
    assert alpha["Stock Level Flag"] == "Over-stocked"
    assert alpha["MTD_Target"] == pytest.approx(150.0)
    assert rows[("North", "Alpha", "Lager", "Crates", "AOP")]["MTD_Target"] == pytest.approx(100 * 15 / 26)
    in_hl = rows[("North", "Alpha", "Lager", "HL", "Sales")]
    assert in_hl["MTD_Sales"] == pytest.approx(33 * 0.0792)
    assert in_hl["MTD Ach"] == pytest.approx(alpha["MTD Ach"])
    ale = rows[("North", "Alpha", "Ale", "Crates", "Sales")]
    # Zero target and zero prior year give -1; zero depletion gives Low Stock.
    assert (ale["YTD Ach"], ale["YTD VS PY Ach"], ale["Stock Level Flag"]) == (-1.0, -1.0, "Low Stock")
    lone = rows[(None, "Lone", "Stout", "Crates", "SNOP")]
    assert lone["Beginning_Stock"] == 5.0


def test_extract_schema_and_order(bundle):
    extract = bundle.final_extract
    assert extract.columns == EXTRACT_COLUMNS
    assert len(EXTRACT_COLUMNS) == 46
    keys = [(r["UOM"], r["Target Type"], r["Division"], r["Agent"]) for r in extract.collect()]
    ordered = sorted(keys, key=lambda k: [(part is None, part or "") for part in k])
    assert keys == ordered


def test_extract_merges_names_that_become_equal(spark):
    headers = TABLES["actual_shipment"][0]
    rows = [("18/03/2026", "north-east trading", "Lager", "1"), ("18/03/2026", "North East  Trading", "Lager", "2")]
    tables = mini_tables(spark, actual_shipment=(headers, rows))
    bundle = ReportBundle(Inputs(tables, CONFIG))
    merged = bundle.final_extract.filter("Agent = 'North East Trading' and UOM = 'Crates' and `Target Type` = 'AOP'")
    assert [row["MTD_Sales"] for row in merged.collect()] == [3.0]


def test_extract_invariants(bundle):
    rows = bundle.final_extract.collect()
    by_key = {(r["Division"], r["Agent"], r["Brand"], r["UOM"], r["Target Type"]): r for r in rows}
    volumes_only = [c for c in EXTRACT_COLUMNS if "_" in c]
    for key, row in by_key.items():
        if row["UOM"] == "HL":
            crates = by_key[(*key[:3], "Crates", key[4])]
            for name in volumes_only:
                assert row[name] == pytest.approx(crates[name] * 0.0792)
    for name in ("MTD_Sales", "YTD_Depletion", "YTD_PY", "Beginning_Stock"):
        sums = {t: sum(r[name] for r in rows if r["Target Type"] == t and r["UOM"] == "Crates") for t in ("Sales", "AOP")}
        assert sums["Sales"] == pytest.approx(sums["AOP"])


def test_stock_flag_levels(evaluate):
    found = evaluate(kpi.stock_flag("v"), [0.0, 5.99, 6.0, 10.0, 10.5, None], "double")
    assert found == ["Low Stock", "Low Stock", "Optimal", "Optimal", "Over-stocked", "No Depletion"]


def test_stock_balance_is_floored(spark):
    row = spark.sql("select 10D as b, 5D as s, 20D as d")
    assert row.selectExpr(f"{kpi.stock_balance('b', 's', 'd')} as x").first()["x"] == 0.0


def test_report_names():
    names = ["last_day_py_shipment", "mtd_achievement_vs_aop_pct", "days_of_stock", "mtd_variance_vs_py", "yearly_landing"]
    assert [kpi.report_name(n) for n in names] == [
        "Last Day PY Shipment", "MTD Achievement vs AOP %", "Days of Stock", "MTD Variance vs PY", "Yearly Landing",
    ]


def test_regional_report(bundle):
    rows = {r["dv"]: r for r in bundle.regional_report().collect()}
    assert set(rows) == {"North", None}
    north = rows["North"]
    assert (north["actual_shipment_crates"], north["py_shipment_crates"]) == (40.0, 5.0)
    assert north["achievement_pct"] == pytest.approx(40 / 250)
    assert north["growth_vs_py_pct"] == pytest.approx(35 / 5)
    # The null region of the targets meets the null region of the facts.
    assert rows[None]["actual_shipment_crates"] == 6.0
    assert north["contribution_pct"] + rows[None]["contribution_pct"] == pytest.approx(1.0)


def test_regional_report_keeps_only_targeted_regions(spark):
    config = CONFIG.with_options(selected_target_type="SNOP")
    rows = ReportBundle(Inputs(mini_tables(spark), config)).regional_report().collect()
    assert [(r["dv"], r["contribution_pct"]) for r in rows] == [("North", 1.0)]


def test_target_pivot_fills_absent_types_and_drops_null_regions(inputs, bundle):
    row = bundle.regional_target_pivot().collect()
    assert [(r["dv"], r["SNOP"] > 0) for r in row] == [("North", True)]
    only_sales = inputs.targets.filter("target_type = 'Sales Target'")
    pivot = targets.pivot_by_type(only_sales, ["dv"], "target_crates_to_date").first()
    assert (pivot["AOP"], pivot["SNOP"]) == (0.0, 0.0)


def test_quality_checks(bundle):
    found = bundle.checks()
    assert rows_of(found["unmatched_target_brands"]) == [("AOP", "Stout", "STOUT"), ("Sales Target", "Stout", "STOUT")]
    agents = {row["agent_source_name"] for row in found["unmatched_actual_agents"].collect()}
    assert agents == {None, "Beta"}
    assert rows_of(found["unmatched_actual_brands"]) == [(None, None)]
    totals = {row["metric"]: row["value"] for row in found["reconciliation"].collect()}
    assert totals["YTD Difference"] == 0.0 and totals["Source YTD Shipment Crates"] == 46.0
    merged = {row["metric"]: row["difference"] for row in found["period_source_vs_merged"].collect()}
    # The prior-year sell-out of an agent outside the spine is lost from the merged side.
    assert merged["wtd_py_depletion"] == -9.0
    assert merged["wtd_shipment"] == 0.0
    shipped = {row["metric"]: row["value"] for row in found["shipment_totals"].collect()}
    assert shipped["Variance vs PY"] == 46.0 - 11.0
    span = found["date_range"].first()
    assert (span["min_date"], span["max_date"]) == (date(2026, 1, 5), date(2026, 3, 18))
    assert (span["positive_rows"], span["last_day_rows"], span["wtd_rows"]) == (6, 1, 2)
    assert {(r["metric"], r["UOM"]) for r in found["totals_by_uom"].collect()} >= {("YTD Shipment", "HL")}
    assert rows_of(found["missing_division"])[0][0] is None
    consolidation = {r["agent"]: (r["source_key_count"], r["brand_count"]) for r in found["agent_consolidation"].collect()}
    assert consolidation["Alpha"] == (1, 2)
    assert found["zero_period_rows"].count() == 0
    before_after = {r["UOM"]: r for r in found["stock_before_after"].collect()}
    assert before_after["Crates"]["Beginning_Stock_Before"] == 3 * 1005.0
    assert before_after["Crates"]["Beginning_Stock_After"] == 3 * 5.0
    for name in ("stock_totals", "totals_by_uom_type", "period_totals"):
        assert found[name].count() == 6
    assert found["month_parse"].count() == 6


def test_zero_periods_are_listed(spark):
    totals = spark.sql("select 'HL' as UOM, 'AOP' as `Target Type`, 0D as Last_Day_Sales, 0D as WTD_Sales")
    assert checks.zero_period_rows(totals).count() == 1


def test_prior_year_rows_in_actual_break_the_reconciliation(spark):
    headers, rows = TABLES["actual_shipment"]
    tables = mini_tables(spark, actual_shipment=(headers, rows + [("30/12/2025", "S4H Alpha", "Lager", "50")]))
    with pytest.raises(ValueError, match="YTD shipment mismatch"):
        build_report(tables, CONFIG, reconcile=True)
    build_report(tables, CONFIG)


def test_missing_tables_and_columns_raise(spark):
    tables = mini_tables(spark)
    short = {name: df for name, df in tables.items() if name != "stock"}
    with pytest.raises(KeyError, match="stock"):
        build_report(short, CONFIG)
    wrong = mini_tables(spark, py_shipment=(["Date", "Agent", "Brand"], [("1/1/2025", "a", "b")]))
    with pytest.raises(KeyError, match="Table py_shipment needs a column"):
        Inputs(wrong, CONFIG).prior
    dry = mini_tables(spark, ytd_depletion=(["Date", "Agent", "Brand"], [("1/1/2025", "a", "b")]))
    with pytest.raises(KeyError, match="ytd_depletion"):
        Inputs(dry, CONFIG).depletion


def test_views_of_the_star_schema(spark, inputs):
    assert "fact_target" in register_conformed(inputs)
    assert spark.table("fact_actual_shipment").first()["fact_source"] == "Actual Shipment"
    assert spark.table("dim_plant").count() == 1
    assert spark.table("selected_target").select("target_type").distinct().count() == 1


def test_working_day_lookup_of_unknown_days(spark, inputs):
    days = spark.sql("select date'2026-03-16' as d union all select date'2026-03-15' union all select null")
    found = cal.with_working_day(days, "d", inputs.calendar)
    assert rows_of(found) == [(None, False), (date(2026, 3, 15), False), (date(2026, 3, 16), True)]


def test_window_sums_are_null_outside_their_window(spark):
    fact = spark.sql("select date'2026-03-01' as event_date, 'a' as agent_raw, 'b' as item_raw, 2D as crates")
    windows = {"early": (None, date(2026, 2, 1)), "late": (date(2026, 3, 1), date(2026, 3, 2))}
    row = volumes.window_sums(fact, windows, volumes.SHIPMENT_NAMES, {"early": 0, "late": 1}).first()
    assert (row["early"], row["late"], row["rank"]) == (None, 2.0, 1)


def test_first_division_prefers_source_then_sorted_order(spark):
    rows = [("k", "b", "Z", "agent z", 0), ("k", "b", None, "agent n", 0), ("k", "b", "A", "agent a", 1), ("n", "b", None, None, 3)]
    part = spark.createDataFrame(rows, "agent_key string, brand_kpi_key string, division string, agent string, rank int")
    found = {r["agent_key"]: r for r in metrics.key_spine([part], CONFIG.brand_rules).collect()}
    assert (found["k"]["division"], found["k"]["agent"]) == ("Z", "agent z")
    assert (found["n"]["division"], found["n"]["agent"]) == (None, None)


def test_keep_first_follows_the_row_id(spark):
    rows = [("k", "second", 2), ("k", "first", 1), (None, "none", 0)]
    df = spark.createDataFrame(rows, "key string, value string, _row_id int")
    assert rows_of(mdm.keep_first(df, "key", ["value"])) == [("k", "first")]


def test_config_is_checked():
    with pytest.raises(ValueError):
        ReportConfig(selected_target_type="Sales")
    with pytest.raises(ValueError):
        ReportConfig(number_mode="other")
