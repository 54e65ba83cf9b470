"""What is read how often: day sums, footers, observed totals, levels, text days, the day store."""

import time
from datetime import date, timedelta

import counted
import pytest
from pyspark.sql import functions as F

from cratewise.functions.dates import parse_date
from cratewise.operators import volumes
from cratewise.operators.day_sums import dated, day_sums
from cratewise.plans import checks
from cratewise.plans.inputs import Inputs
from cratewise.plans.report import build_report
from cratewise.session import configure
from cratewise.sources import footers
from cratewise.sources.catalog import ROW_ID, SourceSpec, load_tables
from cratewise.sources.day_store import DayStore
from cratewise.sources.sample import SampleTables
from mini import CONFIG, TABLES, mini_tables

FACTS = ("actual_shipment", "py_shipment", "ytd_depletion", "py_depletion")


@pytest.fixture(scope="module", autouse=True)
def whole_plan_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def spec_of(spark, folder, name, df):
    """The table as Parquet behind the source that counts its scans."""
    path = str(folder / f"{name}.parquet")
    df.toPandas().to_parquet(path)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return SourceSpec("", "counted", {"rows": path, "log": str(folder / f"{name}.log"), "schema": schema})


def test_one_scan_of_each_fact(spark, tmp_path):
    """The report, its gate and every check read each volume fact once; sources without files load."""
    counted.register(spark)
    mini = mini_tables(spark)
    tables, report = load_tables(spark, {name: spec_of(spark, tmp_path, name, mini[name]) for name in TABLES})
    assert set(report.values()) == {"loaded"}
    bundle = build_report(tables, CONFIG, reuse=True, reconcile=True)
    found = {name: df.count() for name, df in bundle.checks().items()}
    assert {name: counted.reads(str(tmp_path / f"{name}.log")) for name in FACTS} == dict.fromkeys(FACTS, 1)
    assert bundle.final_extract.collect() == build_report(mini, CONFIG).final_extract.collect()
    kept, direct = bundle.checks(), build_report(mini, CONFIG).checks()
    assert found["totals_by_level"] == 12
    for name in ("date_range", "shipment_totals", "period_source_vs_merged", "unmatched_actual_agents"):
        assert rows_of(kept[name]) == rows_of(direct[name]), name


def test_observed_totals_settle_the_gate_and_a_planted_row_raises(spark):
    bundle = build_report(mini_tables(spark), CONFIG, reuse=True, reconcile=True)
    assert bundle.observed == {"source_ytd": 46.0, "source_mtd": 39.0, "final_ytd": 46.0, "final_mtd": 39.0}
    seen = {r["metric"]: r["value"] for r in bundle.reconciliation().collect()}
    assert (seen["Source YTD Shipment Crates"], seen["Final MTD Shipment Crates"]) == (46.0, 39.0)
    headers, rows = TABLES["actual_shipment"]
    planted = mini_tables(spark, actual_shipment=(headers, rows + [("30/12/2025", "S4H Alpha", "Lager", "50")]))
    with pytest.raises(ValueError, match="YTD shipment mismatch"):
        build_report(planted, CONFIG, reuse=True, reconcile=True)


def test_twice_observed_rows_are_looked_at_again(spark):
    bundle = build_report(mini_tables(spark), CONFIG, reuse=True)
    assert bundle.metric_table.count() > 0
    bundle.observed["source_ytd"] *= 2
    bundle.assert_reconciled()


@pytest.fixture(scope="module")
def parquet_specs(spark, tmp_path_factory):
    """The mini tables as Parquet with typed days and wide facts."""
    folder, specs = tmp_path_factory.mktemp("typed"), {}
    for name, df in mini_tables(spark).items():
        for column in set(df.columns) & {"Date", "Billing Date", "Reporting Date"}:
            df = df.withColumn(column, F.expr(parse_date(f"`{column}`")))
        if name in FACTS:
            df = df.withColumn("Remark", F.lit("never read")).withColumn("Net Value", F.rand(1))
        df.write.parquet(str(folder / name))
        specs[name] = SourceSpec(str(folder / name), "parquet")
    return specs


def test_facts_are_pruned_and_bounded_in_the_scan(spark, parquet_specs):
    tables, _ = load_tables(spark, parquet_specs)
    inputs = Inputs(tables, CONFIG, bounds=tables.bounds)
    scan = next(line for line in plan_of(inputs.shipment()).splitlines() if "FileScan parquet" in line and "Invoiced" in line)
    assert "ReadSchema: struct<Date:date,Agent:string,Item Description:string,Invoiced Quantity:string>" in scan
    assert "Remark" not in scan and "_metadata" not in scan and "file_path" not in scan
    assert "GreaterThanOrEqual(Date" in scan and "LessThanOrEqual(Date" in scan
    assert ROW_ID not in tables["actual_shipment"].columns and ROW_ID in tables["agent_left"].columns
    # The views still show every column.
    assert "Remark" in tables["actual_shipment"].columns


def test_typed_files_give_the_report_of_the_sheets(spark, parquet_specs):
    tables, _ = load_tables(spark, parquet_specs)
    expected = rows_of(build_report(mini_tables(spark), CONFIG).final_extract)
    assert rows_of(build_report(tables, CONFIG, reuse=True, reconcile=True).final_extract) == expected
    assert rows_of(build_report(tables, CONFIG).final_extract) == expected


def test_footers_tell_the_last_dates(spark, parquet_specs):
    tables, _ = load_tables(spark, parquet_specs)
    with footers.aggregates_pushed_down(spark):
        query = footers.bounds_query(spark, parquet_specs["actual_shipment"].path, "Date")
        assert "PushedAggregation: [MIN(Date), MAX(Date), COUNT(*)]" in plan_of(query)
        assert "FileScan" not in plan_of(query)
    assert tables.bounds.of("actual_shipment", "Date") == (date(2026, 1, 5), date(2026, 3, 18), 9)
    assert tables.bounds.of("stock", "Reporting Date").largest == date(2026, 3, 1)
    # Texts have no bounds in footers, and other sources no footers.
    assert tables.bounds.of("actual_shipment", "Agent") is None and tables.bounds.of("nowhere", "Date") is None
    inputs = Inputs(tables, CONFIG, bounds=tables.bounds)
    assert inputs.footer_date("actual_shipment", ["Date"]) == date(2026, 3, 18)
    assert inputs.dates == Inputs(tables, CONFIG).dates
    early = CONFIG.with_options(as_of=date(2026, 3, 12))
    assert Inputs(tables, early, bounds=tables.bounds).footer_date("actual_shipment", ["Date"]) is None


def test_volume_before_the_last_month_is_found(spark):
    rows = [("18/03/2026", "a", "b", "0"), ("05/01/2026", "a", "b", "3")]
    shaped = dated(volumes.shape_shipment(mini_tables(spark, actual_shipment=(TABLES["actual_shipment"][0], rows))["actual_shipment"], "actual_shipment", CONFIG, with_cutoff=True))
    from cratewise.operators.calendar import last_dates

    assert last_dates(shaped, date(2026, 3, 18)) == last_dates(shaped) == (date(2026, 3, 18), date(2026, 1, 5))


def test_as_of_gives_the_report_of_that_day(spark):
    headers, rows = TABLES["actual_shipment"]
    until = [r for r in rows if r[0] in ("16/03/2026", "02/03/2026", "05/01/2026", "10/03/2026", "11/03/2026")]
    earlier = build_report(mini_tables(spark, actual_shipment=(headers, until)), CONFIG)
    for reuse in (False, True):
        as_of = build_report(mini_tables(spark), CONFIG.with_options(as_of=date(2026, 3, 16)), reuse=reuse)
        assert as_of.inputs.dates == earlier.inputs.dates
        assert rows_of(as_of.final_extract) == rows_of(earlier.final_extract)
    before = build_report(mini_tables(spark), CONFIG.with_options(as_of=date(2026, 2, 1)))
    assert {r["beginning_stock"] for r in before.opening_stock().collect()} == {999.0, 9.0}


def test_text_days_are_parsed_once_per_spelling(spark, tmp_path):
    """Rows are looked up by spelling; the scan of the fact runs no lambda."""
    rows = spark.range(1_000_000, numPartitions=4).selectExpr(
        "date_format(date_add(date'2024-01-01', cast(id % 900 as int)), 'dd/MM/yyyy') as event_date",
        "'a' as agent_raw", "'b' as item_raw", "1D as crates",
    )
    rows.write.parquet(str(tmp_path / "spelled"))
    spelled = spark.read.parquet(str(tmp_path / "spelled"))
    assert "transform(" not in plan_of(dated(spelled)) and "transform(" not in plan_of(day_sums(spelled, volumes.SHIPMENT_NAMES))

    def seconds(df):
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    plain = spelled.selectExpr("try_to_date(event_date, 'dd/MM/yyyy') as event_date", "agent_raw", "item_raw", "crates")
    times = {name: min(seconds(df) for _ in range(3)) for name, df in (("plain", plain), ("by value", dated(spelled)))}
    assert times["by value"] < 2 * times["plain"], times
    sums = day_sums(spelled, volumes.SHIPMENT_NAMES)
    assert (sums.count(), sums.agg(F.sum("row_count")).first()[0]) == (900, 1_000_000)


def test_day_sums_equal_the_rows(spark):
    rows = mini_tables(spark)["actual_shipment"]
    shaped = volumes.shape_shipment(rows, "actual_shipment", CONFIG, with_cutoff=True)
    windows = {"some": (date(2026, 3, 10), date(2026, 3, 18)), "none": (date(2020, 1, 1), date(2020, 1, 2)), "all": (None, date(2026, 3, 18))}
    both = [volumes.window_sums(f, windows, volumes.SHIPMENT_NAMES, {"some": 0, "all": 1}) for f in (dated(shaped), day_sums(shaped, volumes.SHIPMENT_NAMES))]
    assert rows_of(both[0]) == rows_of(both[1])


def test_levels_are_summed_in_one_pass(spark, folder):
    bundle = build_report(mini_tables(spark), CONFIG, reuse=True)
    levels = checks.level_totals(bundle.extract_rows)
    assert plan_of(levels).count("Expand [") == 1
    for name, keys, found in (
        ("totals_by_uom_type", checks.UNIT_AND_TYPE, checks.with_total_ratios), ("stock_totals", checks.UNIT_AND_TYPE, checks.shown_stock_totals),
        ("stock_before_after", ("UOM",), checks.shown_stock_change),
    ):
        assert rows_of(found(checks.at_level(levels, keys))) == rows_of(getattr(checks, name)(bundle.extract_rows))
    assert {r["level"] for r in levels.collect()} == {"UOM and Target Type", "UOM", "Target Type", "All"}


def test_regions_are_planned_once(spark, folder):
    sample = SampleTables(configure(spark), folder)
    plan = plan_of(build_report(sample, sample.config).regional_report())
    assert plan.count("FileScan parquet") == plan.split("Subquery")[0].count("FileScan parquet")


def fact_rows(spark, days, crates=1.0):
    rows = [(date(2026, 1, 1) + timedelta(days=d), f"agent {a}", "Lager", crates) for d in days for a in range(3)]
    return spark.createDataFrame(rows, "event_date date, agent_raw string, item_raw string, crates double").withColumn("cutoff_date", F.col("event_date"))


def test_the_day_store_sums_only_what_changed(spark, tmp_path):
    names, path = volumes.SHIPMENT_NAMES, str(tmp_path / "store")
    first, more = fact_rows(spark, range(0, 50)), fact_rows(spark, range(0, 65))
    store = DayStore(spark, path)
    assert rows_of(store.refreshed("f", first, names)) == rows_of(day_sums(first, names))
    assert store.summed["f"] == ["2026-01", "2026-02"]
    again = DayStore(spark, path)
    assert rows_of(again.refreshed("f", more, names)) == rows_of(day_sums(more, names))
    assert again.summed["f"] == ["2026-02", "2026-03"]
    unchanged = DayStore(spark, path)
    assert rows_of(unchanged.refreshed("f", more, names)) == rows_of(day_sums(more, names))
    assert unchanged.summed["f"] == []
    # A month that left the source, rows without a day, and corrected figures.
    less = fact_rows(spark, range(31, 65)).unionByName(fact_rows(spark, [40]).withColumn("event_date", F.lit(None).cast("date")))
    assert rows_of(DayStore(spark, path).refreshed("f", less, names)) == rows_of(day_sums(less, names))
    corrected = fact_rows(spark, range(31, 65), 2.0)
    assert rows_of(DayStore(spark, path, rebuild=True).refreshed("f", corrected, names)) == rows_of(day_sums(corrected, names))
    empty = corrected.limit(0)
    assert DayStore(spark, path).refreshed("f", empty, names).count() == 0


def test_a_report_from_the_store_is_the_same(spark, tmp_path):
    expected = rows_of(build_report(mini_tables(spark), CONFIG).final_extract)
    for months in (["2026-01", "2026-03", "undated"], []):
        store = DayStore(spark, str(tmp_path / "store"))
        assert rows_of(build_report(mini_tables(spark), CONFIG, reuse=True, reconcile=True, store=store).final_extract) == expected
        assert store.summed["actual_shipment"] == months


def test_shifted_dates_give_the_same_counts(spark, folder, tmp_path):
    """Nothing hangs on the year the tables happen to end in."""
    from workload.queries import QUERIES

    for name in ("supplier", "part", "nation", "region"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    for name, column in (("lineitem", "l_shipdate"), ("orders", "o_orderdate")):
        df = spark.read.parquet(f"{folder}/{name}.parquet")
        # Four years later weekdays differ, but leap days stay where they are.
        df.withColumn(column, F.expr(f"{column} + interval 4 years")).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name in ("shipment_mtd_ytd", "depletion_mtd_ytd", "calendar_days", "opening_stock", "target_totals", "key_spine"):
        assert QUERIES[name](spark, str(tmp_path)).count() == QUERIES[name](spark, folder).count() > 0, name


def test_kept_metric_rows_are_summed_without_a_sort(spark, folder):
    from cratewise.operators import metrics

    sample = SampleTables(configure(spark), folder)
    inputs = Inputs(sample, sample.config)
    rows = metrics.union_of(inputs.metric_parts())
    rows.write.mode("overwrite").saveAsTable("metric_rows_of_test")
    stored = spark.table("metric_rows_of_test")
    kept = metrics.assemble_kept(stored)
    plan = plan_of(kept)
    assert not [line for line in plan.splitlines() if "SortAggregate" in line and "mtd_shipment" in line]
    # Both aggregates meet on the exchange they have; nothing is dealt a third time.
    assert plan.count("Exchange hashpartitioning") == 2
    direct = metrics.assemble([stored])
    rounded = [F.round(F.col(m), 6).alias(m) for m in metrics.MEASURES]
    assert rows_of(kept.select(*metrics.KEYS, "division", "agent", *rounded)) == rows_of(direct.select(*metrics.KEYS, "division", "agent", *rounded))


def test_bucketed_day_sums_move_no_row_for_the_agent_lookup(spark):
    from cratewise.sources.layout import BucketedTables

    expected = rows_of(build_report(mini_tables(spark), CONFIG).final_extract)
    bundle = build_report(mini_tables(spark), CONFIG, reuse=True, reconcile=True, store=BucketedTables(spark, "bucketed_of_test", 4))
    assert rows_of(bundle.final_extract) == expected
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(bundle.inputs.shipment())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [agent_source_key" in plan
    assert "hashpartitioning(agent" not in plan and "Bucketed: true" in plan
