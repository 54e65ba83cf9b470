"""What the plans look like, and that they give the same rows beyond the broadcast limit."""

import re

import pytest
from pyspark.sql import functions as F

from cratewise.plans.inputs import Inputs
from cratewise.plans.report import ReportBundle
from cratewise.session import SETTINGS
from cratewise.sources.sample import SampleTables
from mini import CONFIG, TABLES, mini_tables
from workload.join_chain import metric_table_by_joins


@pytest.fixture(scope="module", autouse=True)
def whole_plan_text(spark):
    """Keeps long filter lists in the printed plans."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bundle(spark, folder):
    sample = SampleTables(spark, folder)
    return ReportBundle(Inputs(sample, sample.config))


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_no_cross_joins_windows_or_python(bundle):
    for df in (bundle.final_extract, bundle.uom_report, bundle.regional_report(), bundle.reconciliation()):
        plan = plan_of(df)
        for unwanted in ("Cartesian", "NestedLoop", "BatchEvalPython", "ArrowEvalPython", "Window ["):
            assert unwanted not in plan


def test_fact_scans_read_four_columns_and_push_the_dates(bundle):
    plan = plan_of(bundle.inputs.shipment())
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "l_shipdate" in line)
    assert "l_extendedprice" not in scan and "l_orderkey" not in scan
    assert "GreaterThanOrEqual(l_shipdate" in scan and "LessThan(l_shipdate" in scan


def test_date_windows_of_the_engine_reach_the_scan(spark, folder):
    """The engine's own bounds are pushed, not only those of the sample tables."""
    raw = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        F.col("l_shipdate").alias("Date"), F.col("l_returnflag").alias("Agent"),
        F.col("l_linestatus").alias("Brand"), F.col("l_quantity").alias("Qty"),
    )
    tables = {**mini_tables(spark), "actual_shipment": raw}
    inputs = Inputs(tables, CONFIG)
    scan = next(line for line in plan_of(inputs.shipment()).splitlines() if "FileScan parquet" in line)
    pushed = re.search(r"PushedFilters: \[(.*?)\]", scan).group(1)
    assert "GreaterThanOrEqual(l_shipdate" in pushed and "LessThan" in pushed


def test_facts_shrink_before_any_lookup(bundle):
    """Between the fact scan and the name lookups stands the aggregate on source names."""
    plan = plan_of(bundle.inputs.shipment())
    lookup = plan.index("agent_source_key")
    assert plan.index("HashAggregate(keys=[agent_raw") > lookup > 0
    assert "partial_sum" in plan


def test_one_shuffle_form_equals_the_join_chain(bundle):
    columns = ["agent_key", "brand_kpi_key", "division", "agent", "brand"]
    measures = [c for c in bundle.metric_table.columns if c not in columns]
    rounded = [F.round(F.col(m), 6).alias(m) for m in measures]
    chain = metric_table_by_joins(bundle.inputs).select(*columns, *rounded)
    assert rows_of(chain) == rows_of(bundle.metric_table.select(*columns, *rounded))


def test_beyond_the_broadcast_limit_the_result_is_the_same(spark, bundle):
    expected = rows_of(bundle.inputs.shipment())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(bundle.inputs.shipment())
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert rows_of(bundle.inputs.shipment()) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_agent_with_most_rows_leaves_each_task_as_one_row(spark):
    """A hot name is summed inside the scanning tasks, so the shuffle sees a row per task and pair."""
    headers = TABLES["actual_shipment"][0]
    hot = spark.range(200_000, numPartitions=4).selectExpr(
        "'17/03/2026' as Date", "if(id % 3 = 0, 'S4H Alpha', concat('agent ', id % 7)) as Agent",
        "'Lager' as `Item Description`", "'1' as `Invoiced Quantity`",
    )
    assert hot.columns == headers
    inputs = Inputs({**mini_tables(spark), "actual_shipment": hot}, CONFIG)
    sums = {row["agent"]: row["mtd_shipment"] for row in inputs.shipment().collect()}
    assert sums["Alpha"] == 66_667.0
    assert sum(sums.values()) == 200_000.0


def test_partitions_leave_room_to_sort_metric_rows():
    """A task sorts some ten times what it reads; a quarter of 3,600 MB is to be enough."""
    size = SETTINGS["spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    assert 300 + 10 * int(size.removesuffix("m")) < 900
