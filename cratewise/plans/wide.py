"""The wide KPI table in crates and its two-unit report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cratewise.operators import kpi, metrics
from cratewise.plans.inputs import Inputs
from cratewise.session import checkpointed

NAMES = ("division", "agent", "brand")


def metric_table(inputs: Inputs, observed: Observation | None = None, kept: bool = False) -> DataFrame:
    """Keys, names and the 35 measures, one row per (agent key, brand key).

    ``kept`` stores the metric rows first and sums them without a sort.
    """
    parts = inputs.metric_parts(observed)
    table = metrics.assemble_kept(checkpointed(metrics.union_of(parts))) if kept else metrics.assemble(parts)
    return metrics.add_brand_name(table, inputs.config.brand_rules)


def kpi_wide(inputs: Inputs, table: DataFrame | None = None) -> DataFrame:
    """The metric table with all derived KPIs."""
    table = metric_table(inputs) if table is None else table
    return kpi.add_kpis(table, inputs.dates).select(*metrics.KEYS, *NAMES, *kpi.WIDE_MEASURES)


def uom_report(wide: DataFrame, hl_per_crate: float) -> DataFrame:
    """The wide table in both units, without the keys."""
    return kpi.expand_units(wide, kpi.VOLUMES, hl_per_crate).select(*NAMES, "uom", *kpi.WIDE_MEASURES)


def with_report_names(df: DataFrame) -> DataFrame:
    """Report headers, in report order."""
    renamed = {name: kpi.report_name(name) for name in df.columns if name in kpi.WIDE_MEASURES + list(NAMES)}
    renamed["uom"] = "UOM"
    return df.withColumnsRenamed(renamed)


def sorted_report(wide: DataFrame) -> DataFrame:
    return wide.orderBy(
        F.asc_nulls_last("division"), F.asc_nulls_last("agent"), F.desc_nulls_last("mtd_shipment")
    )
