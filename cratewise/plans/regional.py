"""Regional sell-in against the selected target and the prior year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.functions.numbers import safe_divide, total
from cratewise.functions.sql import number
from cratewise.operators.targets import selected_target_by_region
from cratewise.plans.inputs import Inputs


def by_region(conformed: DataFrame, prefix: str, hl_per_crate: float) -> DataFrame:
    crates = total("to_date")
    return conformed.groupBy(F.col("division").alias("dv")).agg(
        F.expr(f"{crates} as {prefix}_shipment_crates"),
        F.expr(f"{crates} * {number(hl_per_crate)} as {prefix}_shipment_hl"),
    )


def attach_by_region(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join in which a null region meets the null region."""
    renamed = right.withColumnRenamed("dv", "right_dv")
    return left.join(renamed, F.expr("dv <=> right_dv"), "left").drop("right_dv")


def regional_report(inputs: Inputs) -> DataFrame:
    """One row per region with a selected target, largest sell-in first."""
    factor = inputs.config.hl_per_crate
    joined = attach_by_region(
        selected_target_by_region(inputs.phased_targets, inputs.config.selected_target_type),
        by_region(inputs.shipment(to_date=True), "actual", factor),
    )
    joined = attach_by_region(joined, by_region(inputs.py_shipment(to_date=True), "py", factor))
    volumes = [f"{p}_shipment_{u}" for p in ("actual", "py") for u in ("crates", "hl")]
    report = joined.na.fill(0.0, subset=volumes)
    # One row per region: gathered with their total, so that the facts are planned once.
    gathered = report.agg(F.collect_list(F.struct(*report.columns)).alias("rows"), F.sum("actual_shipment_crates").alias("grand_total"))
    return gathered.selectExpr("grand_total", "inline(rows)").selectExpr(
        *report.columns,
        "actual_shipment_crates - target_crates_to_date as variance_vs_target_crates",
        f"{safe_divide('actual_shipment_crates', 'target_crates_to_date')} as achievement_pct",
        "actual_shipment_crates - py_shipment_crates as variance_vs_py_crates",
        f"{safe_divide('(actual_shipment_crates - py_shipment_crates)', 'py_shipment_crates')} as growth_vs_py_pct",
        f"{safe_divide('actual_shipment_crates', 'grand_total')} as contribution_pct",
    ).orderBy(F.desc_nulls_last("actual_shipment_crates"))
