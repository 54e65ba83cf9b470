"""The metric table as a chain of left joins, one per measure.

A yardstick for the one-shuffle form: same inputs, same result, one aggregate
and one null-safe join per measure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.operators import metrics
from cratewise.plans.inputs import Inputs


def metric_table_by_joins(inputs: Inputs) -> DataFrame:
    parts = inputs.metric_parts()
    table = metrics.key_spine(parts, inputs.config.brand_rules)
    for part in parts:
        for measure in [name for name in part.columns if name in metrics.MEASURES]:
            right = metrics.metric_only(part, [measure]).withColumnsRenamed(
                {"agent_key": "right_agent", "brand_kpi_key": "right_brand"}
            )
            same = F.expr("agent_key <=> right_agent and brand_kpi_key <=> right_brand")
            table = table.join(right, same, "left").drop("right_agent", "right_brand")
    return table.na.fill(0.0, subset=list(metrics.MEASURES))
