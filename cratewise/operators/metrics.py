"""The metric table: every fact's measures on (agent key, brand key) in one aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.config import BrandRules
from cratewise.functions.numbers import totals
from cratewise.functions.text import brand_display_name
from cratewise.operators.targets import TARGET_MEASURES

PERIOD_NAMES = ("last_day", "wtd", "mtd", "ytd")
SHIPMENT_MEASURES = [f"{p}_shipment" for p in PERIOD_NAMES]
PY_SHIPMENT_MEASURES = [f"{p}_py_shipment" for p in PERIOD_NAMES]
DEPLETION_MEASURES = [f"{p}_depletion" for p in PERIOD_NAMES]
PY_DEPLETION_MEASURES = [f"{p}_py_depletion" for p in PERIOD_NAMES]
MEASURES = (
    ["beginning_stock"]
    + SHIPMENT_MEASURES
    + PY_SHIPMENT_MEASURES
    + DEPLETION_MEASURES
    + PY_DEPLETION_MEASURES
    + TARGET_MEASURES
)
KEYS = ("agent_key", "brand_kpi_key")
# Place of a row's source in the order the key spine is read: prior-year
# sell-out and the last-day and week windows give no keys.
SHIPMENT_RANKS = {"mtd_shipment": 0, "ytd_shipment": 1}
PY_SHIPMENT_RANKS = {"mtd_py_shipment": 2, "ytd_py_shipment": 3}
DEPLETION_RANKS = {"mtd_depletion": 7, "ytd_depletion": 8}


def metric_rows(conformed: DataFrame, measures: Sequence[str]) -> DataFrame:
    """A conformed fact cut to keys, spine columns and its own measures."""
    rank = "rank" if "rank" in conformed.columns else "cast(null as int) as rank"
    return conformed.selectExpr(*KEYS, "division", "agent", rank, *measures)


def metric_only(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """One row per key pair, measures summed and zero-filled."""
    return df.groupBy(*KEYS).agg(*[F.expr(t) for t in totals(measures)])


def spine_aggregates() -> list[str]:
    """First non-null division and agent in source order, and whether a key counts."""
    division_order = "if(rank is not null and division is not null, struct(rank, division), null)"
    agent_order = (
        "if(rank is not null and agent is not null, "
        "struct(rank, division is null as no_division, division, agent), null)"
    )
    return [
        f"min_by(division, {division_order}) as division",
        f"min_by(agent, {agent_order}) as agent",
        "max(rank is not null) as in_base",
    ]


def assemble(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of all metric rows, summed once per key pair; keys outside the spine fall away.

    Takes the place of one left join per measure: missing measures are null
    columns of the union, null keys form a group of their own.
    """
    rows = union_of(parts)
    present = [m for m in MEASURES if m in rows.columns]
    summed = rows.groupBy(*KEYS).agg(*[F.expr(e) for e in spine_aggregates() + totals(present)])
    return summed.filter("in_base").drop("in_base")


# Null-free stand-ins of the keys: aggregates by them meet in a join without another shuffle.
CODED = {"_agent": "coalesce(agent_key, '')", "_no_agent": "agent_key is null", "_brand": "coalesce(brand_kpi_key, '')", "_no_brand": "brand_kpi_key is null"}


def assemble_kept(rows: DataFrame) -> DataFrame:
    """``assemble`` for metric rows that are stored.

    Names are texts, which an aggregate can't change in place: with them among
    its results it sorts every row with all measures. Here measures are summed
    by hash, names come from an aggregate over the few name columns, and both,
    dealt by the same keys, are joined where they are.
    """
    coded = rows.selectExpr(*[f"{value} as {name}" for name, value in CODED.items()], *[c for c in rows.columns if c not in KEYS])
    present = [m for m in MEASURES if m in rows.columns]
    summed = coded.groupBy(*CODED).agg(*[F.expr(t) for t in totals(present)])
    counted = coded.filter("rank is not null").groupBy(*CODED).agg(*[F.expr(e) for e in spine_aggregates()[:2]])
    joined = summed.join(counted, list(CODED))
    keys = ["if(_no_agent, null, _agent) as agent_key", "if(_no_brand, null, _brand) as brand_kpi_key"]
    return joined.selectExpr(*keys, "division", "agent", *present)


def union_of(parts: Sequence[DataFrame]) -> DataFrame:
    """All metric rows; measures that a part lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def key_spine(parts: Sequence[DataFrame], rules: BrandRules) -> DataFrame:
    """One division, agent and brand name per key pair."""
    rows = reduce(DataFrame.unionByName, [part.select(*KEYS, "division", "agent", "rank") for part in parts])
    spine = rows.groupBy(*KEYS).agg(*[F.expr(e) for e in spine_aggregates()])
    return add_brand_name(spine.filter("in_base").drop("in_base"), rules)


def add_brand_name(df: DataFrame, rules: BrandRules) -> DataFrame:
    return df.selectExpr("*", f"{brand_display_name('brand_kpi_key', rules)} as brand")
