"""Master data: agent and brand dimensions and the lookups against them.

The dimensions are unique and non-null on their key, so a plain left join
neither multiplies nor loses fact rows. They grow with the business, so the
joins carry no broadcast hint: Spark picks by measured size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.config import DIVISION, MDM_AGENT, MDM_REPORTING_NAME, BrandRules
from cratewise.functions.sql import quoted
from cratewise.functions.text import brand_kpi_key, clean_text, strip
from cratewise.sources.catalog import ROW_ID, find_col, optional_col, with_row_id


# The agent's lookup key; frames from a bucketed store bring it along.
AGENT_KEY = "agent_source_key"


def keep_first(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per non-null key: the first in source order.

    An aggregate instead of a ranked window, so that copies of a hot key
    shrink before the shuffle.
    """
    first = F.expr(f"min_by(struct({', '.join(columns)}), {ROW_ID})").alias("first")
    return df.filter(f"{key} is not null").groupBy(key).agg(first).select(key, "first.*")


def row_id(df: DataFrame) -> DataFrame:
    return df if ROW_ID in df.columns else with_row_id(df, from_files=False)


def brand_dimension(brand_left: DataFrame, rules: BrandRules) -> DataFrame:
    """brand_key, reporting_name and its brand_kpi_key; a missing reporting name stays null."""
    item = quoted(find_col(brand_left, ["Item Description"], "brand_left"))
    name = quoted(find_col(brand_left, ["Report Naming"], "brand_left"))
    shaped = row_id(brand_left).selectExpr(
        f"{clean_text(f'cast({item} as string)')} as brand_key",
        f"{strip(f'cast({name} as string)')} as reporting_name",
        ROW_ID,
    )
    return keep_first(shaped, "brand_key", ["reporting_name"]).selectExpr(
        "*", f"{brand_kpi_key('reporting_name', rules)} as brand_kpi_key"
    )


def agent_dimension(agent_left: DataFrame) -> DataFrame:
    """agent_source_key, agent_key, agent, division; one row per source name."""
    source = find_col(agent_left, MDM_AGENT, "agent_left")
    division = quoted(find_col(agent_left, DIVISION, "agent_left"))
    reporting = quoted(optional_col(agent_left, MDM_REPORTING_NAME) or source)
    source_name = f"cast({quoted(source)} as string)"
    name = strip(f"coalesce(cast({reporting} as string), {source_name})")
    shaped = row_id(agent_left).selectExpr(
        f"{clean_text(source_name)} as agent_source_key",
        f"{clean_text(name)} as agent_key",
        f"{name} as agent",
        f"cast({division} as string) as division",
        ROW_ID,
    )
    return keep_first(shaped, "agent_source_key", ["agent_key", "agent", "division"])


def add_agent_fields(df: DataFrame, dim_agent: DataFrame, own_division: str | None = None) -> DataFrame:
    """Replaces agent_raw by agent_source_name, agent, agent_key and division.

    The key is that of the reporting name, so several source names of one agent
    meet; the dimension carries it ready made. The column ``own_division`` fills in where the dimension has none.
    """
    lookup = dim_agent.selectExpr(
        "agent_source_key", "agent_key as mdm_key", "agent as mdm_agent", "division as mdm_division"
    )
    keyed = df if AGENT_KEY in df.columns else df.withColumn(AGENT_KEY, F.expr(clean_text("agent_raw")))
    joined = keyed.join(lookup, AGENT_KEY, "left")
    return joined.selectExpr(
        *[quoted(name) for name in df.columns if name not in ("agent_raw", AGENT_KEY)],
        "agent_raw as agent_source_name",
        "coalesce(mdm_agent, agent_raw) as agent",
        f"if(mdm_agent is null, {clean_text('agent_raw')}, mdm_key) as agent_key",
        f"coalesce(mdm_division, {own_division}) as division" if own_division else "mdm_division as division",
    )


def matched(condition: str, alias: str) -> str:
    return f"if({condition}, 'Matched', 'Not Matched') as {alias}"


def add_brand_fields(df: DataFrame, dim_brand: DataFrame, rules: BrandRules) -> DataFrame:
    """Replaces item_raw by original_brand, brand_key, reporting_name, brand_match and brand_kpi_key."""
    lookup = dim_brand.selectExpr(
        "brand_key", "reporting_name as mdm_brand", "brand_kpi_key as mdm_kpi_key", "true as known"
    )
    joined = df.withColumn("brand_key", F.expr(clean_text("item_raw"))).join(lookup, "brand_key", "left")
    return joined.selectExpr(
        *[quoted(name) for name in df.columns if name != "item_raw"],
        "item_raw as original_brand",
        "brand_key",
        "coalesce(mdm_brand, item_raw) as reporting_name",
        matched("known is not null", "brand_match"),
        f"if(mdm_brand is null, {brand_kpi_key('item_raw', rules)}, mdm_kpi_key) as brand_kpi_key",
    )


def conform_shipment(df: DataFrame, dim_agent: DataFrame, dim_brand: DataFrame, rules: BrandRules) -> DataFrame:
    """Names of a sell-in frame; the division comes from the dimension only."""
    named = add_brand_fields(add_agent_fields(df, dim_agent), dim_brand, rules)
    return named.selectExpr("*", matched("division is not null", "agent_match"))


def conform_depletion(df: DataFrame, dim_agent: DataFrame, rules: BrandRules) -> DataFrame:
    """Names of a sell-out frame; the brand key comes from its own brand text."""
    named = add_agent_fields(df, dim_agent, "dv_raw")
    return named.selectExpr("*", f"{brand_kpi_key('item_raw', rules)} as brand_kpi_key")
