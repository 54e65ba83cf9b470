"""Run parameters, brand rules and the accepted column spellings."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from datetime import date

# Unit factor, target types and the words dropped from a brand
# text before it becomes a key (in this order).
HL_PER_CRATE = 0.0792
TARGET_TYPES = ("AOP", "SNOP", "Sales Target")
BRAND_WORDS_REMOVED = (
    " BEER",
    " MALT",
    " CRATE",
    " 24X33",
    "24X33",
    " H+HK",
    "H+HK",
    " H + HK",
    "H + HK",
)

# The input tables, with the name of the view over each as it was loaded.
VIEWS = {
    "aop_target": "fact_aop_target",
    "sales_target": "fact_sales_target",
    "snop_target": "fact_snop_target",
    "agent_left": "dim_agent",
    "brand_left": "dim_brand_raw",
    "calendar_mdm": "dim_calendar",
    "hl_converter": "dim_hl_converter",
    "plant_code": "dim_plant",
    "stock": "fact_stock",
    "py_shipment": "fact_py_shipment",
    "actual_shipment": "fact_actual_shipment",
    "py_depletion": "fact_py_depletion",
    "ytd_depletion": "fact_ytd_depletion",
}
REQUIRED_TABLES = tuple(VIEWS)

# Accepted header spellings per role; the first one present wins.
EVENT_DATE = ("Date", "Billing Date", "Shipment Date", "Posting Date", "Invoice Date")
CUTOFF_DATE = ("Billing Date", "Date", "Shipment Date", "Posting Date", "Invoice Date")
SHIPMENT_AGENT = ("Agent", "Sales Unit", "Sold-to Name", "Customer Name", "Customer")
SHIPMENT_ITEM = ("Item Description", "Brand", "Product", "Material Description")
SHIPMENT_CRATES = (
    "Invoiced Quantity",
    "Shipment",
    "Shipment Crates",
    "Crates",
    "Quantity",
    "Qty",
    "Billed Quantity",
)
DEPLETION_DATE = ("Date", "Billing Date", "Depletion Date", "Posting Date", "Invoice Date")
DEPLETION_AGENT = ("Sales Unit", "Agent", "Sold-to Name", "Customer Name", "Customer")
DEPLETION_ITEM = ("Brand H+HK", "Product", "Item Description", "Brand", "Material Description")
DEPLETION_HL = ("Dep HL", "Depletion HL", "Depletion, HL", "Volume HL", "HL")
DEPLETION_CRATES = (
    "Depletion",
    "Depletion Crates",
    "Invoiced Quantity",
    "Quantity",
    "Qty",
    "Crates",
    "Dep.",
    "Dep Crates",
)
PY_DEPLETION_CRATES = ("Sales",) + DEPLETION_CRATES
DIVISION = ("DV", "Division", "Region")
MDM_AGENT = (
    "Name(S4H_C4C)",
    "Agent",
    "Sales Unit",
    "Sold-to Name",
    "Customer Name",
    "Customer",
    "Agent Name",
)
MDM_REPORTING_NAME = (
    "Reporting Name",
    "Report Naming",
    "Agent Reporting Name",
    "Agent Report Naming",
    "Reporting_Name",
    "Reporting name",
    "Repoting Name",
    "Repoting name",
)
TARGET_BRAND = ("Brand", "Item Description", "Br")
TARGET_AGENT = ("Sales Unit", "Agent")
TARGET_CRATES = ("Target", "Target Crates", "Target, Crates")
CALENDAR_DATE = ("Date", "Calendar Date", "Day", "GC Date", "Gregorian Date")
CALENDAR_FLAG = (
    "Working Day",
    "Working_Day",
    "Working day",
    "Is Working Day",
    "IsWorkingDay",
    "Workday",
    "Working",
)
STOCK_DATE = ("Reporting Date", "Date", "Stock Date", "Month", "Posting Date")

# The roles of the volume facts. A row without any of them counts nowhere, so
# blank rows are told by these columns and the others are never read.
FACT_ROLES = {
    "actual_shipment": (EVENT_DATE, CUTOFF_DATE, SHIPMENT_AGENT, SHIPMENT_ITEM, SHIPMENT_CRATES),
    "py_shipment": (EVENT_DATE, SHIPMENT_AGENT, SHIPMENT_ITEM, SHIPMENT_CRATES),
    "ytd_depletion": (DEPLETION_DATE, DEPLETION_AGENT, DEPLETION_ITEM, DEPLETION_HL + DEPLETION_CRATES, DIVISION),
    "py_depletion": (DEPLETION_DATE, DEPLETION_AGENT, DEPLETION_ITEM, DEPLETION_HL + PY_DEPLETION_CRATES, DIVISION),
}
# Tables of which the first row of a key counts, in source order.
KEEP_FIRST_TABLES = ("agent_left", "brand_left", "calendar_mdm")


@dataclass(frozen=True)
class BrandRules:
    """How a brand text becomes a key, and how a key is shown.

    ``families`` are tried in order against the cleaned text; the first one
    contained in it becomes the key. Company-specific replacements, families
    and display names belong in the run configuration (``from_json``).
    """

    remove_words: tuple[str, ...] = BRAND_WORDS_REMOVED
    replacements: tuple[tuple[str, str], ...] = ()
    families: tuple[str, ...] = ()
    display_names: tuple[tuple[str, str], ...] = ()

    @staticmethod
    def from_dict(raw: dict) -> BrandRules:
        return BrandRules(
            remove_words=tuple(raw.get("remove_words", BRAND_WORDS_REMOVED)),
            replacements=tuple((a, b) for a, b in raw.get("replacements", ())),
            families=tuple(raw.get("families", ())),
            display_names=tuple(dict(raw.get("display_names", {})).items()),
        )


@dataclass(frozen=True)
class ReportConfig:
    hl_per_crate: float = HL_PER_CRATE
    default_target_year: int = 2026
    selected_target_type: str = "Sales Target"
    number_mode: str = "compat"
    # The report as it was on this day: later shipments and stock snapshots don't count.
    as_of: date | None = None
    brand_rules: BrandRules = field(default_factory=BrandRules)

    def __post_init__(self):
        if self.selected_target_type not in TARGET_TYPES:
            raise ValueError(f"selected_target_type must be one of {TARGET_TYPES}")
        if self.number_mode not in ("compat", "signed"):
            raise ValueError("number_mode must be 'compat' or 'signed'")

    def with_options(self, **changes) -> ReportConfig:
        return replace(self, **changes)

    @staticmethod
    def from_dict(raw: dict) -> ReportConfig:
        values = dict(raw)
        if "brand_rules" in values:
            values["brand_rules"] = BrandRules.from_dict(values["brand_rules"])
        if isinstance(values.get("as_of"), str):
            values["as_of"] = date.fromisoformat(values["as_of"])
        return ReportConfig(**values)

    @staticmethod
    def from_json(path: str) -> ReportConfig:
        with open(path, encoding="utf-8") as handle:
            return ReportConfig.from_dict(json.load(handle))
