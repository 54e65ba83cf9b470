"""Thirteen tiny hand-made tables, all cells text as in a sheet."""

from cratewise.config import REQUIRED_TABLES, BrandRules, ReportConfig

CONFIG = ReportConfig(default_target_year=2026, brand_rules=BrandRules())

# Last date 2026-03-18, a Wednesday; every day but Sunday is worked.
TABLES = {
    "aop_target": (
        ["Month", "Division", "Agent", "Item Description", "Target, HL"],
        [("202603", "North", "s4h alpha", "Lager Beer Crate 24x33", "7.92"), ("Apr", None, "Lone", "Stout", "0.792")],
    ),
    "sales_target": (
        ["Month", "Division", "Sales Unit", "Br", "Target"],
        [("3", "North", "S4H ALPHA", "Lager", "260"), ("2", "North", "S4H ALPHA", "Lager", "100"), ("3", None, "Lone", "Stout", "26")],
    ),
    "snop_target": (
        ["Month", "Division", "Agent", "Brand", "Target, Crates"],
        [("March", "North", "S4H ALPHA", "Lager", "1,300"), ("x", "North", "S4H ALPHA", "Lager", "-")],
    ),
    "agent_left": (
        ["Name(S4H_C4C)", "DV", "Repoting Name"],
        [
            ("S4H Alpha", "North", " Alpha "),
            ("Dep Alpha", "South", "Alpha"),
            ("s4h alpha", "East", "Other"),
            ("Beta", None, None),
            (None, "West", "Ghost"),
        ],
    ),
    "brand_left": (
        ["Item Description", "Report Naming"],
        [("Lager", "Lager Beer"), (" LAGER ", "Wrong"), ("Ale", None), ("Lager Beer Crate 24x33", "Lager Beer")],
    ),
    "calendar_mdm": (
        ["GC Date", "Workday"],
        [(f"{day:02d}/{month:02d}/2026", "No" if (day + shift) % 7 == 0 else "yes")
         for month, days, shift in ((2, 28, 6), (3, 31, 6)) for day in range(1, days + 1)],
    ),
    "hl_converter": (["x"], [("1",)]),
    "plant_code": (["x"], [("1",)]),
    "stock": (
        ["Reporting Date", "Agent", "Lager Crate 24x33", "Stout"],
        [("01/02/2026", "Dep Alpha", "999", "9"), ("01/03/2026", "Dep Alpha", "1,000", "-"), ("01/03/2026", "Lone", None, "5")],
    ),
    "actual_shipment": (
        ["Date", "Agent", "Item Description", "Invoiced Quantity"],
        [
            ("17/03/2026", "S4H Alpha", "Lager", "10"),
            ("16/03/2026", "s4h  alpha", "Lager", "3"),
            ("02/03/2026", "S4H ALPHA", "Lager Beer Crate 24x33", "20"),
            ("05/01/2026", "S4H Alpha", "Ale", "-7"),
            ("18/03/2026", "S4H Alpha", "Lager", "0"),
            ("10/03/2026", None, "Lager", "4"),
            ("10/03/2026", "Beta", None, "2"),
            ("bad date", "S4H Alpha", "Lager", "1000"),
            ("11/03/2026", "S4H Alpha", "Lager", "n/a"),
        ],
    ),
    "py_shipment": (
        ["Billing Date", "Sales Unit", "Product", "Qty"],
        [("17/03/2025", "S4H Alpha", "Lager", "5"), ("19/03/2025", "S4H Alpha", "Lager", "500"), ("01/01/2025", "Py Only", "Lager", "6")],
    ),
    "ytd_depletion": (
        ["Date", "Sales Unit", "Brand H+HK", "Region", "Dep HL"],
        [("15/03/2026", "dep alpha", "Lager", "South", "0.792"), ("01/01/2026", "New Agent", "Lager H+HK", "Coast", "1.584")],
    ),
    "py_depletion": (
        ["Date", "Agent", "Brand", "Sales"],
        [("17/03/2025", "Dep Alpha", "Lager", "8"), ("16/03/2025", "Py Dep Only", "Lager", "9")],
    ),
}
assert set(TABLES) == set(REQUIRED_TABLES)


def mini_tables(spark, **changes):
    """The tables as frames; a keyword replaces one table's (headers, rows)."""
    frames = {}
    for name, (headers, rows) in {**TABLES, **changes}.items():
        schema = ", ".join(f"`{header}` string" for header in headers)
        frames[name] = spark.createDataFrame(rows, schema).coalesce(1)
    return frames
