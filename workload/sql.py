"""The same queries as SQL for a second engine, written step by step: names
are conformed row by row, every measure is its own aggregate, and the wide
table is a chain of left joins."""

from __future__ import annotations

from collections.abc import Mapping

from cratewise.config import BRAND_WORDS_REMOVED
from cratewise.functions.text import WHITESPACE
from cratewise.operators.kpi import TARGETS, UNITLESS, WIDE_MEASURES, report_name
from cratewise.operators.metrics import MEASURES
from cratewise.operators.targets import TARGET_WINDOWS, TYPE_SUFFIX
from cratewise.plans.checks import PERIOD_MEASURES, TOTAL_MEASURES
from cratewise.sources.extract import EXTRACT_COLUMNS, PERIODS
from workload.queries import FAMILY_RULES, is_ratio

HL = "CAST(0.0792 AS DOUBLE)"
# The newest year in which something was shipped or ordered.
YEAR = "(SELECT y FROM span)"


# -- expressions ------------------------------------------------------------


def strip(x: str) -> str:
    return f"trim({x}, '{WHITESPACE}')"


def upper(x: str) -> str:
    return f"replace(upper({x}), 'ẞ', 'SS')"


def clean(x: str) -> str:
    return f"replace(replace(replace({upper(strip(x))}, chr(10), ' '), chr(13), ' '), '  ', ' ')"


def title(x: str) -> str:
    runs = rf"regexp_extract_all({x}, '([\p{{Lu}}\p{{Ll}}\p{{Lt}}]+|[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+)', 1)"
    return f"array_to_string(list_transform({runs}, lambda r: replace(upper(r[1]), 'ẞ', 'Ss') || lower(r[2:])), '')"


def proper(x: str) -> str:
    flat = strip(f"translate({x}, chr(10) || chr(13) || chr(9) || '-', '    ')")
    one = f"regexp_replace({flat}, ' {{2,}}', ' ', 'g')"
    return f"CASE WHEN {one} <> '' AND {upper(one)} NOT IN ('NAN', 'NONE') THEN {title(one)} END"


def brand_key(x: str) -> str:
    out = strip(upper(x))
    for word in BRAND_WORDS_REMOVED:
        out = f"replace({out}, '{word}', '')"
    return strip(f"replace({out}, '  ', ' ')")


def same(left: str, right: str, *columns: str) -> str:
    return " AND ".join(f"{left}.{c} IS NOT DISTINCT FROM {right}.{c}" for c in columns)


def divide(n: str, d: str) -> str:
    return f"(CASE WHEN {d} = 0 THEN 0.0 ELSE {n} / {d} END)"


def quoted(name: str) -> str:
    return f'"{name}"'


def num(expression: str, alias: str) -> str:
    scale = "1e8" if is_ratio(alias) else "1e4"
    steady = f"round_even(CAST({expression} AS DOUBLE) * {scale}::DOUBLE * 1e4::DOUBLE, 0) / 1e4::DOUBLE"
    return f"round_even({steady}, 0) / {scale}::DOUBLE + 0.0 AS {quoted(alias)}"


def total(expression: str) -> str:
    return f"coalesce(sum({expression}), 0.0)"


# -- shared steps -----------------------------------------------------------

STEPS: dict[str, str] = {}
STEPS["span"] = """
SELECT greatest((SELECT max(year(l_shipdate)) FROM lineitem), (SELECT max(year(o_orderdate)) FROM orders)) AS y"""
STEPS["agents"] = """
SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 10 <> 4 THEN r_name END AS division
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
STEPS["lines"] = """
SELECT l_orderkey, CAST(l_shipdate AS DATE) AS ship_day, s_name, p_brand, l_quantity, l_shipdate
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey"""
STEPS["dim_agent"] = f"""
SELECT agent_source_key, {clean('agent')} AS agent_key, agent, division
FROM (SELECT s_suppkey, {clean('s_name')} AS agent_source_key,
             'agent-' || CAST(s_suppkey // 2 AS VARCHAR) AS agent, division
      FROM agents WHERE s_suppkey % 10 <> 9)
QUALIFY row_number() OVER (PARTITION BY agent_source_key ORDER BY s_suppkey) = 1"""
STEPS["dim_brand"] = f"""
SELECT DISTINCT {clean('p_brand')} AS brand_key,
       p_brand || CASE WHEN CAST(split_part(p_brand, '#', 2) AS INTEGER) % 2 = 0 THEN ' Beer' ELSE '' END
         AS reporting_name
FROM part WHERE p_brand <> 'Brand#25'"""
STEPS["calendar"] = f"""
SELECT d AS date, CAST(date_trunc('month', d) AS DATE) AS month_start, dayofweek(d) <> 0 AS working
FROM (SELECT DISTINCT TRY_CAST(CAST({YEAR} AS VARCHAR) || strftime(o_orderdate, '-%m-%d') AS DATE) AS d FROM orders) WHERE d IS NOT NULL"""
STEPS["actual_all"] = f"""
SELECT ship_day AS date, s_name AS source, p_brand AS item, l_quantity AS crates
FROM lines WHERE year(l_shipdate) = {YEAR}"""
STEPS["py_all"] = f"""
SELECT ship_day AS date, s_name AS source, p_brand AS item, l_quantity AS crates
FROM lines WHERE year(l_shipdate) = {YEAR} - 1"""
STEPS["dep_all"] = f"""
SELECT CAST(o_orderdate AS DATE) AS date, upper(s_name) AS source, p_brand AS item, l_quantity AS crates
FROM lines JOIN orders ON l_orderkey = o_orderkey
WHERE year(o_orderdate) = {YEAR}"""
STEPS["py_dep_all"] = f"""
SELECT CAST(o_orderdate AS DATE) AS date, upper(s_name) AS source, p_brand AS item, l_quantity AS crates
FROM lines JOIN orders ON l_orderkey = o_orderkey
WHERE year(o_orderdate) = {YEAR} - 1"""
STEPS["anchor"] = """
SELECT max(date) AS last_date, coalesce(max(date) FILTER (WHERE crates > 0), max(date)) AS report_day FROM actual_all"""
STEPS["bounds"] = """
SELECT last_date, CAST(date_trunc('month', last_date) AS DATE) AS month_start, last_day(last_date) AS month_end,
       make_date(year(last_date), 1, 1) AS year_start, make_date(year(last_date), 12, 31) AS year_end,
       CAST(last_date - INTERVAL 1 YEAR AS DATE) AS py_cutoff,
       CAST(date_trunc('month', last_date - INTERVAL 1 YEAR) AS DATE) AS py_month_start,
       make_date(year(last_date) - 1, 1, 1) AS py_year_start,
       report_day, CAST(date_trunc('week', report_day) AS DATE) AS week_start,
       CAST(report_day - INTERVAL 1 YEAR AS DATE) AS py_day,
       CAST(date_trunc('week', report_day) - INTERVAL 1 YEAR AS DATE) AS py_week_start
FROM anchor"""
STEPS["dates"] = """
SELECT b.*,
  greatest(date_diff('day', b.month_start, last_date) + 1, 1) AS elapsed_cal_days,
  greatest((SELECT count(*) FROM calendar WHERE working AND date BETWEEN b.month_start AND last_date), 1) AS elapsed_wd,
  (SELECT count(*) FROM calendar WHERE working AND date > last_date AND date <= month_end) AS remaining_wd,
  greatest((SELECT count(*) FROM calendar WHERE working AND date BETWEEN year_start AND last_date), 1)
    AS elapsed_year_wd,
  (SELECT count(*) FROM calendar WHERE working AND date > last_date AND date <= year_end) AS remaining_year_wd
FROM bounds b"""
SHIPPED = f"""
SELECT f.date, f.source, coalesce(a.agent, f.source) AS agent, {clean('coalesce(a.agent, f.source)')} AS agent_key,
       a.division, f.item, {clean('f.item')} AS brand_key, b.brand_key IS NOT NULL AS brand_known,
       {brand_key('coalesce(b.reporting_name, f.item)')} AS brand_kpi_key, f.crates
FROM {{table}} f LEFT JOIN dim_agent a ON {clean('f.source')} = a.agent_source_key
LEFT JOIN dim_brand b ON {clean('f.item')} = b.brand_key, dates
WHERE f.date <= {{until}}"""
STEPS["actual"] = SHIPPED.format(table="actual_all", until="last_date")
STEPS["py"] = SHIPPED.format(table="py_all", until="py_cutoff")
DEPLETED = f"""
SELECT f.date, coalesce(a.agent, f.source) AS agent, {clean('coalesce(a.agent, f.source)')} AS agent_key,
       a.division, {brand_key('f.item')} AS brand_kpi_key, f.crates
FROM {{table}} f LEFT JOIN dim_agent a ON {clean('f.source')} = a.agent_source_key"""
STEPS["dep"] = DEPLETED.format(table="dep_all")
STEPS["py_dep"] = DEPLETED.format(table="py_dep_all")
STEPS["progress"] = """
SELECT month_start, month_working_days, elapsed_working_days,
       CASE WHEN month_start < current_month THEN 1.0
            WHEN month_start = current_month
              THEN CASE WHEN month_working_days = 0 THEN 0.0 ELSE elapsed_working_days / month_working_days END
            ELSE 0.0 END AS ratio
FROM (SELECT c.month_start, any_value(d.month_start) AS current_month, count(*) FILTER (WHERE working) AS month_working_days,
             count(*) FILTER (WHERE working AND date <= last_date) AS elapsed_working_days
      FROM calendar c, dates d GROUP BY c.month_start)"""
STEPS["plan"] = f"""
SELECT a.s_name, a.division, p_brand, month(l_shipdate) AS month, sum(l_quantity) AS crates
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN agents a ON l_suppkey = a.s_suppkey
WHERE year(l_shipdate) = {YEAR} - 1
GROUP BY ALL"""
STEPS["target_rows"] = f"""
SELECT 'AOP' AS target_type, CAST({YEAR} * 100 + month AS VARCHAR) AS month_raw, s_name AS agent, division AS dv,
       p_brand AS item, 'HL' AS source_uom, crates * 1.2::DOUBLE * {HL} AS target_hl,
       crates * 1.2::DOUBLE * {HL} / {HL} AS target_crates, make_date({YEAR}, month, 1) AS month_start FROM plan
UNION ALL
SELECT 'Sales Target', CAST(month AS VARCHAR), s_name, division, p_brand, 'Crates', crates * 1.1::DOUBLE * {HL},
       crates * 1.1::DOUBLE, make_date({YEAR}, month, 1) FROM plan
UNION ALL
SELECT 'SNOP', strftime(make_date({YEAR}, month, 1), '%B'), s_name, division, p_brand, 'Crates',
       crates * 1.05::DOUBLE * {HL}, crates * 1.05::DOUBLE, make_date({YEAR}, month, 1) FROM plan"""
STEPS["targets"] = f"""
SELECT t.*, {clean('item')} AS brand_key, coalesce(b.reporting_name, item) AS reporting_name,
       CASE WHEN b.brand_key IS NULL THEN 'Not Matched' ELSE 'Matched' END AS brand_match,
       p.month_working_days, p.elapsed_working_days, coalesce(p.ratio, 0.0) AS ratio,
       target_hl * coalesce(p.ratio, 0.0) AS target_hl_to_date,
       target_crates * coalesce(p.ratio, 0.0) AS target_crates_to_date
FROM target_rows t LEFT JOIN dim_brand b ON {clean('item')} = b.brand_key
LEFT JOIN progress p ON t.month_start = p.month_start"""
STEPS["target_ab"] = f"""
SELECT t.* EXCLUDE (agent), coalesce(a.agent, t.agent) AS agent, {clean('coalesce(a.agent, t.agent)')} AS agent_key,
       coalesce(a.division, t.dv) AS division, {brand_key('reporting_name')} AS brand_kpi_key,
       (SELECT count(*) FROM calendar c, dates d WHERE working AND c.month_start = t.month_start AND date = report_day)
         AS last_day_days,
       (SELECT count(*) FROM calendar c, dates d
        WHERE working AND c.month_start = t.month_start AND date BETWEEN week_start AND report_day) AS wtd_days
FROM targets t LEFT JOIN dim_agent a ON {clean('t.agent')} = a.agent_source_key"""
BY_KEY = "agent_key, brand_kpi_key"
BY_NAME = "division, agent_key, agent, brand_kpi_key"
FULL_KEY = "division IS NOT NULL AND agent_key IS NOT NULL AND agent IS NOT NULL AND brand_kpi_key IS NOT NULL"
TARGET_VALUES = {
    "last_day": "target_crates / month_working_days * last_day_days",
    "wtd": "target_crates / month_working_days * wtd_days",
    "mtd": "target_crates_to_date",
    "ytd": "target_crates_to_date",
    "full_month": "target_crates",
    "full_year": "target_crates",
}


def target_sum(window: str, kind: str) -> str:
    current = " AND month_start = current_month" if window in ("mtd", "full_month") else ""
    return (
        f"coalesce(sum({TARGET_VALUES[window]}) FILTER (WHERE target_type = '{kind}'{current}), 0.0) "
        f"AS {window}_target_{TYPE_SUFFIX[kind]}"
    )


def target_sums(windows: tuple[str, ...], keys: str) -> str:
    sums = ", ".join(target_sum(w, t) for w in windows for t in TYPE_SUFFIX)
    return (
        f"SELECT {keys}, {sums} FROM (SELECT t.*, d.month_start AS current_month FROM target_ab t, dates d) "
        f"WHERE {FULL_KEY} GROUP BY {keys}"
    )


STEPS["m_target"] = target_sums(TARGET_WINDOWS, BY_KEY)
STEPS["stock_sums"] = f"""
SELECT s_name, p_brand, sum(l_quantity) % 50 AS quantity
FROM lines WHERE year(l_shipdate) = {YEAR} GROUP BY s_name, p_brand"""
STEPS["stock_rows"] = """
SELECT s_name AS source, p_brand || ' Crate 24x33' AS brand_raw, p_brand, quantity FROM stock_sums WHERE quantity <> 0"""
STEPS["stock_ab"] = f"""
SELECT division, agent_key, agent, brand_kpi_key, sum(quantity) AS beginning_stock
FROM (SELECT a.division, coalesce(a.agent, source) AS agent, {clean('coalesce(a.agent, source)')} AS agent_key,
             {brand_key('p_brand')} AS brand_kpi_key, quantity
      FROM stock_rows LEFT JOIN dim_agent a ON {clean('source')} = a.agent_source_key)
GROUP BY ALL"""
WINDOWS = {
    "last_day_shipment": ("actual", "report_day", "report_day"),
    "wtd_shipment": ("actual", "week_start", "report_day"),
    "mtd_shipment": ("actual", "month_start", "last_date"),
    "ytd_shipment": ("actual", "year_start", "last_date"),
    "last_day_py_shipment": ("py", "py_day", "py_day"),
    "wtd_py_shipment": ("py", "py_week_start", "py_day"),
    "mtd_py_shipment": ("py", "py_month_start", "py_cutoff"),
    "ytd_py_shipment": ("py", "py_year_start", "py_cutoff"),
    "last_day_depletion": ("dep", "report_day", "report_day"),
    "wtd_depletion": ("dep", "week_start", "report_day"),
    "mtd_depletion": ("dep", "month_start", "last_date"),
    "ytd_depletion": ("dep", "year_start", "last_date"),
    "last_day_py_depletion": ("py_dep", "py_day", "py_day"),
    "wtd_py_depletion": ("py_dep", "py_week_start", "py_day"),
    "mtd_py_depletion": ("py_dep", "py_month_start", "py_day"),
    "ytd_py_depletion": ("py_dep", "py_year_start", "py_day"),
}
for _name, (_table, _start, _end) in WINDOWS.items():
    STEPS[f"m_{_name}"] = (
        f"SELECT {BY_KEY}, sum(crates) AS {_name} FROM {_table} f, dates d "
        f"WHERE f.date BETWEEN d.{_start} AND d.{_end} GROUP BY {BY_KEY}"
    )
STEPS["m_stock"] = f"SELECT {BY_KEY}, sum(beginning_stock) AS beginning_stock FROM stock_ab GROUP BY {BY_KEY}"


def spine_part(rank: int, table: str, condition: str = "true") -> str:
    return f"SELECT {rank} AS rank, {BY_NAME} FROM {table} f, dates d WHERE {condition}"


STEPS["spine_rows"] = " UNION ALL ".join(
    [
        spine_part(0, "actual", "f.date BETWEEN d.month_start AND last_date"),
        spine_part(1, "actual", "f.date BETWEEN year_start AND last_date"),
        spine_part(2, "py", "f.date BETWEEN py_month_start AND py_cutoff"),
        spine_part(3, "py", "f.date BETWEEN py_year_start AND py_cutoff"),
        spine_part(4, "target_ab", "f.month_start = d.month_start"),
        spine_part(5, "target_ab"),
        spine_part(6, "stock_ab"),
        spine_part(7, "dep", "f.date BETWEEN d.month_start AND last_date"),
        spine_part(8, "dep", "f.date BETWEEN year_start AND last_date"),
    ]
)
STEPS["spine"] = f"""
SELECT {BY_KEY},
  first(division ORDER BY rank, division) FILTER (WHERE division IS NOT NULL) AS division,
  first(agent ORDER BY rank, division NULLS LAST, agent) FILTER (WHERE agent IS NOT NULL) AS agent,
  {title('brand_kpi_key')} AS brand
FROM spine_rows GROUP BY {BY_KEY}"""
_joined = ["m_stock", *[f"m_{m}" for m in WINDOWS], "m_target"]
STEPS["metrics"] = (
    f"SELECT s.*, {', '.join(f'coalesce({m}, 0.0) AS {m}' for m in MEASURES)} FROM spine s "
    + " ".join(f"LEFT JOIN {m} ON {same('s', m, 'agent_key', 'brand_kpi_key')}" for m in _joined)
)
_ratios = []
for _p in ("mtd", "ytd"):
    _ratios.append(f"{_p}_shipment - {_p}_py_shipment AS {_p}_variance_vs_py")
    _ratios.append(f"{divide(f'{_p}_shipment', f'{_p}_py_shipment')} AS {_p}_achievement_vs_py_pct")
    for _t in TARGETS:
        _ratios.append(f"{divide(f'{_p}_shipment', f'{_p}_target_{_t}')} AS {_p}_achievement_vs_{_t}_pct")
for _t in TARGETS:
    _ratios.append(f"{divide('mtd_landing', f'full_month_target_{_t}')} AS mtd_landing_vs_{_t}_pct")
    _ratios.append(f"{divide('yearly_landing', f'full_year_target_{_t}')} AS yearly_landing_vs_{_t}_pct")
STEPS["wide"] = f"""
SELECT *, {divide('stock_balance', 'avg_daily_depletion')} AS days_of_stock, {', '.join(_ratios)}
FROM (SELECT *, mtd_shipment + avg_daily_mtd_shipment * remaining_wd AS mtd_landing,
             ytd_shipment + avg_daily_ytd_shipment * remaining_year_wd AS yearly_landing
      FROM (SELECT m.*, d.remaining_wd, d.remaining_year_wd,
                   greatest(beginning_stock + mtd_shipment - mtd_depletion, 0.0) AS stock_balance,
                   mtd_depletion / d.elapsed_cal_days AS avg_daily_depletion,
                   mtd_shipment / d.elapsed_wd AS avg_daily_mtd_shipment,
                   ytd_shipment / d.elapsed_year_wd AS avg_daily_ytd_shipment
            FROM metrics m, dates d))"""
_scaled = ", ".join(m if m in UNITLESS else f"{m} * factor AS {m}" for m in WIDE_MEASURES)
STEPS["uom"] = f"""
SELECT division, agent, brand, uom, {_scaled}
FROM wide, (VALUES ('Crates', 1.0::DOUBLE), ('HL', {HL})) u(uom, factor)"""

_extract_volumes = []
for _p, _name in zip(("last_day", "wtd", "mtd", "ytd"), PERIODS, strict=True):
    _v = _name.replace(" ", "_")
    _extract_volumes += [
        (f"{_v}_Sales", f"{_p}_shipment"),
        (f"{_v}_Target", f"CASE kind WHEN 'Sales' THEN {_p}_target_sales WHEN 'SNOP' THEN {_p}_target_snop "
                         f"ELSE {_p}_target_aop END"),
        (f"{_v}_PY", f"{_p}_py_shipment"),
        (f"{_v}_Depletion", f"{_p}_depletion"),
        (f"{_v}_Depletion_PY", f"{_p}_py_depletion"),
    ]
_extract_volumes += [
    ("Carried_Stock", "beginning_stock"),
    ("Avg_Daily_Depletion", "avg_daily_depletion"),
]
STEPS["by_type"] = f"""
SELECT division, agent, brand, uom, kind, {', '.join(f'sum({e}) AS {quoted(n)}' for n, e in _extract_volumes)}
FROM uom, (VALUES ('Sales'), ('SNOP'), ('AOP')) k(kind) GROUP BY division, agent, brand, uom, kind"""
STEPS["normalized"] = f"""
SELECT {proper('division')} AS division, {proper('agent')} AS agent, {proper('brand')} AS brand, uom, kind,
       {', '.join(f'sum({quoted(n)}) AS {quoted(n)}' for n, _ in _extract_volumes)}
FROM by_type GROUP BY 1, 2, 3, 4, 5"""
STEPS["stock_exact"] = f"""
SELECT {proper('division')} AS division, {proper('agent')} AS agent, {proper(title('brand_kpi_key'))} AS brand, uom,
       sum(beginning_stock * factor) AS exact
FROM stock_ab, (VALUES ('Crates', 1.0::DOUBLE), ('HL', {HL})) u(uom, factor) GROUP BY 1, 2, 3, 4"""
_growth = []
for _name in PERIODS:
    _v = _name.replace(" ", "_")
    _vs = "YTD VS PY Ach" if _name == "YTD" else f"{_name} Sales vs PY"
    for _alias, _n, _d in (
        (f"{_name} Ach", "Sales", "Target"),
        (_vs, "Sales", "PY"),
        (f"{_name} Depletion Ach", "Depletion", "Target"),
        (f"{_name} Depletion vs PY", "Depletion", "Depletion_PY"),
    ):
        _growth.append(f"{divide(quoted(f'{_v}_{_n}'), quoted(f'{_v}_{_d}'))} - 1 AS {quoted(_alias)}")
STEPS["extract"] = f"""
SELECT *, CASE WHEN "Days of Stock" > 10 THEN 'Over-stocked' WHEN "Days of Stock" BETWEEN 6 AND 10 THEN 'Optimal'
               WHEN "Days of Stock" < 6 THEN 'Low Stock' ELSE 'No Depletion' END AS "Stock Level Flag"
FROM (SELECT *, {divide('"Stock_per_Agent"', '"Avg_Daily_Depletion"')} AS "Days of Stock", {', '.join(_growth)}
      FROM (SELECT n.* EXCLUDE (division, agent, brand, uom, kind), n.division AS "Division", n.agent AS "Agent",
                   n.brand AS "Brand", n.uom AS "UOM", kind AS "Target Type",
                   coalesce(exact, 0.0) AS "Beginning_Stock",
                   greatest(coalesce(exact, 0.0) + "MTD_Sales" - "MTD_Depletion", 0.0) AS "Stock_per_Agent"
            FROM normalized n LEFT JOIN stock_exact s ON {same('n', 's', 'division', 'agent', 'brand', 'uom')}))"""


def mentions(body: str) -> set[str]:
    words = set("".join(c if c.isalnum() or c == "_" else " " for c in body).split())
    return words & set(STEPS)


def with_steps(select: str, changed: Mapping[str, str] | None = None) -> str:
    """The select with every step it needs; a step only uses earlier ones. ``changed`` replaces steps."""
    needed, steps = mentions(select), {**STEPS, **(changed or {})}
    for name in reversed(steps):
        if name in needed:
            earlier = list(steps)[: list(steps).index(name)]
            needed |= mentions(steps[name]) & set(earlier)
    heads = ",\n".join(f"{name} AS MATERIALIZED ({steps[name].strip()})" for name in steps if name in needed)
    return f"WITH {heads}\n{select}" if needed else select


def name_sums(*measures: str) -> str:
    table = WINDOWS[measures[0]][0]
    inside = " OR ".join(f"f.date BETWEEN d.{WINDOWS[m][1]} AND d.{WINDOWS[m][2]}" for m in measures)
    sums = ", ".join(
        f"coalesce(sum(crates) FILTER (WHERE f.date BETWEEN d.{WINDOWS[m][1]} AND d.{WINDOWS[m][2]}), 0.0) AS {m}"
        for m in measures
    )
    return f"SELECT {BY_NAME}, {sums} FROM {table} f, dates d WHERE {inside} GROUP BY {BY_NAME}"


def wide_columns(*columns: str) -> str:
    return ", ".join(num(c, c) for c in columns)


def extract_columns(names: list[str]) -> str:
    text = ("Division", "Agent", "Brand", "UOM", "Target Type", "Stock Level Flag")
    return ", ".join(quoted(n) if n in text else num(quoted(n), n) for n in names)


AMOUNT_TEXT = """CASE o_orderkey % 8
  WHEN 0 THEN p WHEN 1 THEN '-' || p WHEN 2 THEN '(' || p || ')' WHEN 3 THEN CAST(o_orderkey AS VARCHAR) || '-3'
  WHEN 4 THEN '  ' || p || chr(9) WHEN 5 THEN '-' WHEN 6 THEN CAST(o_custkey AS VARCHAR) || 'd'
  ELSE CAST(o_custkey AS VARCHAR) || 'e+2' END"""
AMOUNTS = f"(SELECT o_orderkey, {AMOUNT_TEXT} AS t FROM (SELECT *, format('{{:,.2f}}', o_totalprice) AS p FROM orders))"
FAMILY_KEY = "CASE " + " ".join(f"WHEN contains(k, '{f}') THEN '{f}'" for f in FAMILY_RULES.families) + " ELSE k END"
FAMILY_TEXT = strip(upper("p_name || ' Beer  Crate 24x33 ' || p_type"))
for _word in BRAND_WORDS_REMOVED:
    FAMILY_TEXT = f"replace({FAMILY_TEXT}, '{_word}', '')"
for _old, _new in FAMILY_RULES.replacements:
    FAMILY_TEXT = f"replace({FAMILY_TEXT}, '{_old}', '{_new}')"
FAMILY_TEXT = strip(f"replace({FAMILY_TEXT}, '  ', ' ')")
FAMILY_SHOWN = "CASE key " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FAMILY_RULES.display_names)
MONTH_STYLES = """CASE o_orderkey % 10
  WHEN 0 THEN CAST(month(o_orderdate) AS VARCHAR) WHEN 1 THEN strftime(o_orderdate, '%b')
  WHEN 2 THEN lower(strftime(o_orderdate, '%B')) WHEN 3 THEN strftime(o_orderdate, '%Y%m')
  WHEN 4 THEN CAST(date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) AS VARCHAR)
  WHEN 5 THEN strftime(o_orderdate, '%B %Y') WHEN 6 THEN strftime(o_orderdate, '%d/%m/%Y')
  WHEN 7 THEN strftime(o_orderdate, '%-d-%b') WHEN 8 THEN strftime(o_orderdate, '%Y')
  ELSE CAST(month(o_orderdate) + 12 AS VARCHAR) || 'x' END"""
MONTH_MEANT = f"""CASE o_orderkey % 10
  WHEN 0 THEN make_date({YEAR}, month(o_orderdate), 1) WHEN 1 THEN make_date({YEAR}, month(o_orderdate), 1)
  WHEN 2 THEN make_date({YEAR}, month(o_orderdate), 1) WHEN 7 THEN make_date({YEAR}, month(o_orderdate), 1)
  WHEN 8 THEN make_date(year(o_orderdate), 1, 1) WHEN 9 THEN NULL
  ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END"""
FLAG_TEXT = """CASE l_orderkey % 9 WHEN 0 THEN 'Yes' WHEN 1 THEN ' y' WHEN 2 THEN 'TRUE' WHEN 3 THEN '1'
  WHEN 4 THEN '1.0' WHEN 5 THEN 'No' WHEN 6 THEN 'working day ' WHEN 7 THEN 'Working' END"""
DISPLAYED = """format('{:,.2f}', "YTD_Sales") AS "YTD_Sales", format('{:,.0f}', "MTD_Sales") AS "MTD_Sales",
  format('{:,.3f}', "Avg_Daily_Depletion") AS "Avg_Daily_Depletion",
  format('{:+.1f}', "YTD VS PY Ach" * 100) || '%' AS "YTD VS PY Ach",
  format('{:.1f}', "MTD Sales vs PY" * 100) || '%' AS "MTD Sales vs PY\""""
REGION = """
SELECT t.*, coalesce(a.crates, 0.0) AS actual, coalesce(p.crates, 0.0) AS prior
FROM (SELECT dv, sum(target_crates_to_date) AS target_crates_to_date, sum(target_hl_to_date) AS target_hl_to_date,
             sum(target_crates) AS full_target_crates FROM targets WHERE target_type = 'Sales Target' GROUP BY dv) t
LEFT JOIN (SELECT division, sum(crates) AS crates FROM actual GROUP BY division) a
  ON t.dv IS NOT DISTINCT FROM a.division
LEFT JOIN (SELECT division, sum(crates) AS crates FROM py GROUP BY division) p ON t.dv IS NOT DISTINCT FROM p.division"""
TOTAL_COLUMNS = (
    "MTD_Sales", "MTD_Target", "MTD_Depletion", "YTD_Sales", "YTD_Target", "YTD_Depletion", "MTD_PY", "YTD_PY",
    "Beginning_Stock", "Stock_per_Agent", "Avg_Daily_Depletion",
)
PERIOD_COLUMNS = (
    "Last_Day_Sales", "Last_Day_Target", "Last_Day_Depletion", "WTD_Sales", "WTD_Target", "WTD_Depletion",
    "MTD_Sales", "YTD_Sales",
)


def summed(columns) -> str:
    return ", ".join(num(f'sum("{c}")', c) for c in columns)


def lines_of(pairs: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS metric, {num(value, 'value')}" for name, value in pairs)


def one(select: str) -> str:
    return f"(SELECT {select})"


ACTUAL_SUM, PY_SUM = "(SELECT sum(crates) FROM actual)", "(SELECT sum(crates) FROM py)"
TARGET_SUM = "(SELECT sum(target_crates_to_date) FROM targets WHERE target_type = 'Sales Target')"
MTD_SUM = "(SELECT sum(crates) FROM actual f, dates d WHERE f.date BETWEEN d.month_start AND d.last_date)"
WIDE_YTD, WIDE_MTD = "(SELECT sum(ytd_shipment) FROM metrics)", "(SELECT sum(mtd_shipment) FROM metrics)"


def period_line(measure: str) -> str:
    table, start, end = WINDOWS[measure]
    source = f"coalesce((SELECT sum(crates) FROM {table} f, dates d WHERE f.date BETWEEN d.{start} AND d.{end}), 0.0)"
    merged = f"(SELECT sum({measure}) FROM metrics)"
    return (
        f"SELECT '{measure}' AS metric, {num(source, 'source_crates')}, {num(merged, 'merged_crates')}, "
        f"{num(f'{source} * {HL}', 'source_hl')}, {num(f'{merged} * {HL}', 'merged_hl')}, "
        f"{num(f'{merged} - {source}', 'difference')}"
    )


def unmatched(table: str, label: str) -> str:
    return (
        f"SELECT DISTINCT '{label}' AS source, source AS agent_source_name, agent, agent_key "
        f"FROM {table} WHERE division IS NULL"
    )


BODIES: dict[str, str] = {
    "shipment_mtd_ytd": name_sums("mtd_shipment", "ytd_shipment"),
    "shipment_py_mtd_ytd": name_sums("mtd_py_shipment", "ytd_py_shipment"),
    "depletion_mtd_ytd": name_sums("mtd_depletion", "ytd_depletion"),
    "depletion_py_windows": name_sums(*[m for m in WINDOWS if m.endswith("py_depletion")]),
    "last_day_wtd_shipment": name_sums("last_day_shipment", "wtd_shipment"),
    "last_day_wtd_depletion": name_sums("last_day_depletion", "wtd_depletion"),
    "agent_mdm": "SELECT agent_source_key, agent_key, agent, division FROM dim_agent",
    "brand_mdm": f"SELECT brand_key, reporting_name, {brand_key('reporting_name')} AS brand_kpi_key FROM dim_brand",
    "agent_conform": """SELECT source AS agent_source_name, agent, agent_key, division,
        CASE WHEN division IS NULL THEN 'Not Matched' ELSE 'Matched' END AS agent_match,
        CASE WHEN brand_known THEN 'Matched' ELSE 'Not Matched' END AS brand_match,
        count(*) AS row_count, sum(crates) AS crates FROM actual GROUP BY ALL""",
    "clean_text_keys": f"""SELECT doc_id, md5(k) AS key_hash, CAST(length(k) AS BIGINT) AS key_length
        FROM (SELECT doc_id, {clean("' ' || chr(9) || text || '   ' || chr(10)")} AS k FROM documents)""",
    "proper_text_names": f"""SELECT doc_id, md5(k) AS text_hash, CAST(length(k) AS BIGINT) AS text_length
        FROM (SELECT doc_id, {proper('text')} AS k FROM documents)""",
    "brand_kpi_keys": f"""SELECT p_partkey, key AS brand_kpi_key, {FAMILY_SHOWN} ELSE {title('key')} END AS brand, plain_key
        FROM (SELECT p_partkey, {FAMILY_KEY} AS key, plain_key
              FROM (SELECT p_partkey, {FAMILY_TEXT} AS k, {brand_key('p_brand')} AS plain_key FROM part))""",
    "to_number_compat": f"""SELECT o_orderkey,
        {num("TRY_CAST(CASE WHEN NOT contains(t, '(') AND NOT contains(t, 'd') THEN "
             "trim(replace(replace(t, ',', ''), '-', '0'), ' ' || chr(9)) END AS DOUBLE)", 'amount')} FROM {AMOUNTS}""",
    "to_number_signed": f"""SELECT o_orderkey,
        {num("CASE WHEN t = '-' THEN 0.0 ELSE TRY_CAST(CASE WHEN NOT contains(t, '(') AND NOT contains(t, 'd') "
             "THEN trim(replace(t, ',', ''), ' ' || chr(9)) END AS DOUBLE) END", 'amount')} FROM {AMOUNTS}""",
    "unit_and_type_labels": """SELECT CASE o_orderkey % 3 WHEN 0 THEN 'HL' WHEN 1 THEN 'Crates' ELSE trim(o_orderpriority)
          END AS uom, CASE o_orderkey % 4 WHEN 0 THEN 'Sales' WHEN 1 THEN 'SNOP' WHEN 2 THEN 'AOP'
          ELSE trim(o_orderstatus) END AS target_type, count(*) AS row_count FROM orders GROUP BY ALL""",
    "dayfirst_parse": """SELECT o_orderkey, CASE WHEN o_orderkey % 8 < 7 THEN CAST(o_orderdate AS DATE) END AS order_day
        FROM orders""",
    "target_month_parse": f"""SELECT {MONTH_STYLES} AS month_raw, {MONTH_MEANT} AS month_start, count(*) AS row_count
        FROM orders GROUP BY ALL""",
    "py_day_map": f"""SELECT order_day, row_count, mapped_day, coalesce(working, false) AS is_working_day
        FROM (SELECT order_day, row_count,
                     CASE WHEN strftime(order_day, '%m-%d') <> '02-29'
                          THEN make_date({YEAR}, month(order_day), day(order_day)) END AS mapped_day
              FROM (SELECT CAST(o_orderdate AS DATE) AS order_day, count(*) AS row_count FROM orders GROUP BY 1))
        LEFT JOIN calendar ON mapped_day = date""",
    "working_day_flag": f"""SELECT flag, coalesce(upper(trim(flag)) IN
          ('YES', 'Y', 'TRUE', '1', 'WORKING DAY', 'WORKING'), false) AS is_working_day, count(*) AS row_count
        FROM (SELECT {FLAG_TEXT} AS flag FROM lineitem) GROUP BY ALL""",
    "month_progress": f"""SELECT month_start, month_working_days, elapsed_working_days, {num('ratio', 'ratio')}
        FROM progress""",
    "month_progress_check": f"""SELECT month_start, month_working_days, elapsed_working_days, {num('ratio', 'ratio')},
        format('{{:.1f}}', CAST(ratio AS DOUBLE) * 100) || '%' AS shown FROM progress""",
    "report_dates": "SELECT * FROM dates",
    "working_day_split": f"""SELECT source, coalesce(working, false) AS is_working_day, count(*) AS row_count,
          sum(crates) AS crates
        FROM (SELECT 'Actual Shipment' AS source, date AS day, crates FROM actual
              UNION ALL SELECT 'PY Shipment', CASE WHEN strftime(date, '%m-%d') <> '02-29'
                THEN make_date({YEAR}, month(date), day(date)) END, crates FROM py)
        LEFT JOIN calendar c ON day = c.date GROUP BY ALL""",
    "calendar_days": "SELECT date, month_start, working AS is_working_day FROM calendar",
    "date_range_check": """SELECT count(*) FILTER (WHERE crates > 0) AS positive_rows, min(date) AS min_date,
        max(date) AS max_date, count(*) FILTER (WHERE date = report_day) AS last_day_rows,
        count(*) FILTER (WHERE date BETWEEN week_start AND report_day) AS wtd_rows FROM actual, dates""",
    "target_conform": f"""SELECT target_type, month_raw, month_start, dv, agent, item AS original_brand, brand_key,
        reporting_name, brand_match, source_uom, {wide_columns('target_hl', 'target_crates')} FROM targets""",
    "target_to_date": f"""SELECT target_type, month_raw, agent, item AS original_brand, {num('ratio', 'ratio')},
        month_working_days, elapsed_working_days, {wide_columns('target_hl_to_date', 'target_crates_to_date')}
        FROM targets""",
    "target_totals": f"""SELECT target_type, {', '.join(num(f'sum({c})', c) for c in
        ('target_hl', 'target_crates', 'target_hl_to_date', 'target_crates_to_date'))} FROM targets GROUP BY 1""",
    "aop_month_check": f"""SELECT month_raw, month_start, month_working_days, elapsed_working_days,
        {num('ratio', 'ratio')}, {num('sum(target_hl)', 'full_aop_hl')}, {num('sum(target_crates)', 'full_aop_crates')},
        {num('sum(target_hl_to_date)', 'aop_hl_to_date')}, {num('sum(target_crates_to_date)', 'aop_crates_to_date')}
        FROM targets WHERE target_type = 'AOP'
        GROUP BY month_raw, month_start, month_working_days, elapsed_working_days, targets.ratio""",
    "month_parse_check": "SELECT DISTINCT month_raw, month_start FROM target_rows",
    "regional_target": f"""SELECT dv, target_type, {num('sum(target_crates)', 'full_target_crates')},
        {num('sum(target_crates_to_date)', 'target_crates_to_date')} FROM targets GROUP BY 1, 2""",
    "regional_target_pivot": "SELECT dv, " + ", ".join(
        num(f"coalesce(sum(target_crates_to_date) FILTER (WHERE target_type = '{t}'), 0.0)", t) for t in TYPE_SUFFIX
    ) + " FROM targets WHERE dv IS NOT NULL GROUP BY 1",
    "selected_target_region": f"""SELECT dv, {num('sum(target_crates_to_date)', 'target_crates_to_date')},
        {num('sum(target_hl_to_date)', 'target_hl_to_date')}, {num('sum(target_crates)', 'full_target_crates')}
        FROM targets WHERE target_type = 'Sales Target' GROUP BY 1""",
    "regional_actual_vs_target_py": f"""SELECT dv,
        {wide_columns('target_crates_to_date', 'target_hl_to_date', 'full_target_crates')},
        {num('actual', 'actual_shipment_crates')}, {num(f'actual * {HL}', 'actual_shipment_hl')},
        {num('prior', 'py_shipment_crates')}, {num(f'prior * {HL}', 'py_shipment_hl')},
        {num('actual - target_crates_to_date', 'variance_vs_target_crates')},
        {num(divide('actual', 'target_crates_to_date'), 'achievement_pct')},
        {num('actual - prior', 'variance_vs_py_crates')}, {num(divide('(actual - prior)', 'prior'), 'growth_vs_py_pct')},
        {num(divide('actual', 'sum(actual) OVER ()'), 'contribution_pct')} FROM ({REGION})""",
    "target_windows_pivot": f"""SELECT {BY_NAME}, {wide_columns(*[f'{w}_target_{s}' for w in
        ('mtd', 'ytd', 'full_month', 'full_year') for s in TYPE_SUFFIX.values()])}
        FROM ({target_sums(('mtd', 'ytd', 'full_month', 'full_year'), BY_NAME)})""",
    "period_target_pivot": f"""SELECT {BY_NAME}, {wide_columns(*[f'{w}_target_{s}' for w in
        ('last_day', 'wtd') for s in TYPE_SUFFIX.values()])} FROM ({target_sums(('last_day', 'wtd'), BY_NAME)})""",
    "opening_stock": f"SELECT {BY_NAME}, beginning_stock FROM stock_ab",
    "stock_by_column": "SELECT brand_raw, sum(quantity) AS beginning_stock FROM stock_rows GROUP BY 1",
    "key_spine": f"SELECT {BY_KEY}, division, agent, brand FROM spine",
    "kpi_wide": f"SELECT {BY_KEY}, division, agent, brand, {wide_columns(*WIDE_MEASURES)} FROM wide",
    "stock_cover": f"""SELECT {BY_KEY}, {wide_columns('beginning_stock', 'stock_balance', 'avg_daily_depletion',
        'days_of_stock')} FROM wide""",
    "landing": f"""SELECT {BY_KEY}, {wide_columns('avg_daily_mtd_shipment', 'avg_daily_ytd_shipment', 'mtd_landing',
        'yearly_landing')} FROM wide""",
    "achievement": f"""SELECT {BY_KEY}, {wide_columns(*[c for c in WIDE_MEASURES if c.endswith('_pct') or
        'variance' in c])} FROM wide""",
    "uom_report": """SELECT division AS "Division", agent AS "Agent", brand AS "Brand", uom AS "UOM", """ + ", ".join(
        num(c, report_name(c)) for c in WIDE_MEASURES) + " FROM uom",
    "agent_consolidation": """SELECT agent, count(DISTINCT agent_key) AS source_key_count,
        count(DISTINCT brand_kpi_key) AS brand_count FROM spine GROUP BY 1""",
    "missing_division": "SELECT DISTINCT division, agent, brand FROM spine WHERE division IS NULL",
    "reconciliation": lines_of([
        ("Source YTD Shipment Crates", ACTUAL_SUM), ("Final YTD Shipment Crates", WIDE_YTD),
        ("YTD Difference", f"{WIDE_YTD} - {ACTUAL_SUM}"),
        ("Source MTD Shipment Crates", MTD_SUM), ("Final MTD Shipment Crates", WIDE_MTD),
        ("MTD Difference", f"{WIDE_MTD} - {MTD_SUM}"),
    ]),
    "period_source_vs_merged": " UNION ALL ".join(period_line(m) for m in PERIOD_MEASURES),
    "totals_by_uom": " UNION ALL ".join(
        f"""SELECT uom AS "UOM", '{report_name(m)}' AS metric, {num(f'sum({m})', 'value')} FROM uom GROUP BY uom"""
        for m in TOTAL_MEASURES),
    "unmatched_brands": """
        SELECT DISTINCT target_type, item AS original_brand, brand_key FROM targets WHERE brand_match = 'Not Matched'
        UNION ALL SELECT DISTINCT 'Actual', item, brand_key FROM actual WHERE NOT brand_known
        UNION ALL SELECT DISTINCT 'PY', item, brand_key FROM py WHERE NOT brand_known""",
    "unmatched_agents": unmatched("actual", "Actual") + " UNION ALL " + unmatched("py", "PY"),
    "shipment_totals": lines_of([
        ("Actual Shipment Crates To Date", ACTUAL_SUM), ("Selected Target Crates To Date", TARGET_SUM),
        ("Variance vs Target", f"{ACTUAL_SUM} - {TARGET_SUM}"), ("PY Shipment Crates Same Period", PY_SUM),
        ("Variance vs PY", f"{ACTUAL_SUM} - {PY_SUM}"),
    ]),
    "final_extract": f"SELECT {extract_columns(EXTRACT_COLUMNS)} FROM extract",
    "growth_ratios": "SELECT " + extract_columns(EXTRACT_COLUMNS[:5] + [
        c for c in EXTRACT_COLUMNS[5:-5] if is_ratio(c)]) + " FROM extract",
    "stock_flag_counts": """SELECT "UOM", "Target Type", "Stock Level Flag", count(*) AS row_count
        FROM extract GROUP BY ALL""",
    "totals_by_uom_type": f"""SELECT "UOM", "Target Type", {summed(TOTAL_COLUMNS)},
        {num(divide('sum("MTD_Sales")', 'sum("MTD_Target")') + ' - 1', 'MTD Ach')},
        {num(divide('sum("YTD_Sales")', 'sum("YTD_Target")') + ' - 1', 'YTD Ach')},
        {num(divide('sum("Stock_per_Agent")', 'sum("Avg_Daily_Depletion")'), 'Days of Stock')}
        FROM extract GROUP BY 1, 2""",
    "stock_totals": f"""SELECT "UOM", "Target Type", {num('sum("Beginning_Stock")', 'Beginning_Stock')},
        {num('sum("Stock_per_Agent")', 'Stock_Balance')}, {num('sum("Avg_Daily_Depletion")', 'Avg_Daily_Depletion')},
        {num('avg("Days of Stock")', 'Days_of_Stock')} FROM extract GROUP BY 1, 2""",
    "stock_before_after": f"""SELECT "UOM", {num('sum("Carried_Stock")', 'Beginning_Stock_Before')},
        {num('sum("Beginning_Stock")', 'Beginning_Stock_After')},
        {num('sum("Stock_per_Agent")', 'Stock_Balance_After')}, {summed(('MTD_Sales', 'MTD_Depletion'))}
        FROM extract GROUP BY 1""",
    "period_totals": f'SELECT "UOM", "Target Type", {summed(PERIOD_COLUMNS)} FROM extract GROUP BY 1, 2',
    "zero_period_rows": f"""SELECT "UOM", "Target Type", {summed(PERIOD_COLUMNS)} FROM extract GROUP BY 1, 2
        HAVING sum(extract."Last_Day_Sales") = 0 AND sum(extract."WTD_Sales") = 0""",
    "zero_period_agents": f"""SELECT "UOM", "Target Type", "Agent", {summed(PERIOD_COLUMNS)} FROM extract GROUP BY 1, 2, 3
        HAVING sum(extract."Last_Day_Sales") = 0 AND sum(extract."WTD_Sales") = 0""",
    "totals_by_level": f"""SELECT CASE grouping("UOM", "Target Type") WHEN 0 THEN 'UOM and Target Type' WHEN 1 THEN 'UOM'
        WHEN 2 THEN 'Target Type' ELSE 'All' END AS level, "UOM", "Target Type",
        {summed(dict.fromkeys([*TOTAL_COLUMNS, *PERIOD_COLUMNS, 'Carried_Stock']))}, {num('avg("Days of Stock")', 'Days_of_Stock')}
        FROM extract GROUP BY GROUPING SETS (("UOM", "Target Type"), ("UOM"), ("Target Type"), ())""",
    "extract_completed": f"""SELECT {extract_columns([c for c in EXTRACT_COLUMNS if c not in ('WTD_Depletion_PY', 'Avg_Daily_Depletion')])},
        0.0 AS "WTD_Depletion_PY", 0.0 AS "Avg_Daily_Depletion" FROM extract""",
    "extract_labels": 'SELECT DISTINCT "UOM", "Target Type" FROM extract',
    "extract_preview": f"""SELECT {extract_columns(['UOM', 'Target Type', 'Division', 'Agent', 'Brand', 'YTD_Sales', 'YTD_PY',
        'YTD VS PY Ach'])} FROM (SELECT * FROM extract
        ORDER BY "YTD_Sales" DESC NULLS LAST, "UOM" NULLS LAST, "Target Type" NULLS LAST, "Division" NULLS LAST, "Agent" NULLS LAST, "Brand" NULLS LAST LIMIT 100)""",
    "display_format": f"""SELECT "UOM", "Target Type", "Division", "Agent", "Brand", {DISPLAYED} FROM extract""",
}
# What is written and read back is the extract itself.
BODIES["extract_csv_roundtrip"] = BODIES["final_extract"]

SQL = {name: with_steps(body) for name, body in BODIES.items()}
# The tables of an untidy source.
ODD = {
    "dim_agent": f"""
SELECT agent_source_key, {clean('agent')} AS agent_key, {strip('agent')} AS agent, division
FROM (SELECT s_suppkey, {clean('s_name')} AS agent_source_key, CASE WHEN s_suppkey % 3 <> 0 THEN division END AS division,
             CASE WHEN s_suppkey % 3 = 0 THEN 'other-' WHEN s_suppkey % 2 = 0 THEN 'agent-' ELSE 'AGENT  ' END
               || CAST(s_suppkey // 2 AS VARCHAR) AS agent
      FROM agents WHERE s_suppkey % 10 <> 9)""",
    "actual_all": STEPS["actual_all"].replace("SELECT ship_day", "SELECT ship_day + CAST(l_orderkey % 3 AS INTEGER) AS billed, ship_day"),
    "dep_all": STEPS["dep_all"].replace("l_quantity AS", f"l_quantity * {HL} / {HL} AS"),
    "py_dep_all": STEPS["py_dep_all"].replace("l_quantity AS", f"l_quantity * {HL} / {HL} AS"),
    "anchor": """
SELECT last_date, coalesce((SELECT max(date) FROM actual_all WHERE crates > 0 AND date <= last_date), last_date) AS report_day
FROM (SELECT max(billed) AS last_date FROM actual_all)""",
}
for _query in ("report_dates", "agent_mdm", "final_extract"):
    SQL[f"odd_{_query.removeprefix('final_')}"] = with_steps(BODIES[_query], ODD)
_depleted = f"SELECT {BY_NAME}, {wide_columns('mtd_depletion', 'ytd_depletion')} FROM ({BODIES['depletion_mtd_ytd']})"
SQL["odd_depletion"] = with_steps(_depleted, ODD)
# The report as it was on the last day with an order.
AS_OF = """
SELECT min(day) AS day FROM (SELECT max(CAST(l_shipdate AS DATE)) AS day FROM lineitem
                             UNION ALL SELECT max(CAST(o_orderdate AS DATE)) FROM orders)"""
ANCHOR_AS_OF = f"""
SELECT max(date) AS last_date, coalesce(max(date) FILTER (WHERE crates > 0), max(date)) AS report_day
FROM actual_all WHERE date <= ({AS_OF})"""
SQL["last_day_wtd_depletion_as_of"] = with_steps(BODIES["last_day_wtd_depletion"], {"anchor": ANCHOR_AS_OF})
