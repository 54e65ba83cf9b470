"""Every rule function against literal inputs, hazards included."""

from datetime import date

import pytest

from cratewise.config import BrandRules
from cratewise.functions import dates as fd
from cratewise.functions import numbers as fn
from cratewise.functions import text as ft


def check(evaluate, expression, cases, kind="string"):
    inputs, expected = zip(*cases, strict=True)
    assert evaluate(expression, list(inputs), kind) == list(expected)


def test_clean_text(evaluate):
    cases = [
        (" a\nb  c ", "A B C"),
        ("a   b", "A  B"),
        (" Agent ", "AGENT"),
        ("x\r\ny", "X Y"),
        ("straße", "STRASSE"),
        ("", ""),
        (None, None),
    ]
    check(evaluate, ft.clean_text("v"), cases)


@pytest.mark.parametrize("two_steps", [False, True])
def test_proper_text(evaluate, two_steps):
    expression = ft.shown_text(ft.flat_text("v")) if two_steps else ft.proper_text("v")
    cases = [
        ("north-east", "North East"),
        ("o'neil 24x33", "O'Neil 24X33"),
        ("WEST", "West"),
        (" a\tb \n c ", "A B C"),
        ("a     b", "A B"),
        ("ß ßa éA", "Ss Ssa Éa"),
        ("አabc", "አAbc"),
        ("brand#11", "Brand#11"),
        ("a.b ab_cd 1st", "A.B Ab_Cd 1St"),
        ("nan", None),
        ("None", None),
        ("", None),
        ("  ", None),
        (None, None),
    ]
    check(evaluate, expression, cases)


def test_title_case_matches_python(evaluate):
    texts = ["hello world", "x-ray 3d", "McDONALD's", "a1b2 c#d", "ÉCOLE d'été", "ab  cd", "(abc) [def]", "q"]
    assert evaluate(ft.title_case("v"), texts) == [text.title() for text in texts]


def test_long_text_needs_no_deep_recursion(evaluate):
    long = "word's 12ab " * 20000
    assert evaluate(ft.proper_text("v"), [long]) == [long.strip().title()]


def test_brand_key_removes_words_in_order(evaluate):
    cases = [
        ("Brand#2 Beer", "BRAND#2"),
        (" lager malt crate 24x33 ", "LAGER"),
        ("Lager24x33", "LAGER"),
        ("lager H+HK", "LAGER"),
        ("lager H + HK", "LAGER"),
        ("a   b", "A  B"),
        (None, None),
    ]
    check(evaluate, ft.brand_kpi_key("v", BrandRules()), cases)


def test_brand_families_first_match_wins(evaluate):
    rules = BrandRules(families=("A-PLUS", "A"), replacements=(("ALPHA", "A-PLUS"),), display_names=(("A", "Alpha"),))
    cases = [("x a-plus", "A-PLUS"), ("x a", "A"), ("alpha one", "A-PLUS"), ("xyz", "XYZ"), (None, None)]
    check(evaluate, ft.brand_kpi_key("v", rules), cases)
    shown = [("A", "Alpha"), (" a ", "Alpha"), ("A-PLUS", "A-Plus"), (None, None)]
    check(evaluate, ft.brand_display_name("v", rules), shown)


def test_labels(evaluate):
    check(evaluate, ft.normalize_uom("v"), [(" hl ", "HL"), ("CRATES", "Crates"), (" box ", "box"), (None, None)])
    kinds = [("sales target", "Sales"), ("Sales", "Sales"), ("snop ", "SNOP"), ("aop", "AOP"), (" x ", "x"), (None, None)]
    check(evaluate, ft.normalize_target_type("v"), kinds)


def test_stock_brand_removes_only_listed_spellings(evaluate):
    cases = [("Lager Crate 24x33", "Lager"), ("Lager CRATE 24X33", "Lager"), ("Lager CRATE 24x33", "Lager CRATE 24x33")]
    check(evaluate, ft.stock_brand("v"), cases)


def test_working_day_flag(evaluate):
    cases = [
        ("Yes", True), ("y", True), ("1", True), ("TRUE", True), (" working ", True), ("Working Day", True),
        ("1.0", False), ("No", False), ("", False), (None, False),
    ]
    check(evaluate, ft.working_day_flag("v"), cases)


def test_to_number_compat(evaluate):
    cases = [
        ("1,234", 1234.0), ("-5", 5.0), ("-", 0.0), ("", None), ("(5)", None), ("5-3", 503.0), ("1e-05", 100000.0),
        ("12d", None), ("nan", None), ("NaN", None), ("None", None), ("1e5", 100000.0), (".5", 0.5), ("1.", 1.0),
        ("  7\t", 7.0), ("1 2", None), ("0x1A", None), ("1_000", None), ("+5", 5.0), (None, None),
    ]
    check(evaluate, fn.to_number("v"), cases)


def test_to_number_signed(evaluate):
    cases = [("-5", -5.0), (" - ", 0.0), ("5-3", None), ("1e-05", 1e-05), ("-1,234.5", -1234.5), ("(5)", None)]
    check(evaluate, fn.to_number("v", "signed"), cases)


def test_typed_numbers_skip_the_text(spark):
    rows = spark.createDataFrame([(-5.0,), (float("nan"),), (None,)], "v double")
    kind = rows.schema["v"].dataType
    found = rows.selectExpr(f"{fn.number_from('v', kind)} as a", f"{fn.number_from('v', kind, 'signed')} as b").collect()
    assert [tuple(row) for row in found] == [(5.0, -5.0), (None, None), (None, None)]


def test_guarded_ratios(spark):
    rows = spark.createDataFrame([(5.0, 0.0), (5.0, None), (5.0, 2.0)], "n double, d double")
    found = rows.selectExpr(f"{fn.safe_divide('n', 'd')} as r", f"{fn.growth('n', 'd')} as g").collect()
    assert [tuple(row) for row in found] == [(0.0, -1.0), (None, None), (2.5, 1.5)]


def test_clips_keep_null(evaluate):
    check(evaluate, fn.clip_unit("v"), [(-1.0, 0.0), (0.4, 0.4), (3.0, 1.0), (None, None)], "double")
    check(evaluate, fn.clip_lower("v"), [(-1.0, 0.0), (2.0, 2.0), (None, None)], "double")


def test_display_formats_match_python(evaluate):
    values = [0.0, 0.5, 1.5, 2.5, 1234567.891, -1234.5, 0.125, 62.53125, 0.0625, -0.0004, 12.3456]
    assert evaluate(fn.show_number("v", 0), values, "double") == [f"{v:,.0f}" for v in values]
    assert evaluate(fn.show_number("v", 2), values, "double") == [f"{v:,.2f}" for v in values]
    assert evaluate(fn.show_number("v", 3), values, "double") == [f"{v:,.3f}" for v in values]
    assert evaluate(fn.show_percent("v"), values, "double") == [f"{v:.1%}" for v in values]
    assert evaluate(fn.show_percent("v", True), values, "double") == [f"{v:+.1%}" for v in values]


def test_day_first_dates(evaluate):
    cases = [
        ("13/02/2026", date(2026, 2, 13)),
        ("01/02/2026", date(2026, 2, 1)),
        ("1-2-26", date(2026, 2, 1)),
        ("1.2.1999", date(1999, 2, 1)),
        ("1/2/75", date(1975, 2, 1)),
        ("2026-01-02", date(2026, 1, 2)),
        ("2026-01-02 10:30:00", date(2026, 1, 2)),
        ("10/5/2026 14:30", date(2026, 5, 10)),
        ("20260503", date(2026, 5, 3)),
        ("3-Mar-2026", date(2026, 3, 3)),
        ("3 march 26", date(2026, 3, 3)),
        ("May 1, 2026", date(2026, 5, 1)),
        ("31/06/2026", None),
        ("13/13/2026", None),
        ("x", None),
        ("", None),
        (None, None),
    ]
    check(evaluate, fd.parse_date("v"), cases)


def test_typed_dates_lose_the_time(spark):
    row = spark.sql("select timestamp_ntz'2026-01-02 10:00:00' as v, date'2026-01-03' as d")
    found = row.selectExpr(
        f"{fd.date_from('v', row.schema['v'].dataType)} as a", f"{fd.date_from('d', row.schema['d'].dataType)} as b"
    ).first()
    assert tuple(found) == (date(2026, 1, 2), date(2026, 1, 3))


def test_target_months(evaluate):
    march, may = date(2026, 3, 1), date(2026, 5, 1)
    cases = [
        ("3", march), ("03", march), ("Mar", march), ("march", march), ("202603", march), (" MAR ", march),
        ("5.7", may), ("46143", may), ("May 2025", date(2025, 5, 1)), ("5/3/2026", march),
        ("15-Jan", date(2026, 1, 1)), ("2026", date(2026, 1, 1)), ("1999", date(1999, 1, 1)),
        ("Jan-26", date(2026, 1, 1)), ("Sept-26", date(2026, 9, 1)), ("sept 2026", date(2026, 9, 1)),
        ("2026-05", may), ("05/2026", may), ("01-May-26", may), ("May 1, 2026", may), ("20260503", may),
        ("01/13/2026", date(2026, 1, 1)), ("12.9", date(2026, 12, 1)), ("5/13", may), ("13/5", may),
        ("13", None), ("0", None), ("100", None), ("202613", None), ("x", None), ("1500", None),
        ("99999999999999999999", None), ("1e400", None), ("31/06/2026", None), ("", None), (None, None),
    ]
    check(evaluate, fd.parse_target_month("v", 2026), cases)


def test_year_shift_and_same_day(spark, evaluate):
    shifted = spark.sql("select add_months(date'2024-02-29', -12) as a, add_months(date'2023-02-28', -12) as b").first()
    assert tuple(shifted) == (date(2023, 2, 28), date(2022, 2, 28))
    cases = [(date(2024, 2, 29), None), (date(2024, 2, 28), date(2026, 2, 28)), (None, None)]
    check(evaluate, fd.same_day_in_year("v", 2026), cases, "date")
    check(evaluate, fd.same_day_in_year("v", 2028), [(date(2024, 2, 29), date(2028, 2, 29))], "date")


def test_month_cells_of_typed_dates(spark):
    row = spark.sql("select date'2026-05-17' as v")
    month = fd.month_text("v", row.schema["v"].dataType)
    assert row.selectExpr(f"{fd.parse_target_month(month, 2020)} as m").first()["m"] == date(2026, 5, 1)
