"""Text rules for names, brands, units and flags. Every function maps the
expression text of a string to expression text; null stays null."""

from __future__ import annotations

from cratewise.config import BrandRules
from cratewise.functions.sql import let, text

# Every character a Unicode-aware strip removes (Spark's own
# trim covers the space only).
WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0" + "".join(
    map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)
# Runs of cased letters alternate with everything else.
WORD_RUNS = r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"
# A letter after something else than a letter or space, or a character beyond ASCII.
BEYOND_WORDS = "[^A-Za-z ][A-Za-z]|[^ -~]"
# Accepted spellings.
WORKING_DAY_TOKENS = ("YES", "Y", "TRUE", "1", "WORKING DAY", "WORKING")
STOCK_SUFFIXES = ("Crate 24x33", "Crate 24X33", "CRATE 24X33", "crate 24x33")


def replaced(value: str, old: str, new: str) -> str:
    return f"replace({value}, {text(old)}, {text(new)})"


def strip(value: str) -> str:
    return f"btrim({value}, {text(WHITESPACE)})"


def clean_text(value: str) -> str:
    """Join key of a name: stripped, upper case, line breaks to spaces and one
    pass of double to single space (so three spaces leave two)."""
    broken = f"translate(upper({strip(value)}), {text(chr(10) + chr(13))}, '  ')"
    return replaced(broken, "  ", " ")


def title_case(value: str) -> str:
    """Upper-cases the first letter after any non-letter, lower-cases the rest.

    Texts whose letters only follow letters or spaces go through ``initcap``;
    others are split into runs of letters first.
    """
    runs = f"regexp_extract_all({value}, {text(WORD_RUNS)}, 1)"
    by_runs = f"array_join(transform({runs}, run -> initcap(run)), '')"
    return f"if({value} rlike {text(BEYOND_WORDS)}, {by_runs}, initcap({value}))"


def flat_text(value: str) -> str:
    """Breaks, tabs and hyphens to spaces, stripped, spaces collapsed."""
    flat = strip(f"translate({value}, {text(chr(10) + chr(13) + chr(9) + '-')}, '    ')")
    return f"regexp_replace({flat}, ' {{2,}}', ' ')"


def shown_text(flat: str) -> str:
    """Title case of a flat text; blank and textual nulls become null."""
    return f"if({flat} is null or upper({flat}) in ('', 'NAN', 'NONE'), null, {title_case(flat)})"


def proper_text(value: str) -> str:
    """Display form of a name in one expression; frames with many rows take
    ``flat_text`` and ``shown_text`` in two steps."""
    return let(flat_text(value), "t", shown_text("t"))


def brand_kpi_key(value: str, rules: BrandRules) -> str:
    """Controlled brand key shared by targets, sell-in, sell-out and stock."""
    key = strip(f"upper({value})")
    for word in rules.remove_words:
        key = replaced(key, word, "")
    for old, new in rules.replacements:
        key = replaced(key, old, new)
    key = strip(replaced(key, "  ", " "))
    if not rules.families:
        return key
    branches = " ".join(f"when contains(k, {text(f)}) then {text(f)}" for f in rules.families)
    return let(key, "k", f"case {branches} else k end")


def brand_display_name(key: str, rules: BrandRules) -> str:
    if not rules.display_names:
        return title_case(key)
    branches = " ".join(f"when {text(known)} then {text(name)}" for known, name in rules.display_names)
    return f"case {strip(f'upper({key})')} {branches} else {title_case(key)} end"


def normalize_uom(value: str) -> str:
    kept = strip(value)
    return f"case upper({kept}) when 'HL' then 'HL' when 'CRATES' then 'Crates' else {kept} end"


def normalize_target_type(value: str) -> str:
    kept = strip(value)
    return (
        f"case upper({kept}) when 'SALES' then 'Sales' when 'SALES TARGET' then 'Sales' "
        f"when 'SNOP' then 'SNOP' when 'AOP' then 'AOP' else {kept} end"
    )


def stock_brand(value: str) -> str:
    """Brand text of a stock column header: the pack-size spellings removed."""
    for suffix in STOCK_SUFFIXES:
        value = replaced(value, suffix, "")
    return strip(value)


def working_day_flag(value: str) -> str:
    tokens = ", ".join(text(token) for token in WORKING_DAY_TOKENS)
    return f"coalesce(upper({strip(f'cast({value} as string)')}) in ({tokens}), false)"
