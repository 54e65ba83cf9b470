"""Number coercion, guarded arithmetic and display formats, as expression text."""

from __future__ import annotations

from pyspark.sql import types as T

from cratewise.functions.sql import text
from cratewise.functions.text import replaced, strip

UNSIGNED = r"^[+]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+]?[0-9]+)?$"
SIGNED = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def parsed_number(value: str, shape: str) -> str:
    """Double of a text that has the shape, else null (a bare cast would also
    take type suffixes and NaN)."""
    return f"if({value} rlike {text(shape)}, try_cast({value} as double), null)"


def to_number(value: str, mode: str = "compat") -> str:
    """Text to double, null where it is no number.

    ``compat`` turns every minus sign into a zero, so signs vanish ("-5" is 5
    and "5-3" is 503). ``signed`` keeps signs and maps only a lone "-" to 0.
    """
    plain = replaced(value, ",", "")
    if mode == "compat":
        return parsed_number(strip(replaced(plain, "-", "0")), UNSIGNED)
    plain = strip(plain)
    return f"if({plain} = '-', 0.0D, {parsed_number(plain, SIGNED)})"


def number_from(value: str, data_type: T.DataType, mode: str = "compat") -> str:
    """``to_number`` for text; typed numbers skip the text detour."""
    if not isinstance(data_type, T.NumericType):
        return to_number(f"cast({value} as string)", mode)
    typed = f"nanvl(cast({value} as double), null)"
    return f"abs({typed})" if mode == "compat" else typed


def safe_divide(numerator: str, denominator: str) -> str:
    """0 for a zero denominator, null for a null one."""
    return f"if({denominator} = 0, 0.0D, {numerator} / {denominator})"


def growth(numerator: str, denominator: str) -> str:
    """Ratio minus one, so a zero denominator gives -1."""
    return f"{safe_divide(numerator, denominator)} - 1.0D"


def clip_lower(value: str, floor: float = 0.0) -> str:
    return f"if({value} is null, null, greatest({value}, {floor}D))"


def clip_unit(value: str) -> str:
    return f"if({value} is null, null, greatest(0.0D, least({value}, 1.0D)))"


def total(value: str, alias: str | None = None) -> str:
    """Sum that is 0 where nothing was summed."""
    return f"coalesce(sum({value}), 0.0D)" + (f" as `{alias}`" if alias else "")


def totals(names) -> list[str]:
    return [total(f"`{name}`", name) for name in names]


def show_number(value: str, decimals: int = 0) -> str:
    """Thousands separators, ties to even."""
    return f"format_number(cast({value} as double), {decimals})"


def show_percent(value: str, signed: bool = False) -> str:
    """One decimal and a percent sign, without separators."""
    scaled = f"cast({value} as double) * 100"
    body = f"concat(replace(format_number({scaled}, 1), ',', ''), '%')"
    return f"if({scaled} >= 0, concat('+', {body}), {body})" if signed else body
