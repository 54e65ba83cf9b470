"""Small helpers for composing Spark SQL expressions as text.

The rule functions of this package take and return expression text. One
``F.expr`` then hands a whole rule to the parser, where building the same tree
call by call would cross into the JVM once per node.
"""

from __future__ import annotations

from datetime import date


def quoted(name: str) -> str:
    """Reference to a column whose name may hold spaces, dots or commas."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """String literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def day(value: date) -> str:
    """Date literal."""
    return f"date'{value.isoformat()}'"


def number(value: float) -> str:
    """Double literal."""
    return f"{value!r}D"


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"
