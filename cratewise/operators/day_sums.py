"""Volume facts as sums per source-name pair and day.

Every window of a report is a sum over days, so one pass over a fact serves all
of them: the metric table, the totals of the checks, date ranges and row counts
read the day sums, which have at most one row per pair and day however many rows
the fact has. Windows stay sums over their days, not differences of running
totals: a difference of doubles is rarely the exact zero that ratios test for.

Days given as text are grouped as they are spelled and parsed once per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratewise.functions.dates import parsed_days, parsed_rows

DAY_COLUMNS = ("event_date", "cutoff_date")
#: Rows of a group, and those with a positive volume.
ROWS, POSITIVE = "row_count", "positive_rows"


def spelled_days(shaped: DataFrame) -> list[str]:
    """The day columns that are text."""
    return [c for c in DAY_COLUMNS if c in shaped.columns and isinstance(shaped.schema[c].dataType, T.StringType)]


def dated(shaped: DataFrame) -> DataFrame:
    """A shaped fact with its days parsed where they are text."""
    spelled = spelled_days(shaped)
    return parsed_days(shaped, spelled) if spelled else shaped


def has_volume(df: DataFrame) -> str:
    """Whether a row, or one of those it stands for, has a positive volume."""
    return f"{POSITIVE} > 0" if POSITIVE in df.columns else "crates > 0"


def rows_of(df: DataFrame) -> str:
    return f"sum({ROWS})" if ROWS in df.columns else "count(*)"


def positive_rows_of(df: DataFrame) -> str:
    return f"sum({POSITIVE})" if POSITIVE in df.columns else "count_if(crates > 0)"


def summed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cutoff = [F.expr("max(cutoff_date) as cutoff_date")] if "cutoff_date" in df.columns and "cutoff_date" not in keys else []
    return df.groupBy(*keys).agg(
        F.expr("sum(crates) as crates"), F.expr(f"{rows_of(df)} as {ROWS}"), F.expr(f"{positive_rows_of(df)} as {POSITIVE}"), *cutoff
    )


def day_sums(shaped: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per day and source names: crates, rows, rows with volume and the newest cutoff.

    Takes the place of the fact everywhere; a sum without any volume stays null.
    """
    spelled = spelled_days(shaped)
    if not spelled:
        return summed(shaped, [*names, "event_date"])
    grouped = summed(shaped, list(dict.fromkeys([*names, "event_date", *spelled])))
    return summed(parsed_rows(grouped, spelled), [*names, "event_date"])
