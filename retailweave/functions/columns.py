"""Column expressions. All of them are built-ins that stay inside code generation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# Full English names as calendars print them.
MONTHS = (
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
)
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def fill(column: str, value: Column | str | int | float) -> Column:
    """The column, with NULL replaced by ``value``."""
    return F.coalesce(F.col(column), value if isinstance(value, Column) else F.lit(value))


def flag_text(column: str, missing: str = "0") -> Column:
    """The column as text, with NULL as ``missing`` (a double 1.0 reads ``1.0``)."""
    return F.coalesce(F.col(column).cast("string"), F.lit(missing))


def replace_values(column: str, values: Iterable, replacement) -> Column:
    """``replacement`` where the column is one of ``values``; NULL stays NULL."""
    return F.when(F.col(column).isin(*values), F.lit(replacement)).otherwise(F.col(column))


def bucketize(column: Column | str, edges: Sequence[float], labels: Sequence[str], default: str) -> Column:
    """Label of the half-open bin ``[edges[i], edges[i + 1])`` that holds the value.

    NULL, NaN and values outside all bins get ``default``.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError(f"{len(edges)} edges make {len(edges) - 1} bins, got {len(labels)} labels")
    value = F.col(column) if isinstance(column, str) else column
    bins = zip(edges[:-1], edges[1:], labels)
    low, high, label = next(bins)
    expression = F.when((value >= low) & (value < high), label)
    for low, high, label in bins:
        expression = expression.when((value >= low) & (value < high), label)
    return expression.otherwise(default)


def to_date(column: str) -> Column:
    """The column as a date; text that is no date becomes NULL, also under ANSI rules."""
    return F.col(column).try_cast("date")


def calendar_parts(column: str) -> dict[str, Column]:
    """Full English month and weekday name, quarter and year of a date column.

    The names are picked from constant arrays, which takes a fraction of the
    time of formatting every date.
    """
    date = F.col(column)
    return {
        "month": F.get(F.array(*map(F.lit, MONTHS)), F.month(date) - 1),
        "day": F.get(F.array(*map(F.lit, WEEKDAYS)), F.dayofweek(date) - 1),
        "quarter": F.quarter(date),
        "year": F.year(date),
    }
