"""Generic cleaning operators, each ``DataFrame -> DataFrame`` for ``df.transform``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from retailweave.functions import columns, statistics


def impute_median(df: DataFrame, column: str, median: Column | None = None) -> DataFrame:
    """Fill NULL with the exact lower median of the column, which becomes a double.

    ``median`` takes a value that is already known instead of computing it.
    """
    if median is None:
        median = statistics.exact_quantile(df, column).scalar()
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), median.cast("double")))


def impute_mode(df: DataFrame, column: str, mode: Column | None = None) -> DataFrame:
    """Fill NULL with the most frequent value of the column, keeping its type.

    NULL competes too: where it is the most frequent, nothing is filled.
    """
    if mode is None:
        mode = statistics.mode(df, column).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mode.cast(df.schema[_name(df, column)].dataType)))


def fill_constant(df: DataFrame, **fills) -> DataFrame:
    """Fill NULL in each named column with its constant."""
    return df.withColumns({name: columns.fill(name, value) for name, value in fills.items()})


def replace_values(df: DataFrame, column: str, values: Iterable, replacement) -> DataFrame:
    """Put ``replacement`` for every occurrence of ``values``."""
    return df.withColumn(column, columns.replace_values(column, values, replacement))


def add_calendar(df: DataFrame, column: str) -> DataFrame:
    """Turn ``column`` into a date and add its month, day, quarter and year."""
    return df.withColumn(column, columns.to_date(column)).withColumns(columns.calendar_parts(column))


def count_fills(df: DataFrame, told: Observation, fills: Iterable[str] = (), dates: Iterable[str] = ()) -> DataFrame:
    """``df``, which tells ``told`` what cleaning will change, in the pass that cleans it.

    ``filled_<column>`` is the number of nulls in each of ``fills``, and ``undated_<column>`` that of texts in each of ``dates`` that are no date
    and become null.
    """
    filled = [F.count_if(F.col(name).isNull()).alias(f"filled_{name}") for name in fills]
    undated = [F.count_if(F.col(name).isNotNull() & columns.to_date(name).isNull()).alias(f"undated_{name}") for name in dates]
    return df.observe(told, F.count(F.lit(1)).alias("rows"), *filled, *undated)


def _name(df: DataFrame, column: str) -> str:
    """The column's name as the schema spells it (column names ignore case)."""
    return next(name for name in df.columns if name.lower() == column.lower())
