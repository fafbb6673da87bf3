"""Filters, orders, distinct values and unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame

from wardframe.functions import all_digits
from wardframe.operators.columns import quoted


class NoRows(LookupError):
    """A lookup found nothing."""


def where_equal(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows whose column equals a value bound at run time; pushed to the scan."""
    return df.filter(quoted(column) == value)


def require_rows(df: DataFrame, message: str = "no data found") -> DataFrame:
    """``df`` itself, or NoRows if it is empty."""
    if df.isEmpty():
        raise NoRows(message)
    return df


def non_numeric_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key holds a character that is not numeric."""
    return df.filter(~all_digits(quoted(key)))


def outside(value: Column, lower: object, upper: object) -> Column:
    """Strictly below the lower or above the upper bound."""
    return (value < lower) | (value > upper)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values, null included, in ascending order."""
    return df.select(quoted(column)).distinct().orderBy(quoted(column))


def first_rows(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in a stated order, kept as a per-task top-n."""
    return df.orderBy(*[quoted(c) for c in order_by]).limit(n)


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts, matched by column name; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
