"""Grouped sums and means with the null rules of the reports.

Rows without a group are dropped, a group without values sums to 0, and a
mean over no values is reported as 0. Groups come out in ascending order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardframe.operators.columns import quoted


def _grouped(df: DataFrame, group: str, results: Sequence[Column]) -> DataFrame:
    return df.filter(quoted(group).isNotNull()).groupBy(quoted(group)).agg(*results)


def total(value: Column) -> Column:
    """Sum with 0, not null, when there is nothing to add."""
    summed = F.sum(value)
    return F.coalesce(summed, F.lit(0))


def sum_by(df: DataFrame, group: str, values: Sequence[str]) -> DataFrame:
    sums = [total(quoted(v)).alias(v) for v in values]
    return _grouped(df, group, sums).orderBy(quoted(group))


def mean_by(df: DataFrame, group: str, value: str) -> DataFrame:
    mean = F.avg(quoted(value)).alias(value)
    return _grouped(df, group, [mean]).fillna(0, subset=[value]).orderBy(quoted(group))


def means_of_group_means(df: DataFrame, group: str, values: Sequence[str]) -> DataFrame:
    """One row: per column the mean of the group means, each group counting the same."""
    means = _grouped(df, group, [F.avg(quoted(v)).alias(v) for v in values])
    return means.fillna(0, subset=list(values)).agg(*[F.avg(quoted(v)).alias(v) for v in values])


def mean_of_group_means(df: DataFrame, group: str, value: str) -> DataFrame:
    return means_of_group_means(df, group, [value])


def summed_together(df: DataFrame, group: str, sums: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per group, one total per entry of ``sums`` over all rows of its columns.

    Not ordered, so that a caller may aggregate further.
    """
    totals = []
    for name, columns in sums.items():
        row_sum = sum((F.coalesce(quoted(c), F.lit(0.0)) for c in columns), F.lit(0.0))
        totals.append(total(row_sum).alias(name))
    return _grouped(df, group, totals)


def long_form(
    df: DataFrame, id_column: str, columns: Sequence[str], name: str, value: str
) -> DataFrame:
    """One row per id and column: the column's name and its value."""
    return df.unpivot(quoted(id_column), [quoted(c) for c in columns], name, value)
