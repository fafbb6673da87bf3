"""Checks on the cleaned tables, one row per check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardframe.functions import all_digits
from wardframe.operators.duplicates import repeated_keys


class QualityError(ValueError):
    """A required check failed."""


def quality_report(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows (check, n_failed): key uniqueness, key format and missing keys.

    Each table is read once and reduced to counted keys.
    """

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("copies"))), F.lit(0))

    def checks(keys: DataFrame, **failed: Column) -> DataFrame:
        found = keys.agg(*[value.alias(name) for name, value in failed.items()])
        return found.unpivot([], list(failed), "check", "n_failed")

    providers = dim.groupBy("PROVIDER_NUM").agg(F.count("*").alias("copies"))
    days = fact.groupBy("PROVNUM", "WORKDATE").agg(F.count("*").alias("copies"))
    return checks(
        providers,
        provider_key_repeated=F.count_if(F.col("copies") > 1),
        provider_key_missing=rows_where(F.col("PROVIDER_NUM").isNull()),
        provider_key_not_numeric=rows_where(~all_digits(F.col("PROVIDER_NUM"))),
    ).unionByName(
        checks(
            days,
            work_day_key_repeated=F.count_if(F.col("copies") > 1),
            work_day_key_missing=rows_where(F.expr("PROVNUM IS NULL OR WORKDATE IS NULL")),
        )
    )


def require_unique_providers(dim: DataFrame) -> None:
    """Raises QualityError if a provider key recurs; the join would multiply its days."""
    example = repeated_keys(dim, ["PROVIDER_NUM"]).head(1)
    if example:
        raise QualityError(f"provider key occurs {example[0].copies} times: {example[0][0]!r}")
