"""Cleaned tables to the star schema. Narrow plans: scan, project, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe import schema as S
from wardframe.functions import (
    bed_utilization,
    guarded_ratio,
    int_or_null,
    parse_work_date,
    week_weighted,
    zero_if_null,
)


def dim_bed(silver: DataFrame, include_footnote: bool = True) -> DataFrame:
    """Providers with residents and bed utilisation.

    The residents' total adds the footnote column to the average; this is
    what the reports have always shown, and ``include_footnote=False`` leaves
    the footnote out.
    """
    residents = zero_if_null(F.col(S.RESIDENTS))
    footnote = zero_if_null(F.col(S.RESIDENTS_FOOTNOTE))
    in_all = residents + footnote if include_footnote else residents
    return silver.select(
        *S.PROVIDER,
        S.BEDS,
        residents.alias(S.RESIDENTS),
        int_or_null(footnote).alias(S.RESIDENTS_FOOTNOTE),
        in_all.alias(S.RESIDENTS_TOTAL),
        bed_utilization(in_all, F.col(S.BEDS)).alias(S.UTILIZATION),
    )


def dim_nurse(silver: DataFrame) -> DataFrame:
    """Providers with nursing hours and the four nurse-to-patient rates."""
    hours = (
        S.AIDE_HOURS,
        S.LPN_HOURS,
        S.RN_HOURS,
        S.NURSE_HOURS,
        S.WEEKEND_HOURS,
        S.RN_WEEKEND_HOURS,
    )
    known = {h: zero_if_null(F.col(h)) for h in hours}
    return silver.select(
        *S.PROVIDER,
        *[value.alias(name) for name, value in known.items()],
        *[
            week_weighted(known[weekday], known[weekend]).alias(rate)
            for rate, (weekday, weekend) in S.NURSE_RATES.items()
        ],
    )


def fact_dates(silver: DataFrame) -> DataFrame:
    """``silver`` with WORKDATE as a date, and its year, month and day."""
    dated = silver.withColumn("WORKDATE", parse_work_date(F.col("WORKDATE")))
    return dated.withColumns(
        {
            "WORKYEAR": F.year("WORKDATE"),
            "WORKMONTH": F.month("WORKDATE"),
            "WORKDAY": F.dayofmonth("WORKDATE"),
        }
    )


def fact_hours(silver: DataFrame, *more: str) -> DataFrame:
    """The columns of ``silver`` that the daily hours by role are made of, and ``more`` of its columns."""
    return silver.select(*S.WORKED, *[h for role in S.ROLES for h in S.hours(role)], *more)


def staff_ratios(hours: DataFrame) -> DataFrame:
    """``hours`` with the employee-to-contractor ratio of each role."""
    ratios = {
        f"STAFF_RATIO_{role}": guarded_ratio(*[F.col(h) for h in S.hours(role)])
        for role in S.ROLES
    }
    return hours.withColumns(ratios)


def fact_staff(silver: DataFrame) -> DataFrame:
    """Daily hours by role, with the employee-to-contractor ratio of each role."""
    return staff_ratios(fact_dates(fact_hours(silver)))
