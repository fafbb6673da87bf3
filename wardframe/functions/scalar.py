"""Business formulas and null rules as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ratio reported when almost no contractor hours were worked,
# the hours that count as "almost none", and the weekday/weekend split of a week.
NO_CONTRACTOR_RATIO = 10000.0
MIN_CONTRACTOR_HOURS = 1e-3
WEEKDAYS, WEEKEND_DAYS = 5, 2


def zero_if_null(value: Column) -> Column:
    """Number with null as 0; text that holds no number also counts as 0.

    The cast comes first: a column that was blank in the whole file may arrive
    as text, and coalescing text with an integer fails on '1.5' under ANSI.
    """
    return F.coalesce(value.try_cast("double"), F.lit(0.0))


def bed_utilization(residents: Column, beds: Column) -> Column:
    """Residents per 100 beds, 2 decimals; 0 without beds, null if unknown, not clamped."""
    return F.round(F.when(beds == 0, 0.0).otherwise(100 * residents / beds), 2)


def week_weighted(weekday: Column, weekend: Column) -> Column:
    """Daily rate averaged over the seven days of a week, 2 decimals."""
    week = WEEKDAYS * weekday + WEEKEND_DAYS * weekend
    return F.round(week / (WEEKDAYS + WEEKEND_DAYS), 2)


def guarded_ratio(employee: Column, contractor: Column) -> Column:
    """Employee hours per contractor hour, 2 decimals; unknown contractor hours give null."""
    ratio = F.when(contractor < MIN_CONTRACTOR_HOURS, NO_CONTRACTOR_RATIO).otherwise(
        employee / contractor
    )
    return F.round(ratio, 2)


def parse_work_date(value: Column) -> Column:
    """Date from a ``yyyymmdd`` number or text; null if it is no date."""
    return F.try_to_date(value.cast("string"), "yyyyMMdd")


def all_digits(value: Column) -> Column:
    """True where the text is non-empty and every character is numeric."""
    return value.rlike(r"^\p{N}+$")


def two_decimal_text(value: Column) -> Column:
    return F.format_string("%.2f", value)


def int_or_null(value: Column) -> Column:
    return value.try_cast("int")
