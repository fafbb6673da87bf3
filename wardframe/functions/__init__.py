"""Column functions; every one stays inside the JVM."""

from wardframe.functions.scalar import (
    all_digits,
    bed_utilization,
    guarded_ratio,
    int_or_null,
    parse_work_date,
    two_decimal_text,
    week_weighted,
    zero_if_null,
)

__all__ = [
    "all_digits",
    "bed_utilization",
    "guarded_ratio",
    "int_or_null",
    "parse_work_date",
    "two_decimal_text",
    "week_weighted",
    "zero_if_null",
]
