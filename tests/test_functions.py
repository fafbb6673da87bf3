"""Formulas, case by case."""

import datetime

import pytest
from pyspark.sql import functions as F

from wardframe import functions as W


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def dbl(value):
    return F.lit(value).cast("double")


@pytest.mark.parametrize(
    "employee, contractor, expected",
    [
        (1.0, 0.0, 10000.0),
        (1.0, 0.0009, 10000.0),
        (1.0, -5.0, 10000.0),
        (None, 0.0, 10000.0),
        (1.0, None, None),
        (None, 2.0, None),
        (3.0, 2.0, 1.5),
        (1.0, 0.001, 1000.0),
        (2.0, 3.0, 0.67),
    ],
)
def test_guarded_ratio(spark, employee, contractor, expected):
    assert one(spark, W.guarded_ratio(dbl(employee), dbl(contractor))) == expected


@pytest.mark.parametrize(
    "residents, beds, expected",
    [(150.0, 100, 150.0), (5.0, 0, 0.0), (5.0, None, None), (1.0, 3, 33.33), (0.0, 10, 0.0)],
)
def test_bed_utilization(spark, residents, beds, expected):
    assert one(spark, W.bed_utilization(dbl(residents), F.lit(beds).cast("int"))) == expected


def test_week_weighted(spark):
    assert one(spark, W.week_weighted(dbl(2.0), dbl(1.0))) == 1.71


@pytest.mark.parametrize(
    "tie, expected", [(1.005, 1.01), (0.285, 0.29), (0.125, 0.13), (2.675, 2.68), (-0.125, -0.13)]
)
def test_ties_round_half_up_on_the_decimal_text(spark, tie, expected):
    assert one(spark, W.guarded_ratio(dbl(tie), dbl(1.0))) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [
        (20240401, datetime.date(2024, 4, 1)),
        ("20240229", datetime.date(2024, 2, 29)),
        ("20230229", None),
        ("2024xx01", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_work_date(spark, raw, expected):
    value = F.lit(raw) if raw is not None else F.lit(None).cast("int")
    assert one(spark, W.parse_work_date(value)) == expected


@pytest.mark.parametrize(
    "text, expected",
    [("015009", True), ("01A009", False), ("", False), ("½", True), ("1 2", False), (None, None)],
)
def test_all_digits(spark, text, expected):
    assert one(spark, W.all_digits(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize("raw, expected", [("1.5", 1.5), ("", 0.0), (None, 0.0), ("x", 0.0)])
def test_zero_if_null_on_text(spark, raw, expected):
    assert one(spark, W.zero_if_null(F.lit(raw).cast("string"))) == expected


def test_display_helpers(spark):
    assert one(spark, W.two_decimal_text(dbl(2.0))) == "2.00"
    assert one(spark, W.int_or_null(F.lit("x"))) is None
    assert one(spark, W.int_or_null(dbl(85.0))) == 85
