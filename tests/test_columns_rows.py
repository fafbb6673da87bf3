import pytest
from pyspark.sql import functions as F

from wardframe.operators import columns as C
from wardframe.operators import rows as R


def test_normalize_names_and_refuse_clashes(spark):
    df = spark.createDataFrame([(1, 2)], "`Provider Name` int, `City/Town` int")
    assert C.normalize_columns(df).columns == ["PROVIDER_NAME", "CITY/TOWN"]
    clash = spark.createDataFrame([(1, 2)], "`x y` int, `X_Y` int")
    with pytest.raises(ValueError, match="X_Y"):
        C.normalize_columns(clash)


def test_drop_ignores_absent_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert C.drop_columns(df, "b", "zzz").columns == ["a"]


def test_columns_by_type(spark):
    df = spark.createDataFrame([(1, 1.0, "x", True)], "i int, d double, s string, b boolean")
    assert C.numeric_columns(df) == ["i", "d"]
    assert C.text_columns(df) == ["s", "b"]


def test_nan_becomes_null_in_floating_columns_only(spark):
    df = spark.createDataFrame(
        [(1, float("nan"), "a"), (None, 2.0, None)], "i int, `d.x` double, s string"
    )
    found = C.nan_to_null(df)
    assert found.schema == df.schema
    assert sorted(map(tuple, found.collect()), key=repr) == [(1, None, "a"), (None, 2.0, None)]


def test_unknown_label(spark):
    assert C.labelled_column("a", {"a": "x"}) == "x"
    with pytest.raises(ValueError, match="unknown label"):
        C.labelled_column("b", {"a": "x"})


def test_guard_on_empty_result(spark):
    df = spark.range(3)
    assert R.require_rows(df) is df
    with pytest.raises(R.NoRows):
        R.require_rows(R.where_equal(df, "id", 9))


def test_first_rows_and_distinct_values(spark):
    df = spark.createDataFrame([(3, "b"), (1, None), (2, "a"), (2, "a")], "k int, s string")
    assert [r.k for r in R.first_rows(df, 2, ["k", "s"]).collect()] == [1, 2]
    assert [r.s for r in R.distinct_values(df, "s").collect()] == [None, "a", "b"]


def test_union_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([(2,)], "k int")
    assert sorted(map(tuple, R.union_parts([a, b]).collect())) == [(1, "x"), (2, None)]


def test_keys_with_other_characters(spark):
    df = spark.createDataFrame([("015",), ("A15",), (None,)], "k string")
    assert [r.k for r in R.non_numeric_keys(df, "k").collect()] == ["A15"]


def test_outside_is_strict(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (0.5,)], "v double")
    assert df.filter(R.outside(F.col("v"), 1.0, 2.0)).count() == 2
