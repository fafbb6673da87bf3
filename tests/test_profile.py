"""Statistics against NumPy and pandas on the same values."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardframe.operators import duplicates as D
from wardframe.operators import histogram as H
from wardframe.operators import profile as P
from wardframe.operators import quantiles as Q

NAN = float("nan")


def long(spark, values, column="v"):
    return spark.createDataFrame([(v,) for v in values], f"{column} double")


@pytest.mark.parametrize("limit, accuracy", [(1_000_000, 2000), (5, 10), (1, 4)])
@pytest.mark.parametrize(
    "values",
    [
        [3.0, 1.0, 2.0],
        [1.0],
        [5.0] * 40 + [6.0, 7.0],
        [1e-9, 1e9, -1e9, 0.0, 1e300, -1e300, 4.0, 4.0, 4.5] * 3,
        [None, NAN, 2.0, 8.0],
        list(np.random.default_rng(7).lognormal(0, 4, 500)),
    ],
)
def test_quantiles_are_exact_however_often_they_narrow(spark, values, limit, accuracy):
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    df = long(spark, [None if v is None else float(v) for v in values]).repartition(3)
    found = Q.column_quantiles(df, ["v"], probabilities, limit=limit, accuracy=accuracy)["v"]
    known = [v for v in values if v is not None and not math.isnan(v)]
    assert found == pytest.approx(list(np.quantile(known, probabilities)), rel=1e-12)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False, width=32), min_size=1, max_size=60))
def test_quantiles_of_any_values(spark, values):
    df = long(spark, [float(v) for v in values])
    found = Q.column_quantiles(df, ["v"], Q.QUARTILES, limit=4, accuracy=5)["v"]
    assert found == pytest.approx(list(np.quantile(values, Q.QUARTILES)), rel=1e-9, abs=1e-9)


def test_quantiles_of_several_columns_and_of_nothing(spark):
    df = spark.range(1, 2001).select(
        "id", (F.col("id") % 7).alias("m"), F.lit(None).cast("double").alias("none")
    )
    rows = Q.quantiles(df, limit=50, accuracy=40).collect()
    found = {(r["column"], r.probability): r["value"] for r in rows}
    pdf = df.toPandas()
    assert found["id", 0.25] == pdf.id.quantile(0.25)
    assert found["id", 0.75] == pdf.id.quantile(0.75)
    assert found["m", 0.75] == pdf.m.quantile(0.75)
    assert found["none", 0.25] is None


@pytest.mark.parametrize("limit", [1, 50, 1_000_000])
@pytest.mark.parametrize("endless", [float("inf"), -float("inf")])
def test_infinite_values_are_refused_at_any_size(spark, limit, endless):
    df = long(spark, [1.0, 2.0, endless] + [float(i) for i in range(200)])
    with pytest.raises(ValueError, match="infinite"):
        Q.column_quantiles(df, ["v"], [0.5], limit=limit)
    with pytest.raises(Exception, match="infinite"):
        H.histogram(df, ["v"], 10).collect()


@pytest.mark.parametrize(
    "values",
    [
        10.0 ** np.random.default_rng(1).uniform(-150, 150, 20_000),
        np.random.default_rng(2).uniform(0, 1, 20_000),
        np.concatenate([np.full(12_000, 3.0), np.random.default_rng(3).lognormal(0, 9, 8_000)]),
    ],
)
def test_rounds_follow_the_number_of_values_only(spark, values, monkeypatch):
    rounds = []
    narrow = Q._narrow
    monkeypatch.setattr(Q, "_narrow", lambda *args: rounds.append(1) or narrow(*args))
    df = long(spark, [float(v) for v in values])
    found = Q.column_quantiles(df, ["v"], Q.QUARTILES, limit=100)["v"]
    assert found == pytest.approx(list(np.quantile(values, Q.QUARTILES)), rel=1e-12)
    assert len(rounds) <= 2


def test_cuts_lie_around_the_wanted_ranks_without_stacking(spark, monkeypatch):
    def refused(*args):
        raise AssertionError("values were stacked")

    monkeypatch.setattr(Q, "_bracketed", refused)
    df = spark.range(20_000).select(F.col("id").alias("a"), (F.col("id") * 2.0).alias("b")).repartition(5)
    brackets = [Q.Bracket("a", 0.0, 19_999.0, 0, 20_000), Q.Bracket("b", 10_000.0, 20_000.0, 5_000, 5_001)]
    cuts = Q._cuts(df, brackets, {0: {5_000}, 1: {100, 4_000}}, 200)
    assert [len(c) for c in cuts] == [2, 4]
    assert cuts[0][0] <= 5_000 <= cuts[0][1] and cuts[0][1] - cuts[0][0] < 800
    below, above, low, high = cuts[1]
    assert 10_000 <= below <= 10_200 <= above <= 11_000 and 17_000 <= low <= 18_000 <= high <= 19_000


def test_an_empty_list_means_no_column(spark):
    df = long(spark, [1.0])
    assert P.null_counts(df, ["v"]).count() == 1
    assert Q.column_quantiles(df, [], Q.QUARTILES) == {}
    assert Q.outlier_flags(df, []).collect() == df.collect()


def test_outliers_match_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.normal(size=300), "b": rng.lognormal(size=300), "s": "x"})
    pdf.loc[5, "a"] = None
    pdf.loc[6, "b"] = 1e6
    df = spark.createDataFrame(pdf)
    numbers = pdf[["a", "b"]]
    q1, q3 = numbers.quantile(0.25), numbers.quantile(0.75)
    mask = (numbers < q1 - 1.5 * (q3 - q1)) | (numbers > q3 + 1.5 * (q3 - q1))
    counts = {r["column"]: r.n_outliers for r in Q.outlier_counts(df).collect()}
    assert counts == mask.sum().to_dict()
    flags = Q.outlier_flags(df)
    assert flags.columns == ["a", "b", "s"]
    assert flags.filter("a").count() == mask.a.sum()
    assert flags.filter("a IS NULL").count() == 0


@pytest.mark.parametrize("bins", [1, 7, 46, 50, 231])
@pytest.mark.parametrize(
    "values",
    [
        list(np.round(np.random.default_rng(1).uniform(0, 0.1, 300), 2)),
        list(np.random.default_rng(2).lognormal(0, 2, 300)),
        [20240401.0 + i for i in range(91)],
        [4.0] * 5,
        [None, NAN, 0.0, 1.0],
    ],
)
def test_histogram_matches_numpy(spark, values, bins):
    df = long(spark, [None if v is None else float(v) for v in values])
    found = sorted(H.histogram(df, ["v"], bins).collect(), key=lambda r: r.bin)
    known = [v for v in values if v is not None and not math.isnan(v)]
    counts, edges = np.histogram(known, bins)
    assert [r.n for r in found] == list(counts)
    assert [r.bin_start for r in found] == pytest.approx(list(edges[:-1]), rel=1e-12)
    assert found[-1].bin_end == edges[-1]


def test_histogram_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert [(r.bin_start, r.bin_end, r.n) for r in H.histogram(df, ["v"], 1).collect()] == [(0, 1, 0)]


@pytest.fixture(scope="module")
def gaps(spark):
    return spark.createDataFrame(
        [(1, "a", NAN), (None, "a", 1.0), (3, None, None), (3, "b", 1.0)],
        "i int, s string, d double",
    )


def test_missing_values(gaps):
    assert {r["column"]: r.n_missing for r in P.null_counts(gaps).collect()} == {
        "i": 1,
        "s": 1,
        "d": 2,
    }
    assert P.any_missing(gaps).first().any_missing
    assert not P.any_missing(gaps.filter("i = 3 AND s = 'b'")).first().any_missing
    assert not P.any_missing(gaps.filter("i = 99")).first().any_missing


def test_counts_and_info(gaps):
    assert {r["column"]: r.n_distinct for r in P.distinct_counts(gaps, ["i", "s"]).collect()} == {
        "i": 2,
        "s": 2,
    }
    assert P.distinct_counts(gaps, ["i"], approximate=True).first().n_distinct == 2
    for approximate in (False, True):  # a NaN is missing, and an empty table has 0 of each
        assert P.distinct_counts(gaps, ["d"], approximate).first().n_distinct == 1
        nothing = P.distinct_counts(gaps.limit(0), approximate=approximate).collect()
        assert [r.n_distinct for r in nothing] == [0, 0, 0]
    assert tuple(P.table_shape(gaps).first()) == (4, 3)
    assert tuple(P.value_range(gaps, "i").first()) == (1, 3)
    assert [(r["column"], r.type, r.n_present) for r in P.table_info(gaps).collect()] == [
        ("i", "int", 3),
        ("s", "string", 3),
        ("d", "double", 2),
    ]


def test_all_keys_numeric(spark):
    df = spark.createDataFrame([("12",), ("3",)], "k string")
    assert P.all_keys_numeric(df, "k").first().all_numeric
    assert P.all_keys_numeric(df.limit(0), "k").first().all_numeric


def hot(spark, n=3000):
    """Rows of which a third are one and the same."""
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
    return spark.range(0, n, 1, 8).select(
        key.alias("k"), F.when(F.col("id") % 3 != 0, key.cast("string")).alias("s")
    )


def test_copies_of_a_hot_row(spark):
    df = hot(spark).union(spark.createDataFrame([(5, "x"), (5, "x"), (5, "y")], "k long, s string"))
    found = sorted(map(tuple, D.repeated_rows(df).collect()))
    assert found == [(-1, None, 1000), (5, "x", 2)]
    copies = D.extra_copies(df, block=64)
    assert copies.columns == df.columns
    pdf = df.toPandas()
    assert copies.count() == pdf.duplicated().sum()
    assert copies.filter("k = -1").count() == 999


def test_copies_of_a_hot_row_are_spread_over_tasks(spark):
    per_task = (
        D.extra_copies(hot(spark, 12_000), block=50)
        .groupBy(F.spark_partition_id().alias("task"))
        .count()
        .collect()
    )
    assert len(per_task) > 1
    assert max(r["count"] for r in per_task) < 0.75 * sum(r["count"] for r in per_task)


def test_rows_are_not_sorted_to_find_repeated_ones(spark):
    """Also for a table beyond the broadcast threshold."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(0, 2000, 1, 4).selectExpr("id % 1990 AS k", "concat('text ', id % 1990) AS s")
        found = D.repeated_rows(df)
        assert sorted(map(tuple, found.collect())) == [(i, f"text {i}", 2) for i in range(10)]
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeated_keys_take_null_as_a_value(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, None), (2, 3)], "a int, b int")
    assert [tuple(r) for r in D.repeated_keys(df, ["a", "b"]).collect()] == [(None, 1, 2)]
    assert D.has_repeated_keys(df, ["a"]).first().has_duplicates
    assert not D.has_repeated_rows(df.filter("a = 2")).first().has_duplicates
    assert D.has_repeated_rows(df).first().has_duplicates


def test_an_exploration_reads_the_table_a_few_times(spark, folder):
    from wardframe.checks import derived
    from wardframe.plans import profiling

    raw = derived.fact_raw(spark, folder)
    n_rows, seen = raw.count(), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    counted = raw.mapInArrow(count, raw.schema)
    frames = profiling.profile_fact(counted)
    for df in frames.values():
        df.collect()
    # One for the summary, two for the quartiles, two for repeated rows, one for each other frame.
    assert seen.value <= 10 * n_rows


def test_distinct_counts_scan_once_whatever_the_types(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "a", [1], b"x"), (1, -0.0, None, [1], b"y"), (2, 0.0, "a", None, b"x"), (2, NAN, "b", [2], b"x")],
        "i int, d double, s string, a array<int>, b binary",
    )
    found = P.distinct_counts(df)
    assert {r["column"]: r.n_distinct for r in found.collect()} == {"i": 2, "d": 2, "s": 2, "a": 2, "b": 2}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LocalRelation") + plan.count("LogicalRDD") == 1


def test_a_partitioned_table_is_few_files(spark, tmp_path):
    from wardframe.sources import write_table

    df = spark.range(0, 8000, 1, 8).selectExpr("id", "id % 40 AS month")
    write_table(df, f"{tmp_path}/t", partition_by=["month"])
    files = list((tmp_path / "t").rglob("*.parquet"))
    assert len(files) <= 2 * 40
    assert spark.read.parquet(f"{tmp_path}/t").count() == 8000
