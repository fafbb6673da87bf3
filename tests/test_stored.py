"""Tables stored for a join without a shuffle, and statistics kept per month."""

import pytest
from pyspark.sql import functions as F

from wardframe.checks import derived
from wardframe.operators import histogram, profile, quantiles
from wardframe.operators.joins import join_dimension
from wardframe.plans import statistics
from wardframe.sources import join_stored, read_stored, store_for_join

SUFFIXES = ("_d", "_f")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def sides(spark):
    """Keys with a third of all days, with a few, without any, and none; a name of both sides."""
    dim = spark.createDataFrame(
        [("hot", "A"), ("hot", "twin"), ("cold", "B"), ("idle", "C"), (None, "N")], "`the key` string, state string"
    )
    keys = ["hot"] * 300 + ["cold"] * 20 + ["stranger"] * 5 + [None] * 40
    return dim, spark.createDataFrame([(k, i // 2, "x") for i, k in enumerate(keys)], "k string, n int, STATE string")


def test_a_stored_join_equals_the_join(spark, sides, tmp_path):
    dim, fact = sides
    store_for_join(dim, fact, "the key", "k", f"{tmp_path}/it's", buckets=4, rows_per_slice=25)
    joined = join_stored(spark, f"{tmp_path}/it's", SUFFIXES)
    wanted = join_dimension(dim, fact, "the key", "k", SUFFIXES)
    assert joined.columns == wanted.columns and joined.dtypes == wanted.dtypes
    assert rows(joined) == rows(wanted) and len(rows(wanted)) == 620
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert [rows(df) for df in read_stored(spark, f"{tmp_path}/it's")] == [rows(dim), rows(fact)]


def test_the_days_of_a_hot_key_lie_in_several_buckets(spark, sides, tmp_path):
    store_for_join(*sides, "the key", "k", f"{tmp_path}/s", buckets=8, rows_per_slice=25)
    stored = spark.read.parquet(f"{tmp_path}/s/fact").withColumn("file", F.input_file_name())
    found = {r.k: r for r in stored.groupBy("k").agg(F.countDistinct("file").alias("files"), F.countDistinct("JOIN_SLICE").alias("slices")).collect()}
    assert found["hot"].slices == 12 and found["hot"].files > 3
    assert found["cold"].slices == 1 and found[None].files > 3
    # One file per bucket at most.
    assert stored.select("file").distinct().count() <= 8


def test_buckets_grow_with_the_tables(spark, sides, tmp_path):
    dim, fact = sides
    store_for_join(dim, fact, "the key", "k", f"{tmp_path}/g", buckets=2, rows_per_slice=5, rows_per_bucket=25)
    assert {r.buckets for r in spark.read.parquet(f"{tmp_path}/g/layout").collect()} == {15}  # 365 days
    assert spark.read.parquet(f"{tmp_path}/g/fact").select(F.input_file_name()).distinct().count() > 8
    joined = join_stored(spark, f"{tmp_path}/g", SUFFIXES)
    assert rows(joined) == rows(join_dimension(dim, fact, "the key", "k", SUFFIXES))
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_stored_tables_without_rows_or_layout(spark, sides, tmp_path):
    dim, fact = sides
    store_for_join(dim.limit(0), fact.limit(0), "the key", "k", f"{tmp_path}/e", buckets=2)
    assert rows(join_stored(spark, f"{tmp_path}/e", SUFFIXES)) == []
    with pytest.raises(Exception, match="layout"):
        join_stored(spark, f"{tmp_path}/none", SUFFIXES)


@pytest.fixture(scope="module")
def days(spark, folder):
    month = F.floor(F.col("WorkDate") / 100).alias("month")
    return derived.fact_raw(spark, folder).select("*", month).cache()


def test_kept_statistics_are_within_their_bounds(days):
    fact = days.drop("month")
    kept = statistics.sketched(days, ["month"]).cache()
    assert kept.count() == len(fact.columns) * days.select("month").distinct().count()
    found = {r.column: r for r in statistics.merged(kept).collect()}
    present = {r["column"]: r.n_present for r in profile.table_info(fact).collect()}
    assert {c: r.n_present for c, r in found.items()} == present
    for c, n in map(tuple, profile.distinct_counts(fact).collect()):
        assert abs(found[c].n_distinct - n) <= -(-n * statistics.DISTINCT_ERROR // 1)
    numbers = ["WorkDate", "MDScensus", "Hrs_RN_emp", "Hrs_RN_ctr"]
    ends = quantiles.column_quantiles(fact, numbers, [0.24, 0.26, 0.49, 0.51, 0.74, 0.76])
    for c, share, value in statistics.merged_quantiles(kept).collect():
        if c in numbers:
            at = 2 * [0.25, 0.5, 0.75].index(share)
            assert ends[c][at] <= value <= ends[c][at + 1]
    exact = {(r["column"], r.bin): r for r in histogram.histogram(fact, numbers, bins=9).collect()}
    drawn = {(r.column, r.bin): r for r in statistics.merged_histogram(kept, bins=9).collect() if r.column in numbers}
    assert drawn.keys() == exact.keys()
    for key, r in drawn.items():
        assert (r.bin_start, r.bin_end) == (exact[key].bin_start, exact[key].bin_end)
        assert abs(r.n - exact[key].n) <= 2 * statistics.RANK_ERROR * present[key[0]]


def test_some_months_and_a_month_written_anew(days):
    columns = ["PROVNUM", "MDScensus"]
    kept = statistics.sketched(days, ["month"], columns)
    some = statistics.merged(kept.filter("month < 199601")).drop("n_distinct")
    whole = statistics.merged(statistics.sketched(days.filter("month < 199601"), [], columns)).drop("n_distinct")
    assert rows(some) == rows(whole) and some.first().n_rows > 0
    march = days.filter("month = 199503")
    fresh = statistics.sketched(march.limit(3), ["month"], columns)
    after = statistics.merged(statistics.replaced(kept, fresh, ["month"])).filter("column = 'PROVNUM'").first()
    assert after.n_rows == days.count() - march.count() + 3


def test_statistics_of_odd_columns(spark):
    schema = "g int, none double, same double, text string, `a.b` int"
    odd = spark.createDataFrame([(1, None, 2.0, "", 1), (None, float("nan"), 2.0, None, None), (1, None, -0.0, "x", 3)], schema)
    kept = statistics.sketched(odd, ["g"])
    found = {r.column: tuple(r)[1:] for r in statistics.merged(kept).collect()}
    assert found["none"] == (3, 0, None, None, 0) and found["same"] == (3, 3, 0.0, 2.0, 2)
    assert found["text"] == (3, 2, None, None, 2) and found["a.b"] == (3, 2, 1.0, 3.0, 2)
    assert rows(statistics.merged_quantiles(kept, [0.5]).filter("column = 'none'")) == []
    assert {r.column for r in statistics.merged_histogram(kept, 2).collect()} == {"same", "a.b"}
    anew = statistics.replaced(kept, statistics.sketched(odd.filter("g IS NULL"), ["g"]), ["g"])
    assert rows(statistics.merged(anew)) == rows(statistics.merged(kept))
    assert statistics.merged_histogram(statistics.sketched(odd.limit(0), ["g"])).count() == 0
    endless = spark.createDataFrame([(float("inf"),)], "v double")
    with pytest.raises(ValueError, match="infinite"):
        statistics.merged_histogram(statistics.sketched(endless, []))


def test_a_pass_sketches_a_few_columns_that_are_projected_first(spark):
    names = [f"c{i}" for i in range(3 * statistics.COLUMNS_PER_PASS - 1)]
    wide = spark.range(40).select((F.col("id") % 2).alias("g"), *[((F.col("id") * i) % 7 + 0.5).alias(n) for i, n in enumerate(names)])
    kept = statistics.sketched(wide, ["g"])
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    plan = kept._jdf.queryExecution().optimizedPlan().toString().splitlines()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    aggregates = [line for line in plan if "Aggregate [" in line]
    assert sum(line.count("hll_sketch_agg(") for line in aggregates) == len(names)
    assert max(line.count("hll_sketch_agg(") for line in aggregates) <= statistics.COLUMNS_PER_PASS
    assert not any("xxhash64" in line or "nullif" in line for line in aggregates)
    assert {(r.g, r.column): r.n_rows for r in kept.collect()} == {(g, n): 20 for g in (0, 1) for n in names}
    found = {r.column: r.n_distinct for r in statistics.merged(kept).collect()}
    assert found == {n: 1 if i % 7 == 0 else 7 for i, n in enumerate(names)}
