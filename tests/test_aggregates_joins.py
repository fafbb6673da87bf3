"""Null rules of groups, sums, means and joins; both join strategies."""

import pytest
from pyspark.sql import functions as F

from wardframe.operators import aggregates as A
from wardframe.operators import joins as J
from wardframe.plans import metrics


@pytest.fixture(scope="module")
def values(spark):
    return spark.createDataFrame(
        [("b", 1.0), ("a", None), ("a", None), (None, 7.0), ("b", 2.0)], "g string, v double"
    )


def test_sum_drops_null_groups_and_counts_nothing_as_zero(values):
    assert [tuple(r) for r in A.sum_by(values, "g", ["v"]).collect()] == [("a", 0.0), ("b", 3.0)]


def test_mean_of_nothing_is_zero(values):
    assert [tuple(r) for r in A.mean_by(values, "g", "v").collect()] == [("a", 0.0), ("b", 1.5)]


def test_mean_of_group_means_is_unweighted(values):
    assert A.mean_of_group_means(values, "g", "v").first().v == 0.75


def test_summed_together_takes_null_as_zero_on_each_side(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", None, 2.0)], "g string, e double, c double")
    assert [tuple(r) for r in A.summed_together(df, "g", {"x": ["e", "c"]}).collect()] == [("a", 3.0)]


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_null_keys_match_only_if_asked(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    dim = spark.createDataFrame([("x", "s"), (None, "t")], "PROVIDER_NUM string, STATE string")
    fact = spark.createDataFrame([("x", "u"), (None, "v")], "PROVNUM string, STATE string")
    plain = metrics.provider_frame(dim, fact)
    assert plain.columns == ["PROVIDER_NUM", "STATE_bed", "PROVNUM", "STATE_staff"]
    assert [tuple(r) for r in plain.collect()] == [("x", "s", "x", "u")]
    assert metrics.provider_frame(dim, fact, null_safe=True).count() == 2
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeated_provider_multiplies_its_days(spark):
    hours = ", ".join(f"{h} double" for pair in metrics.ROLE_HOURS.values() for h in pair)
    dim = spark.createDataFrame(
        [("x", "T", "s"), ("x", "T", "s"), ("y", "U", "s"), ("z", "T", None)],
        "PROVIDER_NUM string, PROVIDER_TYPE string, STATE string",
    )
    fact = spark.createDataFrame(
        [("x", *[1.0] * 16), ("x", *[None] * 16), ("y", *[9.0] * 16), ("z", *[5.0] * 16)],
        f"PROVNUM string, {hours}",
    )
    found = metrics.staff_hours_by_state(dim, fact, "T").collect()
    assert [tuple(r) for r in found] == [("s", *[4.0] * 8)]


def test_names_that_differ_in_case_clash(spark):
    dim = spark.createDataFrame([("x", "s")], "PROVIDER_NUM string, state string")
    fact = spark.createDataFrame([("x", "u")], "PROVNUM string, STATE string")
    joined = metrics.provider_frame(dim, fact)
    assert joined.columns == ["PROVIDER_NUM", "state_bed", "PROVNUM", "STATE_staff"]
    assert [tuple(r) for r in joined.collect()] == [("x", "s", "x", "u")]


def test_no_job_runs_while_frames_are_built(spark, folder):
    from wardframe.checks.queries import QUERIES

    spark.sparkContext.setJobGroup("building", "frames")
    for name in ("provider_join", "staff_hours_by_state", "repeated_rows", "duplicate_rows"):
        QUERIES[name](spark, folder)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("tests", "other")
    # Reading a Parquet footer for its schema is all there is.
    assert len(jobs) <= 4 * 4


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_large_dimension_is_shuffled_and_its_hot_key_split(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        dim = spark.range(1000).select(F.col("id").cast("string").alias("PROVIDER_NUM"))
        key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).cast("string")
        fact = spark.range(0, 200_000, 1, 16).select(key.alias("PROVNUM"), "id")
        joined = metrics.provider_frame(dim, fact)
        assert "SortMergeJoin(skew=true) [PROVNUM" in plan_of(joined)  # streams the fact
        assert joined.count() == 200_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_lookup_reaches_the_scan_of_both_tables(spark, tmp_path):
    bed = spark.createDataFrame(
        [("1", "n", "T", "s")],
        "PROVIDER_NUM string, PROVIDER_NAME string, PROVIDER_TYPE string, STATE string",
    )
    days = spark.createDataFrame(
        [("1", "c", "s", 5, "d")],
        "PROVNUM string, CITY string, STATE string, MDSCENSUS int, WORKDATE string",
    )
    bed.write.parquet(f"{tmp_path}/bed")
    days.write.parquet(f"{tmp_path}/days")
    census = metrics.daily_census(
        metrics.provider_days(
            spark.read.parquet(f"{tmp_path}/bed"), spark.read.parquet(f"{tmp_path}/days"), "1"
        )
    )
    plan = plan_of(census)
    assert "EqualTo(PROVIDER_NUM,1)" in plan
    assert "EqualTo(PROVNUM,1)" in plan
    assert "ReadSchema: struct<PROVNUM:string,MDSCENSUS:int,WORKDATE:string>" in plan


def test_provider_lookup_needs_one_of_number_and_name(spark):
    with pytest.raises(ValueError):
        metrics.provider_days(spark.range(1), spark.range(1))
