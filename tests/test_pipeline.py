import pytest

from wardframe import schema as S
from wardframe.checks import derived
from wardframe import __main__ as command
from wardframe.plans import gold, metrics, pipeline, profiling, quality, silver
from wardframe.sources import join_path


@pytest.fixture(scope="module")
def bronze(spark, folder, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("bronze"))
    derived.fact_raw(spark, folder).write.option("header", True).csv(join_path(base, S.FACT_FILE))
    derived.dim_raw(spark, folder).write.option("header", True).csv(join_path(base, S.DIM_FILE))
    return base + "/"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_run_equals_the_layers_without_files(spark, folder, bronze, tmp_path):
    tables = pipeline.run_pipeline(
        spark, bronze, f"{tmp_path}/silver", f"{tmp_path}/gold", unique_providers=True
    )
    dim = silver.silver_dim(derived.dim_raw(spark, folder))
    fact = silver.silver_fact(derived.fact_raw(spark, folder))
    assert rows(tables.bed) == rows(gold.dim_bed(dim))
    assert rows(tables.nurse) == rows(gold.dim_nurse(dim))
    assert rows(tables.staff) == rows(gold.fact_staff(fact))
    assert tables.staff.dtypes == gold.fact_staff(fact).dtypes
    card, census = metrics.provider_report(tables.bed, tables.staff, number="000000000001")
    assert card.first().PROVIDER_NUM == "000000000001"
    assert census.count() > 1
    tables.release()


def test_partitioned_work_days_prune(spark, bronze, tmp_path):
    silver_dir, gold_dir = f"{tmp_path}/silver", f"{tmp_path}/gold"
    tables = pipeline.run_pipeline(
        spark, bronze, silver_dir, gold_dir, partition_fact_by=("WORKYEAR", "WORKMONTH")
    )
    year = tables.staff.filter("WORKYEAR = 1997")
    assert year.count() > 0
    plan = year._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(WORKYEAR" in plan


def test_a_failing_step_is_logged_and_raised(spark, tmp_path, caplog):
    with pytest.raises(Exception):
        pipeline.run_pipeline(spark, f"{tmp_path}/none", f"{tmp_path}/s", f"{tmp_path}/g")
    assert "raw to silver: failed" in caplog.text


def test_repeated_providers_stop_the_run(spark, folder, bronze, tmp_path):
    pipeline.to_silver(spark, bronze, f"{tmp_path}/silver")
    dim = spark.read.parquet(f"{tmp_path}/silver/dim_table")
    dim.union(dim).write.parquet(f"{tmp_path}/twice/dim_table")
    with pytest.raises(quality.QualityError):
        pipeline.to_gold_dims(spark, f"{tmp_path}/twice", f"{tmp_path}/gold", unique_providers=True)
    pipeline.to_gold_dims(spark, f"{tmp_path}/twice", f"{tmp_path}/gold")


def test_command_line_steps(spark, bronze, tmp_path, monkeypatch):
    monkeypatch.setattr(command, "build_session", lambda: spark)
    folders = ["--silver", f"{tmp_path}/silver", "--gold", f"{tmp_path}/gold"]
    command.main(["silver", "--bronze", bronze, *folders])
    command.main(["gold-dims", "--unique-providers", *folders])
    command.main(["gold-fact", *folders])
    stepwise = rows(spark.read.parquet(f"{tmp_path}/gold/fact_staff"))
    command.main(["all", "--bronze", bronze, *folders])
    assert rows(spark.read.parquet(f"{tmp_path}/gold/fact_staff")) == stepwise
    for wrong in (["all", *folders], ["gold-fact", "--silver", "s"]):
        with pytest.raises(SystemExit):
            command.main(wrong)


def test_exploration_of_raw_and_written_tables(spark, folder):
    fact, dim = derived.fact_raw(spark, folder), derived.dim_raw(spark, folder)
    found = profiling.profile_fact(fact)
    assert tuple(found["shape"].first()) == (6000, 26)
    assert found["quarters"].first()[0] == "2024Q2"
    assert found["date_histogram"].count() == 231
    assert {r["column"] for r in found["outliers"].collect()} >= {"MDScensus", "Hrs_RN_ctr"}
    assert found["any_missing"].first()[0]
    assert found["duplicate_rows"].count() == 0
    of_dim = profiling.profile_dim(dim)
    assert not of_dim["all_keys_numeric"].first()[0]
    assert of_dim["other_keys"].count() == 2
    assert of_dim["repeated_keys"].count() == 0
    assert [r[0] for r in of_dim["provider_types"].collect()] == sorted(
        ["Medicaid", "Medicare", "Medicare and Medicaid"]
    )
    look = profiling.inspect_table(dim, ["Provider Name"], 3, ["State"])
    assert look["head"].columns == ["State"] and look["head"].count() == 3
    assert look["info"].count() == len(dim.columns)
