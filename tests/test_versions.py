"""Tables published together, runs over changed files alone, and parts whose types drifted."""

import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardframe import schema as S
from wardframe import sources
from wardframe.checks import derived
from wardframe.plans import gold, incremental, silver
from wardframe.sources import Publication, Store, tables


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def frame(spark, values, schema="k int, v string"):
    return spark.createDataFrame(values, schema)


def test_tables_become_visible_together(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/p")
    assert store.current().tables == {}
    first = Publication(store)
    first.write("a", frame(spark, [(1, "x")]))
    first.write("b", frame(spark, [(1, "y")]))
    with pytest.raises(KeyError):
        store.read("a")
    first.commit()
    second = Publication(store)
    second.write("a", frame(spark, [(2, "x")]))
    assert rows(store.read("a")) == [(1, "x")]
    second.write("b", frame(spark, [(2, "y")]))
    before = store.current()
    second.commit()
    assert rows(store.read("a")) == [(2, "x")] and rows(store.read("b")) == [(2, "y")]
    # A reader that holds a commit goes on with both of its tables.
    assert rows(store.read("a", before)) == [(1, "x")] and rows(store.read("b", before)) == [(1, "y")]


def test_a_run_that_dies_between_two_tables_changes_nothing(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/p")
    first = Publication(store)
    for name in ("a", "b"):
        first.write(name, frame(spark, [(1, name)]))
    first.commit()
    dying = Publication(store)
    dying.write("a", frame(spark, [(9, "a")]))
    broken = frame(spark, [(9, "b")]).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        dying.write("b", broken)
    assert rows(store.read("a")) == [(1, "a")] and rows(store.read("b")) == [(1, "b")]
    assert sources.remove_unpublished(store) >= 1
    assert rows(store.read("a")) == [(1, "a")] and rows(store.read("b")) == [(1, "b")]
    assert len(os.listdir(tmp_path / "p" / "a")) == 1


def test_two_runs_at_once(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/p")
    one, other = Publication(store), Publication(store)
    one.write("a", frame(spark, [(1, "one")]))
    other.write("a", frame(spark, [(1, "other")]))
    one.commit()
    with pytest.raises(sources.ConflictError):
        other.commit()
    assert rows(store.read("a")) == [(1, "one")]
    assert [n for n in os.listdir(tmp_path / "p" / "commits") if n.endswith(".json")] == ["000000000001.json"]


def test_partitions_are_kept_replaced_and_added(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/p")
    run = Publication(store)
    run.write("t", frame(spark, [(1, "a"), (2, "b"), (None, "n")]), ["k"])
    run.commit()
    run = Publication(store)
    parts = run.write("t", frame(spark, [(2, "c")]), ["k"], keep=lambda p: p != "k=2")
    assert parts == ["k=1", "k=2", "k=__HIVE_DEFAULT_PARTITION__"]
    run.commit()
    assert rows(store.read("t")) == [(1, "a"), (2, "c"), (None, "n")]
    assert store.read("t").dtypes == [("k", "int"), ("v", "string")]
    run = Publication(store)
    run.write("t", frame(spark, [(2, "d"), (3, "e")]), ["k"], add=True)
    run.commit()
    assert rows(store.read("t")) == [(1, "a"), (2, "c"), (2, "d"), (3, "e"), (None, "n")]
    run = Publication(store)
    run.write("t", frame(spark, []), ["k"])
    run.write("u", frame(spark, []))
    run.commit()
    assert rows(store.read("t")) == [] and rows(store.read("u")) == []
    assert sources.remove_unpublished(store, keep=2) > 0
    assert rows(store.read("t", store.at(3))) == [(1, "a"), (2, "c"), (2, "d"), (3, "e"), (None, "n")]


@pytest.fixture(scope="module")
def raw(spark, folder):
    fact = derived.fact_raw(spark, folder).filter("WorkDate < 19970101").cache()
    return fact, derived.dim_raw(spark, folder).cache()


def land(df, bronze, name, file):
    """One raw file with a name of its own."""
    path = f"{bronze}/{name}"
    os.makedirs(path, exist_ok=True)
    df.toPandas().to_csv(f"{path}/{file}", index=False)
    later = time.time() + len(os.listdir(path))
    os.utime(f"{path}/{file}", (later, later))


def published(spark, root):
    found = incremental.load(spark, root)
    return [rows(found.bed), rows(found.nurse), rows(found.staff.select(sorted(found.staff.columns)))]


def whole(fact, dim):
    staff = gold.fact_staff(silver.silver_fact(fact))
    clean = silver.silver_dim(dim)
    return [rows(gold.dim_bed(clean)), rows(gold.dim_nurse(clean)), rows(staff.select(sorted(staff.columns)))]


def as_read(fact):
    """Without a column of whole numbers with gaps, which pandas would write as doubles."""
    return fact.withColumn("MDScensus", F.lit(None).cast("int"))


def without_whole_numbers(dim):
    whole = [f.name for f in dim.schema if isinstance(f.dataType, T.IntegerType)]
    return dim.withColumns({c: F.lit(None).cast("int") for c in whole})


def test_runs_over_changed_files_equal_whole_runs(spark, raw, tmp_path):
    bronze, root = f"{tmp_path}/raw", f"{tmp_path}/published"
    fact, dim = as_read(raw[0]), without_whole_numbers(raw[1])
    old, march = fact.filter("WorkDate < 19950301"), fact.filter("WorkDate BETWEEN 19950301 AND 19950331")
    new = fact.filter("WorkDate >= 19960601")
    land(dim, bronze, S.DIM_FILE, "p.csv")
    land(old, bronze, S.FACT_FILE, "a.csv")
    land(march, bronze, S.FACT_FILE, "b.csv")
    run = incremental.run_incremental(spark, bronze, root)
    assert (run.read, run.gone, run.commit) == (3, 0, 1) and (1995, 3) in run.months
    assert published(spark, root) == whole(old.union(march), dim)

    assert incremental.run_incremental(spark, bronze, root) == incremental.Run(0, 0, [], 1)

    before = Store(spark, root).current()
    land(new, bronze, S.FACT_FILE, "c d.csv")
    run = incremental.run_incremental(spark, bronze, root)
    assert run.read == 1 and run.months == sorted({(d // 10000, d // 100 % 100) for (d,) in new.select("WorkDate").distinct().collect()})
    assert published(spark, root) == whole(old.union(march).union(new), dim)
    # Months that no new file touches are the folders they were, and so are the dimensions.
    after = Store(spark, root).current()
    kept = before.parts("fact_staff")
    assert {p: after.parts("fact_staff")[p] for p in kept} == kept
    assert after.parts("dim_bed") == before.parts("dim_bed")

    # A changed file: some days leave March, others arrive in April 1995.
    changed = fact.filter("WorkDate BETWEEN 19950315 AND 19950420")
    land(changed, bronze, S.FACT_FILE, "b.csv")
    run = incremental.run_incremental(spark, bronze, root)
    assert run.months == [(1995, 3), (1995, 4)]
    assert published(spark, root) == whole(old.union(changed).union(new), dim)

    os.remove(f"{bronze}/{S.FACT_FILE}/a.csv")
    land(dim.limit(4), bronze, S.DIM_FILE, "p.csv")
    run = incremental.run_incremental(spark, bronze, root)
    assert (run.read, run.gone) == (1, 1)
    found = published(spark, root)
    assert found[2] == whole(changed.union(new), dim)[2] and len(found[0]) == 4


def test_a_failing_rerun_leaves_the_tables(spark, raw, tmp_path):
    bronze, root = f"{tmp_path}/raw", f"{tmp_path}/published"
    land(raw[1].limit(5), bronze, S.DIM_FILE, "p.csv")
    land(as_read(raw[0]).limit(50), bronze, S.FACT_FILE, "a.csv")
    incremental.run_incremental(spark, bronze, root)
    before = published(spark, root)
    with open(f"{bronze}/{S.FACT_FILE}/bad.csv", "w") as file:
        file.write("PROVNUM,other header\n1,2\n")
    with pytest.raises(Exception):
        incremental.run_incremental(spark, bronze, root)
    assert published(spark, root) == before


def test_parts_get_the_narrowest_common_type(spark, tmp_path):
    kinds = {"a": "int", "b": "bigint", "c": "double", "d": "smallint"}
    for name, kind in kinds.items():
        spark.sql(f"SELECT CAST(7 AS {kind}) AS n, '{name}' AS s").write.parquet(f"{tmp_path}/{name}")
    read = lambda *names: sources.read_parts(spark, [f"{tmp_path}/{n}" for n in names])
    assert read("a", "b").dtypes == [("n", "bigint"), ("s", "string")]
    assert read("a", "d").dtypes[0] == ("n", "int")
    mixed = read(*kinds)
    assert mixed.dtypes[0] == ("n", "double") and rows(mixed) == [(7.0, n) for n in "abcd"]
    spark.sql("SELECT 'x' AS N, 'e' AS extra").write.parquet(f"{tmp_path}/e")
    with pytest.raises(TypeError, match="column n is int in .*/a/.* and string in .*/e/"):
        read("a", "e")
    spark.sql("SELECT DATE'2024-01-01' AS d").write.parquet(f"{tmp_path}/f")
    spark.sql("SELECT TIMESTAMP'2024-01-01 10:00:00' AS d, 1 AS n").write.parquet(f"{tmp_path}/g")
    assert dict(read("f", "g").dtypes) == {"d": "timestamp", "n": "int"}


@pytest.mark.parametrize(
    ("one", "other", "common"),
    [
        (T.DecimalType(5, 2), T.IntegerType(), T.DecimalType(12, 2)),
        (T.DecimalType(5, 2), T.DecimalType(4, 3), T.DecimalType(6, 3)),
        (T.DecimalType(38, 0), T.DecimalType(38, 10), None),
        (T.FloatType(), T.FloatType(), T.FloatType()),
        (T.FloatType(), T.LongType(), T.DoubleType()),
        (T.NullType(), T.StringType(), T.StringType()),
        (T.StringType(), T.IntegerType(), None),
        (T.BooleanType(), T.IntegerType(), None),
    ],
)
def test_common_types(one, other, common):
    assert tables.common_type(one, other) == tables.common_type(other, one) == common


def test_the_filter_of_months_is_one_lookup(spark):
    months = [(year, month) for year in range(1992, 1999) for month in range(1, 13)]
    assert str(incremental._any_month(months)).count("WORKYEAR") == 1
    days = spark.createDataFrame([(1992, 12), (1993, 0), (1993, 1), (None, None), (1993, None)], "WORKYEAR int, WORKMONTH int")
    found = lambda wanted: sorted(map(tuple, days.filter(incremental._any_month(wanted)).collect()), key=repr)
    assert found([(1992, 12)]) == [(1992, 12)]
    assert found([(1993, 1), (None, None)]) == [(1993, 1), (None, None)]
    assert found([(1993, None)]) == [(1993, None)] and found([]) == []
