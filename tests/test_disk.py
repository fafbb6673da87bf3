"""What queries that write large scratch files leave and hold on disk."""

import datetime
import glob
import os

import pytest

from wardframe import schema as S
from wardframe import session, sources
from wardframe.checks import derived, queries
from wardframe.plans import gold, incremental, silver
from wardframe.sources import Store, versions

SETTING = session.SHUFFLE_CLEANUP


@pytest.fixture
def own_tables(spark, tmp_path):
    """Line items, suppliers and nations of a few hundred rows, some of them twice or without values."""
    folder = f"{tmp_path}/tables"
    day = lambda i: datetime.datetime(1995, 11, 1) + datetime.timedelta(days=i % 90)
    items = [(i // 3, i % 11, float(i % 50), i % 10 / 100, day(i) if i % 31 else None) for i in range(400)]
    items += [*items[:20], (None, None, None, None, None)]
    schema = "l_orderkey long, l_suppkey long, l_quantity double, l_discount double, l_shipdate timestamp"
    spark.createDataFrame(items, schema).write.parquet(f"{folder}/lineitem.parquet")
    suppliers = [(k, f"Supplier#{k:09d}", k % 3, 10.5 * k) for k in range(40)]
    schema = "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"
    spark.createDataFrame(suppliers, schema).write.parquet(f"{folder}/supplier.parquet")
    nations = [(k, f"NATION_{k}", 0) for k in range(3)]
    spark.createDataFrame(nations, "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{folder}/nation.parquet")
    return folder


def shuffle_files(spark):
    """Of all sessions of this process, by the folder that Spark's block manager keeps them in."""
    folders = [str(f) for f in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    return {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}


def test_one_landed_copy_is_on_disk_at_a_time(spark, own_tables, monkeypatch):
    seen, of_folder = [], queries.manifest

    def watched(spark, folder, **options):
        landed = glob.glob(f"{session.shared_dir(spark)}/landed-*/*/*/*.csv")
        seen.append(({p.split("/")[-2] for p in landed}, len([p for p in landed if "/fact/" in p])))
        return of_folder(spark, folder, **options)

    monkeypatch.setattr(queries, "manifest", watched)
    monkeypatch.setattr(queries, "ROWS_PER_FINGERPRINTED_FILE", 20)
    given = set(session._SCRATCH)
    found = {(r.dataset, r["copy"]): r for r in queries.QUERIES["bronze_manifest"](spark, own_tables).collect()}
    assert [copies for copies, _ in seen] == [{"first"}, {"second"}, {"turned"}]
    # 421 rows are more than eight files of 20; all copies have the same ones.
    assert len({n for _, n in seen}) == 1 and seen[0][1] > queries.FINGERPRINTED_FILES
    assert not [p for p in set(session._SCRATCH) - given if "/landed-" in p]
    for table, n in (("fact", 421), ("dim", 40)):
        for copy in ("first", "second", "turned"):
            row = found.pop((table, copy))
            assert (row.source, row.landed, row.n_lines, row.same_bytes, row.same_lines) == (None, True, n, True, True)
            assert row.same_order == (copy != "turned")
    missing = found.pop(("dim", "missing"))
    assert (missing.source, missing.landed, missing.n_lines) == ("providers", False, None) and not found


def test_dealt_work_days_are_the_raw_ones(spark, own_tables):
    plain = derived.fact_raw(spark, own_tables)
    keys = [plain.columns[0], plain.columns[7]]
    dealt = derived.fact_raw_dealt(spark, own_tables, 5, keys)
    assert dealt.schema == plain.schema
    assert sorted(map(tuple, dealt.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    part = "spark_partition_id() AS part"
    wide = plain.repartition(5, *keys).selectExpr("*", part)
    assert sorted(map(repr, wide.collect())) == sorted(map(repr, dealt.selectExpr("*", part).collect()))


def test_writes_release_their_shuffles(spark, tmp_path):
    spark.range(1000).repartition(3, "id").write.parquet(f"{tmp_path}/left")
    before, files = spark.conf.get(SETTING, None), shuffle_files(spark)
    assert files
    with session.shuffles_released(spark):
        spark.range(1000).repartition(3, "id").write.parquet(f"{tmp_path}/t")
    assert shuffle_files(spark) <= files and spark.conf.get(SETTING, None) == before
    with pytest.raises(ZeroDivisionError), session.shuffles_released(spark):
        1 / 0
    assert spark.conf.get(SETTING, None) == before
    assert spark.read.parquet(f"{tmp_path}/t").count() == 1000


def test_one_scratch_path_is_removed(spark):
    kept, gone = (session.scratch_path(spark, n) for n in ("kept", "gone"))
    for path in (kept, gone):
        spark.range(1).write.parquet(path)
    session.remove_scratch(spark, gone)
    assert os.path.isdir(kept) and not os.path.exists(gone) and kept in session._SCRATCH


def landed(df, bronze, name):
    df.write.option("header", True).mode("append").csv(f"{bronze}/{name}")


def in_rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


def test_months_are_dealt_out_in_groups(spark, own_tables, tmp_path, monkeypatch):
    fact, dim = derived.fact_raw(spark, own_tables), derived.dim_raw(spark, own_tables)
    bronze, root, dealt, write = f"{tmp_path}/raw", f"{tmp_path}/published", [], versions.write_table

    def watched(df, path, partition_by=(), *options, **named):
        if partition_by:
            dealt.append((df.columns, df.count(), df.select(*incremental.MONTH).distinct().count()))
        write(df, path, partition_by, *options, **named)

    monkeypatch.setattr(versions, "write_table", watched)
    monkeypatch.setattr(incremental, "DAYS_PER_DEAL", 150)
    landed(dim, bronze, S.DIM_FILE)
    late = "WorkDate >= 19960101 OR WorkDate IS NULL"
    landed(fact.filter(f"NOT ({late})"), bronze, S.FACT_FILE)
    run = incremental.run_incremental(spark, bronze, root)
    assert run.months == [(1995, 11), (1995, 12)] and len(dealt) == 2
    first = Store(spark, root).current().parts("fact_staff")
    # Days of December land late, beside those of January and those without a month.
    landed(fact.filter(late).union(fact.filter("WorkDate = 19951231")), bronze, S.FACT_FILE)
    run = incremental.run_incremental(spark, bronze, root)
    assert run.months == [(None, None), (1995, 12), (1996, 1)] and len(dealt) == 4
    second = Store(spark, root).current().parts("fact_staff")
    assert second["WORKYEAR=1995/WORKMONTH=11"] == first["WORKYEAR=1995/WORKMONTH=11"]
    assert second["WORKYEAR=1995/WORKMONTH=12"] != first["WORKYEAR=1995/WORKMONTH=12"]
    assert all(n <= 150 or months == 1 for _, n, months in dealt)
    # All hours of a kind side by side when dealt out, by role when published.
    hours = [c.rpartition("_")[2] for c in dealt[0][0] if c.startswith("HRS_")]
    assert hours == ["EMP"] * len(S.ROLES) + ["CTR"] * len(S.ROLES)
    assert not [c for columns, _, _ in dealt for c in columns if c.startswith("STAFF_RATIO_") or c == versions.VERSION]
    whole = gold.fact_staff(silver.silver_fact(fact.union(fact.filter("WorkDate = 19951231"))))
    found = incremental.load(spark, root).staff
    assert found.dtypes == whole.dtypes and in_rows(found) == in_rows(whole)


def test_groups_of_months():
    months, n = [(None, None), (2024, 1), (2024, 2), (2024, 3)], incremental.DAYS_PER_DEAL
    deals = incremental._deals(months, {months[0]: 5, months[1]: n - 5, months[2]: 3 * n})
    assert deals == [months[:2], months[2:3], months[3:]]
    assert incremental._deals(months, {}) == [months] and incremental._deals([], {}) == [[]]


def test_partitioned_tables_leave_no_shuffle_files(spark, tmp_path):
    spark.range(1000).repartition(3, "id").write.parquet(f"{tmp_path}/left")
    files = shuffle_files(spark)
    sources.write_table(spark.range(1000).selectExpr("id", "id % 7 AS k"), f"{tmp_path}/t", ["k"])
    assert files and shuffle_files(spark) <= files
    assert spark.read.parquet(f"{tmp_path}/t").groupBy("k").count().count() == 7
