"""CSV edge cases, Parquet parts, and the audit of raw files."""

import re

import duckdb
import pytest
from pyspark.sql import types as T

from wardframe import sources
from wardframe.session import scratch_path, shared_dir


def typed(**types):
    return lambda name: types.get(name, T.StringType())


@pytest.fixture
def write(tmp_path):
    def put(name, content, encoding="utf-8"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content.encode(encoding))
        return str(path)

    return put


def test_declared_types_follow_names_not_positions(spark, write):
    path = write("a.csv", "n,key\n1.5,015009\n,A1\n")
    df = sources.read_csv(spark, path, typed(n=T.DoubleType()))
    assert [tuple(r) for r in df.collect()] == [(1.5, "015009"), (None, "A1")]


def test_values_that_do_not_fit_become_null_and_are_shown(spark, write):
    path = write("a.csv", "k,n\na,1\nb,x1\n")
    df = sources.read_csv(spark, path, typed(n=T.IntegerType()), rejects="bad").cache()
    assert sorted(map(tuple, df.collect())) == [("a", 1, None), ("b", None, "b,x1")]


def test_null_marker(spark, write):
    path = write("a.csv", "k,n\na,NA\n")
    df = sources.read_csv(spark, path, typed(n=T.IntegerType()), null_value="NA", rejects="bad")
    assert [tuple(r) for r in df.collect()] == [("a", None, None)]


def test_folder_with_differing_headers_is_refused(spark, write, tmp_path):
    write("d/a.csv", "k,n\na,1\n")
    write("d/b.csv", "n,k\n1,a\n")
    for rejects in (None, "bad"):
        df = sources.read_csv(spark, f"{tmp_path}/d", typed(n=T.IntegerType()), rejects=rejects)
        with pytest.raises(Exception, match="header"):
            df.collect()


def test_inference_keeps_keys_as_text(spark, write):
    path = write("a.csv", "key,n,blank\n015009,1,\n015010,2,\n")
    df = sources.read_csv_inferred(spark, path, ["KEY"])
    assert df.dtypes == [("key", "string"), ("n", "int"), ("blank", "string")]
    assert df.first().key == "015009"


@pytest.mark.parametrize("read", ["declared", "inferred"])
def test_windows_charset(spark, write, read):
    path = write("a.csv", "k,s\n1,café –\n", "cp1252")
    if read == "declared":
        df = sources.read_csv(spark, path, typed(), encoding="windows-1252")
    else:
        df = sources.read_csv_inferred(spark, path, encoding="windows-1252")
    assert df.first().s == "café –"


def test_header_in_another_charset_or_with_a_mark(spark, write):
    path = write("a.csv", "clé,\"x, y\"\né,1\n", "cp1252")
    df = sources.read_csv(spark, path, typed(**{"x, y": T.IntegerType()}), encoding="windows-1252")
    assert df.columns == ["clé", "x, y"] and tuple(df.first()) == ("é", 1)
    marked = write("b.csv", "\ufeffk,n\na,1\n")
    assert sources.read_csv(spark, marked, typed()).columns == ["k", "n"]


def test_duplicate_headers(spark, write):
    path = write("a.csv", "﻿a,A,b,a\n1,2,3,4\n")
    assert sources.header_names(spark, path) == ["a", "A", "b", "a"]
    found = sources.duplicate_headers(spark, path).collect()
    assert [tuple(r)[1:] for r in found] == [("a", 3, 0)]
    assert sources.header_names(spark, write("empty.csv", "")) == []


def test_duplicate_headers_of_every_file_in_its_charset(spark, write, tmp_path):
    write("d/a.csv", "a,b\n1,2\n", "cp1252")
    write("d/b.csv", "a,A\n1,2\n", "cp1252")
    write("d/c.csv", "x,café,CAFÉ\n1,2,3\n", "cp1252")
    found = sources.duplicate_headers(spark, f"{tmp_path}/d", encoding="windows-1252").collect()
    names = sorted((r.file[-5:], r.name, r.first_position) for r in found)
    assert names == [("b.csv", "a", 0), ("c.csv", "café", 1)]
    assert sources.header_names(spark, f"{tmp_path}/d/c.csv", "cp1252") == ["x", "café", "CAFÉ"]


def test_rejects_do_not_depend_on_the_columns_used(spark, write):
    path = write("a.csv", "s,n,m\na,1,2\nb,x,3\nc,4,y\n")
    kinds = typed(n=T.IntegerType(), m=T.IntegerType())
    df = sources.read_csv(spark, path, kinds, rejects="bad")
    assert df.select("s", "bad").filter("bad IS NOT NULL").count() == 2
    assert tuple(df.selectExpr("count(*)", "count(bad)", "count(s)").first()) == (3, 2, 3)
    assert [r.bad for r in df.select("bad").collect()] == [None, "b,x,3", "c,4,y"]


def test_missing_tokens_in_every_column(spark, write):
    path = write("a.csv", "s,n\nNA,1\nnull,N/A\nx,NaN\n")
    df = sources.read_csv(spark, path, typed(n=T.DoubleType()), rejects="bad", missing=sources.MISSING_TOKENS)
    assert [tuple(r) for r in df.collect()] == [(None, 1.0, None), (None, None, None), ("x", None, None)]


def test_records_that_span_lines(spark, write, tmp_path):
    path = write("m/a.csv", 's,n\n"x\ny",1\n"a ""q""\n\n,b",2\n')
    df = sources.read_csv(spark, path, typed(n=T.IntegerType()), multi_line=True)
    assert [tuple(r) for r in df.collect()] == [("x\ny", 1), ('a "q"\n\n,b', 2)]
    with pytest.raises(Exception, match="span lines"):
        sources.sweep_csv(spark, f"{tmp_path}/m").collect()
    assert sources.sweep_csv(spark, f"{tmp_path}/m", multi_line=True).first().n_rows == 2


def test_unknown_charsets_are_refused(spark, write):
    path = write("a.csv", "k\n1\n")
    for name in ("no-such-charset", "shift_jis"):
        with pytest.raises(ValueError, match="charset"):
            sources.read_csv(spark, path, typed(), encoding=name)


def test_the_head_of_a_file_takes_no_sort(spark, write, tmp_path):
    write("h/a.csv", "k\n1\n2\n")
    heads = sources.sweep_heads(spark, f"{tmp_path}/h", 2)
    assert sorted((r.line, r.value) for r in heads.collect()) == [(1, "1"), (2, "2")]
    plan = heads._jdf.queryExecution().optimizedPlan().toString()
    assert "value" not in "".join(x for x in plan.splitlines() if "Sort" in x or "Window" in x)


def test_sweep_reads_each_file_with_its_own_header(spark, write, tmp_path):
    write("s/a.csv", "﻿k,\"x, y\",z\r\n1,2,3\r\n4,5,6\r\n\r\n")
    write("s/deep/b.csv", "only\n" + "".join(f"{i}\n" for i in range(20)))
    write("s/c.txt", "not,csv\n")
    found = {
        r.file.rsplit("/", 1)[-1]: (r.n_rows, r.n_columns, r.columns)
        for r in sources.sweep_csv(spark, f"{tmp_path}/s").collect()
    }
    assert found == {"a.csv": (2, 3, ["k", "x, y", "z"]), "b.csv": (20, 1, ["only"])}
    heads = sources.sweep_heads(spark, f"{tmp_path}/s", 3)
    lines = sorted((r.line, r.value) for r in heads.filter("file LIKE '%b.csv'").collect())
    assert lines == [(1, "0"), (2, "1"), (3, "2")]


def test_sweep_of_a_file_read_in_many_splits(spark, write, tmp_path):
    write("big/a.csv", "k,v\n" + "".join(f"{i},x\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        row = sources.sweep_csv(spark, f"{tmp_path}/big").first()
        assert (row.n_rows, row["columns"]) == (20_000, ["k", "v"])
        heads = sources.sweep_heads(spark, f"{tmp_path}/big", 2).collect()
        assert [r.value for r in heads] == ["0,x", "1,x"]
        split = sources.manifest(spark, f"{tmp_path}/big").first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert split == sources.manifest(spark, f"{tmp_path}/big").first()


def test_manifest_tells_files_apart(spark, write, tmp_path):
    write("m/a.csv", "1\n2\n")
    write("m/b.csv", "1\n2\n")
    write("m/c.csv", "1\n3\n")
    write("m/d.csv", "1\r\n2\n")
    write("m/e.csv", "")
    write("m/f.csv", "2\n1\n")
    expected = [("facts", "a.csv"), ("facts", "/e.csv"), ("dims", "never.csv")]
    found = sources.manifest(spark, f"{tmp_path}/m", expected=expected).collect()
    rows = {r.file_name: r for r in found}
    assert {n: (r.source, r.landed, r.n_bytes, r.n_lines) for n, r in rows.items()} == {
        "a.csv": ("facts", True, 4, 2),
        "b.csv": (None, True, 4, 2),
        "c.csv": (None, True, 4, 2),
        "d.csv": (None, True, 5, 2),
        "e.csv": ("facts", True, 0, 0),
        "f.csv": (None, True, 4, 2),
        "never.csv": ("dims", False, None, None),
    }
    prints = {n: (r.hash_sum, r.hash_order) for n, r in rows.items()}
    assert prints["a.csv"] == prints["b.csv"]
    assert prints["a.csv"][0] == prints["f.csv"][0]
    assert len({prints[n] for n in ("a.csv", "c.csv", "d.csv", "f.csv")}) == 4


def test_files_at_any_depth_are_listed_by_tasks(spark, write, tmp_path):
    for name in ("a.csv", "x/b.csv", "x/y/z/c 1%2.csv", "x/y/none.csv", "x/d.txt", "_marks/e.csv", "k=_/f.csv", "x/.g.csv"):
        write(f"l/{name}", "" if "none" in name else "1\n")
    found = sources.list_files(spark, f"{tmp_path}/l", "*.csv").collect()
    below = {r.path.split("/l/", 1)[1]: r.n_bytes for r in found}
    assert below == {"a.csv": 2, "x/b.csv": 2, "x/y/z/c 1%2.csv": 2, "x/y/none.csv": 0, "k=_/f.csv": 2}
    # The scan names a file otherwise than the listing; they have to meet.
    rows = sources.manifest(spark, f"{tmp_path}/l").collect()
    assert sorted(r.n_lines for r in rows) == [0, 1, 1, 1, 1]
    named = spark.read.text(f"{tmp_path}/l", pathGlobFilter="*.csv", recursiveFileLookup=True).inputFiles()
    assert {r.path for r in rows} == set(named)


def test_an_empty_folder_has_no_files(spark, tmp_path):
    (tmp_path / "nothing").mkdir()
    assert sources.list_files(spark, f"{tmp_path}/nothing").isEmpty()


@pytest.mark.parametrize(
    "glob, fits, not_",
    [("*.csv", "a.csv", "a.csvx"), ("{a,b}?.csv", "b1.csv", "c1.csv"), ("[!0-9]*", "x1", "1x"), ("a.b", "a.b", "aXb")],
)
def test_globs_on_names(glob, fits, not_):
    from wardframe.sources.listing import name_pattern

    assert re.search(name_pattern(glob), fits) and not re.search(name_pattern(glob), not_)


def test_parquet_round_trip_and_parts(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, None)], "k int, s string")
    for _ in range(2):
        sources.write_table(df, f"{tmp_path}/t", partition_by=["k"], max_records_per_file=1)
    back = sources.read_table(spark, f"{tmp_path}/t")
    assert sorted(map(tuple, back.select("k", "s").collect())) == [(1, "x"), (2, None)]
    sources.write_table(df, f"{tmp_path}/a")
    sources.write_table(df.drop("s"), f"{tmp_path}/b")
    parts = sources.read_parts(spark, [f"{tmp_path}/a", f"{tmp_path}/b"])
    assert parts.count() == 4 and parts.filter("s IS NOT NULL").count() == 1


def test_lookup_columns_get_a_bloom_filter(spark, tmp_path):
    df = spark.range(0, 100_000, 1, 1).selectExpr("cast(id AS string) AS k", "id")
    sources.write_table(df, f"{tmp_path}/t", lookup_by=["k"])
    query = "SELECT path_in_schema, bloom_filter_offset FROM parquet_metadata(?)"
    found = dict(duckdb.execute(query, [f"{tmp_path}/t/*.parquet"]).fetchall())
    assert found["k"] is not None and found["id"] is None
    assert sources.read_table(spark, f"{tmp_path}/t").filter("k = '77'").count() == 1


def test_paths(spark):
    assert sources.join_path("s3://b/", "/x/", "y") == "s3://b/x/y"
    assert sources.join_path("a", "b") == "a/b"
    assert scratch_path(spark, "t").startswith(shared_dir(spark))
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_scratch_is_removed_when_asked(spark):
    from wardframe.session import remove_scratch

    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    remove_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
