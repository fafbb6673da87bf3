"""Files whose records span lines, read in splits, and types inferred like pandas."""

import csv
import random

import pandas as pd
import pytest
from pyspark.sql import types as T

from wardframe import sources


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def use(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))

    yield use
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def text_type(_):
    return T.StringType()


def put(path, rows, encoding="utf-8", end="\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as file:
        csv.writer(file, lineterminator=end).writerows(rows)


WORDS = ["plain", "two\nlines", 'quo"ted', "a,b", "\n\n", "x" * 70, 'end"\n', "é–", "many\n" * 30, '"', "7"]


def drawn(n, seed):
    rng = random.Random(seed)
    return [[str(i), rng.choice(WORDS), rng.choice(WORDS)] for i in range(n)]


@pytest.mark.parametrize("size", [50, 333, 4000, 10_000_000])
def test_records_do_not_depend_on_the_splits(spark, tmp_path, small_splits, size):
    rows, other = drawn(300, size), drawn(40, size + 1)
    put(tmp_path / "f" / "a.csv", [["id", "one", "two\nlines"], *rows])
    put(tmp_path / "f" / "b.csv", [["id", "one", "two\nlines"], *other])
    small_splits(size)
    df = sources.read_csv(spark, f"{tmp_path}/f", text_type, multi_line=True, file_column="from")
    assert df.columns == ["id", "one", "two\nlines", "from"]
    found = sorted((r["from"][-5:], *r[:3]) for r in df.collect())
    assert found == sorted([("a.csv", *r) for r in rows] + [("b.csv", *r) for r in other])
    swept = {r.file[-5:]: (r.n_rows, r.n_columns) for r in sources.sweep_csv(spark, f"{tmp_path}/f", multi_line=True).collect()}
    assert swept == {"a.csv": (300, 3), "b.csv": (40, 3)}


def test_many_tasks_read_one_file(spark, tmp_path, small_splits):
    rows = drawn(2000, 5)
    put(tmp_path / "one.csv", [["id", "one", "two"], *rows])
    small_splits(20_000)
    df = sources.records(spark, f"{tmp_path}/one.csv")
    blocks = df.select("block").distinct().count()
    assert df.count() == 2001 and blocks > 5
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # Windows run over blocks and over pieces, never over the lines of a file.
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert windows and not any("line#" in x or "value#" in x.split("windowspec")[0] for x in windows)
    assert "MapInArrow" in plan and "Sort [line" in plan


def test_a_record_longer_than_many_blocks(spark, tmp_path, small_splits):
    rows = [["1", "short"], ["2", "line\n" * 5000], ["3", "after"], ["4", "again\n" * 3000]]
    put(tmp_path / "long.csv", [["id", "text"], *rows])
    small_splits(2000)
    df = sources.read_csv(spark, f"{tmp_path}/long.csv", text_type, multi_line=True)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, rows))


def test_windows_line_ends_a_mark_and_another_charset(spark, tmp_path, small_splits):
    rows = [["1", "é–"], ["2", "a\r\nb"], ["3", ""]]
    put(tmp_path / "w" / "a.csv", [["id", "text"], *rows], "cp1252", "\r\n")
    small_splits(12)
    df = sources.read_csv(spark, f"{tmp_path}/w", text_type, "windows-1252", multi_line=True)
    assert sorted((r.id, r.text) for r in df.collect()) == [("1", "é–"), ("2", "a\r\nb"), ("3", None)]
    put(tmp_path / "m" / "a.csv", [["﻿id", "text"], ["1", "a\nb"]])
    marked = sources.read_csv(spark, f"{tmp_path}/m", text_type, multi_line=True)
    assert marked.columns == ["id", "text"] and tuple(marked.first()) == ("1", "a\nb")


def test_headers_that_differ_are_refused(spark, tmp_path):
    put(tmp_path / "d" / "a.csv", [["k", "n"], ["x\ny", "1"]])
    put(tmp_path / "d" / "b.csv", [["n", "k"], ["1", "a"]])
    df = sources.read_csv(spark, f"{tmp_path}/d", text_type, multi_line=True)
    with pytest.raises(Exception, match="header"):
        df.collect()


def test_blank_lines_and_files_without_records(spark, tmp_path):
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "a.csv").write_text("\n\nk,n\n\n1,2\n  \n\n")
    (tmp_path / "e" / "b.csv").write_text("")
    df = sources.read_csv(spark, f"{tmp_path}/e/a.csv", text_type, multi_line=True)
    assert [tuple(r) for r in df.collect()] == [("1", "2")]
    assert [r.n_rows for r in sources.sweep_csv(spark, f"{tmp_path}/e", multi_line=True).collect()] == [1]


PANDAS = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string"}
COLUMNS = {
    "zeros": ["007", "010", "3", "4"],
    "whole": ["1", "-2", "+3", "4"],
    "gaps": ["1", "NA", "3", "4"],
    "blank": ["1", "", "3", "4"],
    "real": ["1", "2.5", ".5", "1e3"],
    "ends": ["1", "inf", "-Infinity", "2"],
    "truth": ["True", "FALSE", "true", "false"],
    "unsure": ["True", "NA", "true", "false"],
    "text": ["1", "x", "3", "4"],
    "suffix": ["1d", "2f", "3", "4"],
    "day": ["2024-01-01", "2024-01-02", "2024-02-30", "2024-01-04"],
    "none": ["NA", "", "null", "n/a"],
    "wide": ["9223372036854775807", "1", "2", "3"],
    "spaced": [" 1", "2", "3", "4"],
}


def test_types_equal_those_of_pandas(spark, tmp_path):
    path = tmp_path / "t.csv"
    put(path, [list(COLUMNS), *zip(*COLUMNS.values())])
    want = {c: PANDAS[str(t)] for c, t in pd.read_csv(path).dtypes.items()}
    for multi_line in (False, True):
        df = sources.read_csv_inferred(
            spark, str(path), missing=sources.MISSING_TOKENS, like_pandas=True, multi_line=multi_line
        )
        assert dict(df.dtypes) == want
        assert [r.gaps for r in df.collect()] == [1.0, None, 3.0, 4.0]


def test_narrowest_types(spark, tmp_path):
    path = tmp_path / "n.csv"
    columns = {**COLUMNS, "moment": ["2024-01-01 10:00", "2024-01-01", "2024-01-02T03:04:05", "2024-01-04"]}
    columns["fine"] = ["2024-01-01", "", "2024-01-03", "2024-01-04"]
    put(path, [list(columns), *zip(*columns.values())])
    df = sources.read_csv_inferred(spark, str(path), ["ZEROS"], missing=sources.MISSING_TOKENS)
    kinds = dict(df.dtypes)
    assert kinds["zeros"] == "string" and kinds["whole"] == kinds["gaps"] == kinds["blank"] == "int"
    assert kinds["wide"] == "bigint" and kinds["real"] == kinds["ends"] == "double"
    assert kinds["truth"] == kinds["unsure"] == "boolean" and kinds["none"] == kinds["suffix"] == "string"
    assert kinds["fine"] == "date" and kinds["day"] == "string" and kinds["moment"] == "timestamp"


def test_inference_is_one_aggregate(spark, tmp_path):
    path = tmp_path / "one.csv"
    put(path, [["a", "b"], ["1", "x"]])
    texts = sources.read_csv(spark, str(path), text_type)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("inference", "")
    kinds = sources.infer_types(texts)
    jobs = tracker.getJobIdsForGroup("inference")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 2 and kinds["a"] == T.IntegerType()
    assert sources.infer_types(texts.filter("false")) == {"a": T.StringType(), "b": T.StringType()}
    assert sources.infer_types(texts, ["a", "b"]) == {"a": T.StringType(), "b": T.StringType()}
