import pytest

from wardframe.plans.gates import Gate, gate_report, write_gated
from wardframe.plans.quality import QualityError
from wardframe.sources import read_table

GATES = (Gate("key_missing", "k IS NOT NULL"), Gate("negative", "v >= 0"))


@pytest.fixture(scope="module")
def days(spark):
    rows = [(1, 5, "a"), (2, -1, "b"), (None, 3, "c"), (None, -2, None), (4, None, "e"), (5, 0, "f"), (5, 7, "f")]
    return spark.createDataFrame(rows, "k int, v int, reasons string").repartition(3)


def found(spark, path, *columns):
    return sorted((tuple(r) for r in read_table(spark, path).select(*columns).collect()), key=repr)


def test_refused_rows_go_elsewhere_with_their_reasons(spark, days, tmp_path):
    counts = write_gated(days, f"{tmp_path}/kept", GATES, f"{tmp_path}/refused")
    assert counts == {
        "n_rows": 7,
        "n_refused": 4,
        "refused:key_missing": 2,
        "refused:negative": 3,
        "missing:k": 2,
        "missing:v": 1,
        "missing:reasons": 1,
    }
    assert found(spark, f"{tmp_path}/kept", "k", "v") == [(1, 5), (5, 0), (5, 7)]
    assert read_table(spark, f"{tmp_path}/kept").columns == days.columns
    # Null is not true, so a missing number is refused by the gate on its sign.
    assert found(spark, f"{tmp_path}/refused", "k", "v", "_reasons") == [
        (2, -1, ["negative"]),
        (4, None, ["negative"]),
        (None, -2, ["key_missing", "negative"]),
        (None, 3, ["key_missing"]),
    ]


def test_repeated_keys_null_among_them(spark, days, tmp_path):
    counts = write_gated(days, f"{tmp_path}/kept", (), f"{tmp_path}/refused", unique=["k"])
    assert (counts["n_refused"], counts["refused:key_repeated"]) == (4, 4)
    assert found(spark, f"{tmp_path}/kept", "k") == [(1,), (2,), (4,)]
    assert found(spark, f"{tmp_path}/refused", "k") == [(5,), (5,), (None,), (None,)]


def test_without_a_place_for_refused_rows_they_stay(spark, days, tmp_path):
    counts = write_gated(days, f"{tmp_path}/all", GATES)
    assert counts["n_refused"] == 4
    assert read_table(spark, f"{tmp_path}/all").count() == 7


def test_a_partitioned_table_counts_each_row_once(spark, days, tmp_path):
    counts = write_gated(days, f"{tmp_path}/kept", GATES, f"{tmp_path}/refused", partition_by=["k"])
    assert (counts["n_rows"], counts["n_refused"]) == (7, 4)
    assert found(spark, f"{tmp_path}/kept", "k", "v") == [(1, 5), (5, 0), (5, 7)]


def test_too_many_refused(spark, days, tmp_path):
    with pytest.raises(QualityError, match="4 of 7"):
        write_gated(days, f"{tmp_path}/kept", GATES, f"{tmp_path}/refused", most_refused=0.5)


def test_empty_tables_and_stale_refused_rows(spark, days, tmp_path):
    write_gated(days, f"{tmp_path}/kept", GATES, f"{tmp_path}/refused")
    for none in (days.filter("v > 100"), days.limit(0)):
        counts = write_gated(none, f"{tmp_path}/kept", GATES, f"{tmp_path}/refused", unique=["k"])
        assert set(counts.values()) == {0}
        assert read_table(spark, f"{tmp_path}/kept").isEmpty()
        assert read_table(spark, f"{tmp_path}/refused").isEmpty()


def test_the_input_is_read_once_for_all_counts(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    source = spark.range(100).mapInArrow(counted, "id long")
    counts = write_gated(source, f"{tmp_path}/kept", (Gate("none", "id >= 0"),), f"{tmp_path}/refused")
    assert counts["n_rows"] == 100 and counts["n_refused"] == 0
    assert read.value == 100


def test_report(spark):
    report = gate_report(spark, {"a": {"n_rows": 2}, "b": {"n_rows": 0, "n_refused": 0}})
    assert sorted(map(tuple, report.collect())) == [("a", "n_rows", 2), ("b", "n_refused", 0), ("b", "n_rows", 0)]
