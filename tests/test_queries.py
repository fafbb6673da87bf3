"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def in_order(rows, names):
    by_name = sorted(range(len(names)), key=names.__getitem__)
    plain = [
        tuple(None if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in by_name)
        for r in rows
    ]
    return sorted(names), sorted(plain, key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, duck, name):
    df = QUERIES[name](spark, folder)
    found = in_order(df.collect(), df.columns)
    assert found[1]
    if name in ORACLES:
        cursor = duck.execute(ORACLES[name])
        assert found == in_order(cursor.fetchall(), [c[0] for c in cursor.description])


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["STATE_bed", "Staff Type", "Avg Hours"]
