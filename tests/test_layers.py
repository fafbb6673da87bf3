"""Silver, Gold and the checks, on small tables with known results."""

import datetime

import pytest
from pyspark.sql import functions as F

from wardframe import schema as S
from wardframe.plans import gold, quality, silver


def typed(name, types):
    return f"`{name}` {types[name].simpleString()}"


@pytest.fixture(scope="module")
def dim(spark):
    row = dict.fromkeys(S.DIM_COLUMNS)
    known = {
        "CMS Certification Number (CCN)": "015009",
        "State": "AL",
        "Number of Certified Beds": 100,
        "Average Number of Residents per Day Footnote": 9,
        "Reported LPN Staffing Hours per Resident per Day": 2.0,
        "Reported RN Staffing Hours per Resident per Day": 2.0,
        "Total number of nurse staff hours per resident per day on the weekend": 1.0,
        "Registered Nurse hours per resident per day on the weekend": float("nan"),
    }
    fields = [typed(n, S.DIM_COLUMNS) for n in row]
    raw = spark.createDataFrame([(*(row | known).values(), "x")], ", ".join([*fields, "Extra string"]))
    return silver.silver_dim(raw)


def test_silver_dim_names(dim):
    assert len(dim.columns) == 23
    assert dim.columns[:5] == ["PROVIDER_NUM", "PROVIDER_NAME", "PROVIDER_TYPE", "STATE", "CITY_TOWN"]
    assert dim.first()[S.RN_WEEKEND_HOURS] is None


def test_dim_bed_adds_the_footnote(dim):
    row = gold.dim_bed(dim).first()
    assert row[S.RESIDENTS] == 0.0
    assert row[S.RESIDENTS_FOOTNOTE] == 9
    assert row[S.RESIDENTS_TOTAL] == 9.0
    assert row[S.UTILIZATION] == 9.0
    assert gold.dim_bed(dim, include_footnote=False).first()[S.UTILIZATION] == 0.0
    assert len(row) == 9


def test_dim_nurse_rates(dim):
    row = gold.dim_nurse(dim).first()
    assert len(row) == 14
    assert row["NURSE_AIDE_TO_PATIENT_RATE"] == 0.29
    assert row["LPN_TO_PATIENT_RATE"] == 1.71
    assert row["RN_TO_PATIENT_RATE"] == 1.43
    assert row["NURSE_TO_PATIENT_RATE"] == 0.29


@pytest.fixture(scope="module")
def fact(spark):
    names = ["PROVNUM", "PROVNAME", "CITY", "STATE", "COUNTY_NAME", "COUNTY_FIPS", "CY_Qtr"]
    names += ["WorkDate", "MDScensus", "Hrs_MEDAIDE"]
    names += [f"Hrs_{r}_{k}" for r in S.ROLES for k in ("emp", "ctr")]
    schema = ", ".join(f"{n} {S.fact_type(n).simpleString()}" for n in names)
    row = ("015009", "n", "c", "AL", "x", 1, "2024Q2", 20240401, 50, 3.0)
    rows = [(*row, *[3.0, 2.0] * 8), (*row[:7], None, None, 3.0, *[None] * 16)]
    return silver.silver_fact(spark.createDataFrame(rows, schema))


def test_silver_fact_drops_and_renames(fact):
    assert not {"COUNTY_NAME", "COUNTY_FIPS", "CY_QTR"} & set(fact.columns)
    assert all(c == c.upper() for c in fact.columns)
    assert len(fact.columns) == 23


def test_fact_staff(fact):
    staff = gold.fact_staff(fact)
    assert len(staff.columns) == 33
    row = staff.filter("MDSCENSUS = 50").first()
    assert row.WORKDATE == datetime.date(2024, 4, 1)
    assert (row.WORKYEAR, row.WORKMONTH, row.WORKDAY) == (2024, 4, 1)
    assert {row[f"STAFF_RATIO_{r}"] for r in S.ROLES} == {1.5}
    empty = staff.filter("MDSCENSUS IS NULL").first()
    assert empty.WORKDATE is None and empty.STAFF_RATIO_RN is None


def test_gold_shuffles_nothing(fact, dim):
    for df in (gold.fact_staff(fact), gold.dim_bed(dim), gold.dim_nurse(dim)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_quality_report(spark):
    dim = spark.createDataFrame([("1",), ("1",), ("A1",), (None,)], "PROVIDER_NUM string")
    fact = spark.createDataFrame(
        [("1", 5), ("1", 5), ("1", 6), (None, 5), ("1", None)], "PROVNUM string, WORKDATE int"
    )
    found = {r.check: r.n_failed for r in quality.quality_report(dim, fact).collect()}
    assert found == {
        "provider_key_repeated": 1,
        "provider_key_missing": 1,
        "provider_key_not_numeric": 1,
        "work_day_key_repeated": 1,
        "work_day_key_missing": 2,
    }
    with pytest.raises(quality.QualityError, match="'1'"):
        quality.require_unique_providers(dim)
    quality.require_unique_providers(dim.filter(F.col("PROVIDER_NUM") == "A1"))
