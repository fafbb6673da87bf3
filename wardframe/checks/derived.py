"""Staffing-shaped raw tables derived from the supplier and line item tables.

Every expression is plain SQL that Spark and DuckDB read alike, so that the
checks can build the same raw tables in either engine. Suppliers are the
providers, line items their work days. The work days are a projection of the
line items alone: no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardframe.schema import ROLES
from wardframe.sources import join_path, read_table


def _key(column: str) -> str:
    """Provider key: 12 places, every seventh with a letter, others with leading zeros."""
    text = f"cast({column} as string)"
    return (
        f"CASE WHEN {column} % 7 = 0 THEN concat('A', lpad({text}, 11, '0'))"
        f" ELSE lpad({text}, 12, '0') END"
    )


def _unless(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN NULL ELSE {value} END"


def _tenths(number: str) -> str:
    return f"cast({number} as double) / 10e0"


# The keys are the column names of the published files, in their order.
DIM_RAW = {
    "CMS Certification Number (CCN)": _key("s_suppkey"),
    "Provider Name": "s_name",
    "Legal Business Name": "concat('Legal ', s_name)",
    "Provider Type": (
        "CASE s_suppkey % 3 WHEN 0 THEN 'Medicare' WHEN 1 THEN 'Medicaid'"
        " ELSE 'Medicare and Medicaid' END"
    ),
    "State": _unless("s_suppkey % 23 = 5", "n_name"),
    "City/Town": "concat('CITY_', cast(s_suppkey % 10 as string))",
    "ZIP Code": "lpad(cast(s_suppkey % 100000 as string), 5, '0')",
    "Number of Certified Beds": (
        "CASE WHEN s_suppkey % 9 = 4 THEN 0 WHEN s_suppkey % 8 = 3 THEN NULL"
        " ELSE cast((s_suppkey * 37) % 151 + 1 as int) END"
    ),
    "Average Number of Residents per Day": _unless("s_suppkey % 5 = 0", "abs(s_acctbal) / 100e0"),
    "Average Number of Residents per Day Footnote": (
        "CASE WHEN s_suppkey % 5 = 0 THEN 9 ELSE NULL END"
    ),
    "Reported Nurse Aide Staffing Hours per Resident per Day": _unless(
        "s_suppkey % 8 = 0", _tenths("s_suppkey % 40")
    ),
    "Reported LPN Staffing Hours per Resident per Day": _unless(
        "s_suppkey % 9 = 0", _tenths("(s_suppkey * 3) % 17")
    ),
    "Reported RN Staffing Hours per Resident per Day": _unless(
        "s_suppkey % 9 = 0", _tenths("s_suppkey % 13")
    ),
    "Reported Licensed Staffing Hours per Resident per Day": _tenths("s_suppkey % 21"),
    "Reported Total Nurse Staffing Hours per Resident per Day": _tenths("s_suppkey % 60"),
    "Total number of nurse staff hours per resident per day on the weekend": _unless(
        "s_suppkey % 6 = 0", _tenths("(s_suppkey * 11) % 50")
    ),
    "Registered Nurse hours per resident per day on the weekend": _tenths("(s_suppkey * 5) % 9"),
    "Reported Physical Therapist Staffing Hours per Resident Per Day": _tenths("s_suppkey % 4"),
    "Total nursing staff turnover": _unless("s_suppkey % 11 = 0", _tenths("(s_suppkey * 7) % 900")),
    "Total nursing staff turnover footnote": "CASE WHEN s_suppkey % 11 = 0 THEN 6 ELSE NULL END",
    "Registered Nurse turnover": _unless("s_suppkey % 12 = 0", _tenths("(s_suppkey * 13) % 950")),
    "Registered Nurse turnover footnote": "CASE WHEN s_suppkey % 12 = 0 THEN 6 ELSE NULL END",
    "Number of administrators who have left the nursing home": "cast(s_suppkey % 4 as int)",
    "Administrator turnover footnote": "CASE WHEN s_suppkey % 13 = 0 THEN 6 ELSE NULL END",
}

DIM_FROM = "supplier JOIN nation ON s_nationkey = n_nationkey"


def _contractor(i: int) -> str:
    return _unless(f"(l_orderkey + {i}) % 17 = 0", f"l_discount * 10e0 * {i + 1}")


def _employee(i: int) -> str:
    return f"l_quantity * {i + 1} / 8e0"


FACT_RAW = {
    "PROVNUM": _key("l_suppkey"),
    "PROVNAME": "concat('Supplier#', lpad(cast(l_suppkey as string), 9, '0'))",
    "CITY": "concat('CITY_', cast(l_suppkey % 10 as string))",
    "STATE": "concat('NATION_', cast(l_suppkey % 25 as string))",
    "COUNTY_NAME": "concat('COUNTY_', cast(l_suppkey % 25 as string))",
    "COUNTY_FIPS": "cast(l_suppkey % 25 as int)",
    "CY_Qtr": "'2024Q2'",
    "WorkDate": (
        "cast(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) as int)"
    ),
    "MDScensus": _unless("l_orderkey % 19 = 0", "cast(l_quantity as int)"),
    **{
        f"Hrs_{role}_{kind}": hours(i)
        for i, role in enumerate(ROLES)
        for kind, hours in (("emp", _employee), ("ctr", _contractor))
    },
    "Hrs_MEDAIDE": f"{_employee(7)} + coalesce({_contractor(7)}, 0e0)",
}

FACT_FROM = "lineitem"


def derivation(columns: Mapping[str, str], source: str) -> str:
    """The raw table as an ANSI query."""
    return "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in columns.items()) + f" FROM {source}"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, join_path(folder, f"{name}.parquet"))


def dim_raw(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    providers = table(spark, folder, "supplier").join(
        nation, nation["n_nationkey"] == F.col("s_nationkey")
    )
    return providers.selectExpr(*_aliased(DIM_RAW))


def fact_raw(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(*_aliased(FACT_RAW))


def fact_raw_dealt(spark: SparkSession, folder: str, parts: int, keys: Sequence[str]) -> DataFrame:
    """``fact_raw`` dealt out by its columns ``keys``; what is shuffled is the columns it is derived from."""
    dealt = table(spark, folder, "lineitem").repartition(parts, *[F.expr(FACT_RAW[k]) for k in keys])
    return dealt.selectExpr(*_aliased(FACT_RAW))


def _aliased(columns: Mapping[str, str]) -> list[str]:
    return [f"{e} AS `{n}`" for n, e in columns.items()]
