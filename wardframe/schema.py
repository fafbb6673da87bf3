"""Names and types of the staffing tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values, down to the rates: file names, column names, their types and new
# names, and staff roles, all of the published data and its tables.
FACT_FILE = "PBJ_Daily_Nurse_Staffing_Q2_2024.csv"
DIM_FILE = "NH_ProviderInfo_Oct2024.csv"

ROLES = ("RNDON", "RNADMIN", "RN", "LPNADMIN", "LPN", "CNA", "NATRN", "MEDAIDE")

FACT_DROPPED = ("COUNTY_NAME", "COUNTY_FIPS", "CY_Qtr")

DIM_COLUMNS = {
    "CMS Certification Number (CCN)": T.StringType(),
    "Provider Name": T.StringType(),
    "Provider Type": T.StringType(),
    "State": T.StringType(),
    "City/Town": T.StringType(),
    "ZIP Code": T.StringType(),
    "Number of Certified Beds": T.IntegerType(),
    "Average Number of Residents per Day": T.DoubleType(),
    "Average Number of Residents per Day Footnote": T.IntegerType(),
    "Reported Nurse Aide Staffing Hours per Resident per Day": T.DoubleType(),
    "Reported LPN Staffing Hours per Resident per Day": T.DoubleType(),
    "Reported RN Staffing Hours per Resident per Day": T.DoubleType(),
    "Reported Licensed Staffing Hours per Resident per Day": T.DoubleType(),
    "Reported Total Nurse Staffing Hours per Resident per Day": T.DoubleType(),
    "Total number of nurse staff hours per resident per day on the weekend": T.DoubleType(),
    "Registered Nurse hours per resident per day on the weekend": T.DoubleType(),
    "Reported Physical Therapist Staffing Hours per Resident Per Day": T.DoubleType(),
    "Total nursing staff turnover": T.DoubleType(),
    "Total nursing staff turnover footnote": T.IntegerType(),
    "Registered Nurse turnover": T.DoubleType(),
    "Registered Nurse turnover footnote": T.IntegerType(),
    "Number of administrators who have left the nursing home": T.IntegerType(),
    "Administrator turnover footnote": T.IntegerType(),
}

DIM_RENAMED = {"CMS Certification Number (CCN)": "PROVIDER_NUM", "City/Town": "CITY_TOWN"}

FACT_INTEGERS = ("WORKDATE", "MDSCENSUS", "COUNTY_FIPS")

PROVIDER = ("PROVIDER_NUM", "PROVIDER_NAME", "PROVIDER_TYPE", "STATE")
WORKED = ("PROVNUM", "PROVNAME", "CITY", "STATE", "WORKDATE", "MDSCENSUS")

BEDS = "NUMBER_OF_CERTIFIED_BEDS"
RESIDENTS = "AVERAGE_NUMBER_OF_RESIDENTS_PER_DAY"
RESIDENTS_FOOTNOTE = "AVERAGE_NUMBER_OF_RESIDENTS_PER_DAY_FOOTNOTE"
RESIDENTS_TOTAL = "AVERAGE_NUMBER_OF_RESIDENTS_PER_DAY_TOTAL"
UTILIZATION = "BED_UTILIZATION_RATE"

AIDE_HOURS = "REPORTED_NURSE_AIDE_STAFFING_HOURS_PER_RESIDENT_PER_DAY"
LPN_HOURS = "REPORTED_LPN_STAFFING_HOURS_PER_RESIDENT_PER_DAY"
RN_HOURS = "REPORTED_RN_STAFFING_HOURS_PER_RESIDENT_PER_DAY"
NURSE_HOURS = "REPORTED_TOTAL_NURSE_STAFFING_HOURS_PER_RESIDENT_PER_DAY"
WEEKEND_HOURS = "TOTAL_NUMBER_OF_NURSE_STAFF_HOURS_PER_RESIDENT_PER_DAY_ON_THE_WEEKEND"
RN_WEEKEND_HOURS = "REGISTERED_NURSE_HOURS_PER_RESIDENT_PER_DAY_ON_THE_WEEKEND"

# Each rate with its weekday and its weekend hours. Only the
# registered nurses have weekend hours of their own.
NURSE_RATES = {
    "NURSE_AIDE_TO_PATIENT_RATE": (AIDE_HOURS, WEEKEND_HOURS),
    "LPN_TO_PATIENT_RATE": (LPN_HOURS, WEEKEND_HOURS),
    "RN_TO_PATIENT_RATE": (RN_HOURS, RN_WEEKEND_HOURS),
    "NURSE_TO_PATIENT_RATE": (NURSE_HOURS, WEEKEND_HOURS),
}

# The report's labels.
NURSE_LABELS = {
    "RN": "RN_TO_PATIENT_RATE",
    "LPN": "LPN_TO_PATIENT_RATE",
    "Nurse Aide": "NURSE_AIDE_TO_PATIENT_RATE",
    "All Nurse": "NURSE_TO_PATIENT_RATE",
}
BED_LABELS = {"Beds": (BEDS,), "Patients": (RESIDENTS_TOTAL,), "Both": (BEDS, RESIDENTS_TOTAL)}


def hours(role: str) -> tuple[str, str]:
    """The employee and the contractor hours of a role."""
    return f"HRS_{role}_EMP", f"HRS_{role}_CTR"


def fact_type(name: str) -> T.DataType:
    """Type of a raw fact column, by its name in any case; keys stay text."""
    upper = name.upper()
    if upper.startswith("HRS_"):
        return T.DoubleType()
    return T.IntegerType() if upper in FACT_INTEGERS else T.StringType()


def dim_type(name: str) -> T.DataType:
    """Type of a raw provider column; columns that Silver drops stay text."""
    return DIM_COLUMNS.get(name, T.StringType())
