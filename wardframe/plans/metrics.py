"""The five reports over the Gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardframe import schema as S
from wardframe.functions import int_or_null, two_decimal_text
from wardframe.operators.aggregates import (
    long_form,
    mean_by,
    mean_of_group_means,
    means_of_group_means,
    sum_by,
    summed_together,
)
from wardframe.operators.columns import labelled_column
from wardframe.operators.joins import join_dimension
from wardframe.operators.rows import first_rows, require_rows, where_equal
from wardframe.sources import join_stored, store_for_join

ROLE_HOURS = {role: S.hours(role) for role in S.ROLES}


def provider_frame(bed: DataFrame, staff: DataFrame, null_safe: bool = False) -> DataFrame:
    """Providers joined to their work days; STATE becomes STATE_bed and STATE_staff."""
    return join_dimension(bed, staff, "PROVIDER_NUM", "PROVNUM", ("_bed", "_staff"), null_safe)


def store_provider_frame(bed: DataFrame, staff: DataFrame, folder: str, buckets: int, **limits: int) -> None:
    """Both tables stored so that the reports can join them without a shuffle."""
    store_for_join(bed, staff, "PROVIDER_NUM", "PROVNUM", folder, buckets, **limits)


def stored_provider_frame(spark: SparkSession, folder: str) -> DataFrame:
    """``provider_frame`` of the stored tables."""
    return join_stored(spark, folder, ("_bed", "_staff"))


# Report 1 and 2: beds


def beds_by_state(bed: DataFrame, provider_type: str, show: str = "Both") -> DataFrame:
    """Beds and residents per state for one provider type; ``show`` picks one or both."""
    columns = labelled_column(show, S.BED_LABELS)
    return sum_by(where_equal(bed, "PROVIDER_TYPE", provider_type), "STATE", columns)


def beds_by_state_long(bed: DataFrame, provider_type: str) -> DataFrame:
    both = S.BED_LABELS["Both"]
    return long_form(beds_by_state(bed, provider_type), "STATE", both, "Metric", "Count")


def utilization_by_state(bed: DataFrame, provider_type: str) -> DataFrame:
    return mean_by(where_equal(bed, "PROVIDER_TYPE", provider_type), "STATE", S.UTILIZATION)


# Report 3: nurses


def nurse_rate_by_state(nurse: DataFrame, provider_type: str, nurse_type: str) -> DataFrame:
    rate = labelled_column(nurse_type, S.NURSE_LABELS)
    return mean_by(where_equal(nurse, "PROVIDER_TYPE", provider_type), "STATE", rate)


def nurse_rate_headline(nurse: DataFrame, provider_type: str, nurse_type: str) -> DataFrame:
    """One row: the unweighted mean of the state means, as number and as text."""
    rate = labelled_column(nurse_type, S.NURSE_LABELS)
    of_type = where_equal(nurse, "PROVIDER_TYPE", provider_type)
    mean = mean_of_group_means(of_type, "STATE", rate).select(F.col(rate).alias("rate"))
    return mean.withColumn("text", two_decimal_text(F.col("rate")))


def nurse_rate_headlines(nurse: DataFrame, provider_type: str) -> DataFrame:
    """Rows (nurse_type, rate, text): the headline of every label, in one pass."""
    of_type = where_equal(nurse, "PROVIDER_TYPE", provider_type)
    rates = list(S.NURSE_LABELS.values())
    means = means_of_group_means(of_type, "STATE", rates)
    labelled = [F.struct(F.lit(k).alias("nurse_type"), F.col(c).alias("rate")) for k, c in S.NURSE_LABELS.items()]
    long = means.select(F.inline(F.array(*labelled)))
    return long.select("nurse_type", "rate", two_decimal_text(F.col("rate")).alias("text"))


# Report 4: one provider


def provider_choices(bed: DataFrame, staff: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values of a provider column, for providers with work days.

    The work days are reduced to their keys before the join, so that neither
    their number nor a hot provider reaches it.
    """
    at_work = staff.select(F.col("PROVNUM").alias("PROVIDER_NUM")).distinct()
    present = bed.join(at_work, "PROVIDER_NUM", "left_semi")
    return present.select(column).distinct().orderBy(column)


def provider_days(
    bed: DataFrame,
    staff: DataFrame,
    number: str | None = None,
    name: str | None = None,
) -> DataFrame:
    """Work days of the provider with this number, or of all with this name."""
    if (number is None) == (name is None):
        raise ValueError("give either the provider's number or its name")
    if number is not None:
        chosen = where_equal(bed, "PROVIDER_NUM", number)
    else:
        chosen = where_equal(bed, "PROVIDER_NAME", name)
    return provider_frame(chosen, staff)


def daily_census(days: DataFrame) -> DataFrame:
    """Residents per work day, in date order."""
    return sum_by(days, "WORKDATE", ["MDSCENSUS"])


def provider_card(days: DataFrame) -> DataFrame:
    """Header of the report, from the first day by provider number and date."""
    cards = days.select(
        "PROVIDER_NUM",
        "PROVIDER_NAME",
        "PROVIDER_TYPE",
        F.col("STATE_bed").alias("STATE"),
        "CITY",
        int_or_null(F.col(S.BEDS)).alias("CERTIFIED_BEDS"),
        "WORKDATE",
    )
    order = ["PROVIDER_NUM", "WORKDATE", "CITY", "PROVIDER_NAME", "PROVIDER_TYPE", "STATE"]
    return first_rows(cards, 1, [*order, "CERTIFIED_BEDS"]).drop("WORKDATE")


def provider_report(
    bed: DataFrame, staff: DataFrame, number: str | None = None, name: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Card and daily census of a provider; raises NoRows if it has no work days."""
    days = provider_days(bed, staff, number, name)
    # The card is one row of the same join; it tells whether there is any day.
    return require_rows(provider_card(days)), daily_census(days)


# Report 5: staff hours


def staff_hours_by_state(bed: DataFrame, staff: DataFrame, provider_type: str) -> DataFrame:
    """Hours per state and role, employees and contractors together, for one type.

    The state is the provider's. The hours are summed per provider before the
    join, so that a provider with very many work days is shuffled as one record
    per task, whether the providers are few or many.
    """
    of_type = where_equal(bed, "PROVIDER_TYPE", provider_type)
    providers = of_type.select("PROVIDER_NUM", F.col("STATE").alias("STATE_bed")).dropna()
    hours = summed_together(staff, "PROVNUM", ROLE_HOURS)
    joined = providers.join(hours, providers["PROVIDER_NUM"] == hours["PROVNUM"], "inner")
    return summed_together(joined, "STATE_bed", {role: [role] for role in S.ROLES}).orderBy("STATE_bed")


def staff_hours_long(
    bed: DataFrame, staff: DataFrame, provider_type: str, roles: Sequence[str] = S.ROLES
) -> DataFrame:
    """Rows (STATE_bed, Staff Type, Avg Hours). The values are totals, under the report's name."""
    wide = staff_hours_by_state(bed, staff, provider_type)
    return long_form(wide, "STATE_bed", roles, "Staff Type", "Avg Hours")
