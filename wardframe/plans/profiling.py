"""Data exploration of a raw or written table, as named frames.

One pass over the table, run when the frames are built, gives its shape, types,
missing values and the ends of its numbers; quartiles and histograms start from
these. Every other frame is one more pass, or two for repeated rows, when it is
used. Give tables that are on disk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.operators import duplicates, histogram, profile, quantiles, rows
from wardframe.operators.columns import numeric_columns, quoted, select_columns, text_columns


def _shape(df: DataFrame, known: profile.Summary) -> DataFrame:
    shape = [(known.n_rows, len(df.columns))]
    return df.sparkSession.createDataFrame(shape, "n_rows long, n_columns long")


def _info(df: DataFrame, known: profile.Summary) -> DataFrame:
    found = [
        (i, f.name, f.dataType.simpleString(), known.present[f.name]) for i, f in enumerate(df.schema)
    ]
    schema = "position int, column string, type string, n_present long"
    return df.sparkSession.createDataFrame(found, schema)


def _missing(df: DataFrame, known: profile.Summary) -> DataFrame:
    found = [(c, known.n_rows - n) for c, n in known.present.items()]
    return df.sparkSession.createDataFrame(found, "column string, n_missing long")


def _common(
    df: DataFrame, known: profile.Summary, key: Sequence[str], bins: int
) -> dict[str, DataFrame]:
    numbers = numeric_columns(df)
    frames = {
        "shape": _shape(df, known),
        "info": _info(df, known),
        "missing": _missing(df, known),
        "any_missing": df.sparkSession.createDataFrame([(known.any_missing,)], "any_missing boolean"),
        "duplicate_rows": duplicates.extra_copies(df),
        "repeated_keys": duplicates.repeated_keys(df, key),
    }
    if numbers:
        frames["histogram"] = histogram.histogram(df, numbers, bins, known.ends)
        frames["outliers"] = quantiles.outlier_counts(df, numbers, ends=known.ends)
    return frames


def profile_fact(raw: DataFrame) -> dict[str, DataFrame]:
    """Exploration of the raw work days."""
    known = profile.summary(raw)
    counted = ["PROVNAME", "CITY", "STATE", "COUNTY_NAME", "MDScensus", "WorkDate"]
    frames = _common(raw, known, ["PROVNUM", "WorkDate"], bins=46) | {
        "quarters": rows.distinct_values(raw, "CY_Qtr"),
        "distinct": profile.distinct_counts(raw, list(dict.fromkeys([*counted, *text_columns(raw)]))),
    }
    if "WorkDate" in known.ends:
        _, first, last = known.ends["WorkDate"]
        dates = raw.sparkSession.createDataFrame([(first, last)], "first double, last double")
        kind = raw.schema["WorkDate"].dataType
        frames["dates"] = dates.select(*[F.col(c).cast(kind).alias(c) for c in dates.columns])
        frames["date_histogram"] = histogram.histogram(raw, ["WorkDate"], 231, known.ends)
    else:
        frames["dates"] = profile.value_range(raw, "WorkDate")
    return frames


def profile_dim(raw: DataFrame, key: str = "CMS Certification Number (CCN)") -> dict[str, DataFrame]:
    """Exploration of the raw providers."""
    return _common(raw, profile.summary(raw), [key], bins=50) | {
        "all_keys_numeric": profile.all_keys_numeric(raw, key),
        "other_keys": rows.non_numeric_keys(raw, key).select(quoted(key)),
        "distinct": profile.distinct_counts(raw, [key, "Provider Type"]),
        "provider_types": rows.distinct_values(raw, "Provider Type"),
    }


def long_profile(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows (frame, item, measure, value): what the frames of an exploration say in numbers."""
    number = lambda c: F.col(c).cast("double").alias("value")
    item = F.col("column").alias("item")
    parts = {
        "shape": [
            (F.lit("table").alias("item"), F.lit(c).alias("measure"), number(c))
            for c in ("n_rows", "n_columns")
        ],
        "info": [(item, F.lit("n_present").alias("measure"), number("n_present"))],
        "missing": [(item, F.lit("n_missing").alias("measure"), number("n_missing"))],
        "any_missing": [(F.lit("table").alias("item"), F.lit("any").alias("measure"), number("any_missing"))],
        "distinct": [(item, F.lit("n_distinct").alias("measure"), number("n_distinct"))],
        "histogram": [(item, F.col("bin").cast("string").alias("measure"), number("n"))],
        "outliers": [(item, F.lit("n_outliers").alias("measure"), number("n_outliers"))],
    }
    found = [
        frames[name].select(F.lit(name).alias("frame"), *columns)
        for name, many in parts.items()
        if name in frames
        for columns in many
    ]
    for name in ("duplicate_rows", "repeated_keys"):
        counted = frames[name].agg(F.count("*").cast("double").alias("value"))
        found.append(
            counted.select(
                F.lit(name).alias("frame"), F.lit("table").alias("item"), F.lit("n").alias("measure"), "value"
            )
        )
    return rows.union_parts(found)


def inspect_table(
    table: DataFrame, order_by: Sequence[str], n: int = 5, columns: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """First look at a written table: some rows in a stated order, types and counts."""
    shown = select_columns(table, columns) if columns else table
    return {
        "head": rows.first_rows(table, n, order_by).select(*[quoted(c) for c in shown.columns]),
        "info": profile.table_info(table),
    }
