"""Statistics over many columns, each family folded into a single aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardframe.functions import all_digits
from wardframe.operators.columns import number, numeric_columns, quoted


def is_missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN in a floating-point column."""
    missing = quoted(column).isNull()
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        missing = missing | F.isnan(quoted(column))
    return missing


def _one_per_column(columns: Sequence[str], results: Sequence[Column]) -> Column:
    """Rows (column, result...) out of a one-row aggregate."""
    return F.inline(
        F.array(
            *[F.struct(F.lit(c).alias("column"), r) for c, r in zip(columns, results, strict=True)]
        )
    )


def _as_text(df: DataFrame, column: str) -> Column:
    """A text that is equal for equal values of a column that is no number, null where the value is missing."""
    value, kind = quoted(column), df.schema[column].dataType
    if isinstance(kind, T.BinaryType):
        text = F.hex(value)
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(F.struct(value.alias("v")))
    else:
        text = value.cast("string")
    return F.when(~is_missing(df, column), text)


def distinct_counts(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Distinct values per column, missing ones not counted.

    The exact form stacks all columns as text in one scan and shuffles each
    distinct value of a column once per task; a distinct count per column in
    one aggregate would carry all columns in every key. The approximate form
    shuffles a fixed-size sketch per column and task.
    """
    columns = df.columns if columns is None else columns
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, n_distinct long")
    if approximate:
        present = [F.when(~is_missing(df, c), quoted(c)) for c in columns]
        counts = df.agg(*[F.approx_count_distinct(v).alias(f"n{i}") for i, v in enumerate(present)])
        found = [F.col(f"n{i}").alias("n_distinct") for i in range(len(columns))]
        return counts.select(_one_per_column(columns, found))
    slots = [_slots(df, c, i) for i, c in enumerate(columns)]
    stacked = df.select(F.inline(F.array(*slots))).filter("whole IS NOT NULL OR real IS NOT NULL OR text IS NOT NULL")
    counts = stacked.distinct().groupBy("at").agg(F.count("*").alias("n_distinct"))
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("at") + 1)
    return _every_column(counts.select(name.alias("column"), "n_distinct"), columns)


def _slots(df: DataFrame, column: str, at: int) -> Column:
    """(at, whole, real, text): the value of a column in the slot of its kind, so that no number becomes text."""
    value, kind = quoted(column), df.schema[column].dataType
    whole, real, text = F.lit(None).cast("long"), F.lit(None).cast("double"), F.lit(None).cast("string")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        whole = value.cast("long")
    elif isinstance(kind, T.DateType):
        whole = F.unix_date(value).cast("long")
    elif isinstance(kind, T.TimestampType):
        whole = F.unix_micros(value)
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        real = F.when(~is_missing(df, column), value.cast("double") + F.lit(0.0))  # -0.0 equals 0.0
    else:
        text = _as_text(df, column)
    return F.struct(F.lit(at).alias("at"), whole.alias("whole"), real.alias("real"), text.alias("text"))


def _every_column(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds the columns an empty table gave no count for, with 0."""
    names = F.array(*[F.lit(c) for c in columns])
    every = counts.sparkSession.range(1).select(F.explode(names).alias("column"))
    return every.join(counts, "column", "left").fillna(0, subset=["n_distinct"])


def value_range(df: DataFrame, column: str) -> DataFrame:
    """One row: the smallest and the largest value."""
    return df.agg(F.min(quoted(column)).alias("first"), F.max(quoted(column)).alias("last"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column."""
    columns = df.columns if columns is None else columns
    counts = df.agg(
        *[F.count_if(is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(columns)]
    )
    found = [F.col(f"n{i}").alias("n_missing") for i in range(len(columns))]
    return counts.select(_one_per_column(columns, found))


def any_missing(df: DataFrame) -> DataFrame:
    """One row: whether any value of any column is missing."""
    some = F.lit(False)
    for c in df.columns:
        some = some | is_missing(df, c)
    return df.agg(F.coalesce(F.bool_or(some), F.lit(False)).alias("any_missing"))


def table_shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(
        F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns")
    )


def table_info(df: DataFrame) -> DataFrame:
    """Per column: its type and how many values are present."""
    counts = df.agg(
        *[F.count_if(~is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)]
    )
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"n{i}").alias("n_present"),
        )
        for i, f in enumerate(df.schema)
    ]
    return counts.select(F.inline(F.array(*rows)))


def all_keys_numeric(df: DataFrame, key: str) -> DataFrame:
    """One row: whether every key consists of numeric characters."""
    every = F.bool_and(all_digits(quoted(key)))
    return df.agg(F.coalesce(every, F.lit(True)).alias("all_numeric"))


@dataclass(frozen=True)
class Summary:
    """What one aggregate over a table tells: rows, present values, ends of the numbers."""

    n_rows: int
    present: dict[str, int]
    ends: dict[str, tuple[int, float | None, float | None]]  # values, least, greatest

    @property
    def any_missing(self) -> bool:
        return any(n < self.n_rows for n in self.present.values())


def summary(df: DataFrame) -> Summary:
    """One pass over ``df``, run now; a few numbers per column reach the driver."""
    numbers = numeric_columns(df)
    present = [F.count_if(~is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)]
    ends = [
        f(number(c)).alias(f"{name}{i}")
        for i, c in enumerate(numbers)
        for name, f in (("lo", F.min), ("hi", F.max))
    ]
    row = df.agg(F.count("*").alias("rows"), *present, *ends).first()
    counts = {c: row[f"n{i}"] for i, c in enumerate(df.columns)}
    return Summary(
        row["rows"], counts, {c: (counts[c], row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(numbers)}
    )
