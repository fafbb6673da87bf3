"""Choosing, naming and cleaning columns."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Without the named columns; a name that is absent is ignored."""
    return df.drop(*names)


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns in the given order; names may hold spaces or dots."""
    return df.select(*[quoted(n) for n in names])


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def normalize_columns(df: DataFrame) -> DataFrame:
    """Every name in upper case with spaces as underscores, in one projection."""
    names = [n.upper().replace(" ", "_") for n in df.columns]
    clashes = sorted(n for n, k in Counter(names).items() if k > 1)
    if clashes:
        raise ValueError(f"column names clash once normalised: {clashes}")
    return df.toDF(*names)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    """Every column that is not a number."""
    numeric = set(numeric_columns(df))
    return [n for n in df.columns if n not in numeric]


def labelled_column[V](label: str, columns: Mapping[str, V]) -> V:
    """The column, or columns, a report label stands for."""
    if label not in columns:
        raise ValueError(f"unknown label {label!r}; choose one of {sorted(columns)}")
    return columns[label]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN as null in every floating-point column, since Spark treats them apart."""
    floating = (T.FloatType, T.DoubleType)
    return df.selectExpr(
        *[
            f"nullif({n}, double('NaN')) AS {n}" if isinstance(f.dataType, floating) else n
            for f in df.schema
            for n in [backticked(f.name)]
        ]
    )


def number(column: str) -> Column:
    """The column as a double, with NaN as null."""
    return F.expr(f"nullif(cast({backticked(column)} AS double), double('NaN'))")


def numbers_long(df: DataFrame, values: Sequence[Column]) -> DataFrame:
    """Rows (series, value): every value that is not null, under its position in ``values``."""
    wide = df.select(*[v.alias(f"{i}") for i, v in enumerate(values)])
    long = wide.unpivot([], [F.col(f"`{i}`") for i in range(len(values))], "series", "value")
    return long.filter("value IS NOT NULL").withColumn("series", F.col("series").cast("int"))


def backticked(name: str) -> str:
    """A literal column name for use in SQL text, dots and spaces included."""
    return f"`{name.replace('`', '``')}`"


def quoted(name: str) -> Column:
    """Column by its literal name."""
    return F.col(backticked(name))
