"""Raw tables to cleaned tables: columns chosen and named, values untouched."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wardframe import schema as S
from wardframe.operators.columns import (
    drop_columns,
    nan_to_null,
    normalize_columns,
    rename_columns,
    select_columns,
)


def silver_fact(raw: DataFrame) -> DataFrame:
    return nan_to_null(normalize_columns(drop_columns(raw, *S.FACT_DROPPED)))


def silver_dim(raw: DataFrame) -> DataFrame:
    kept = select_columns(raw, list(S.DIM_COLUMNS))
    return nan_to_null(normalize_columns(rename_columns(kept, S.DIM_RENAMED)))
