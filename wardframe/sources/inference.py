"""Types of text columns, found in one aggregate over all columns.

Each value has a set of types that it fits, as bits. The set of a column is what
all its values share, so sets of parts of a table merge by ``bit_and``, in any
order and any number of tasks. The narrowest type of the set is the column's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardframe.operators.columns import quoted

INT, LONG, DOUBLE, BOOLEAN, DATE, TIMESTAMP = (1 << i for i in range(6))
ANY = (1 << 6) - 1
# The narrowest type first.
TYPES = (
    (INT, T.IntegerType()),
    (LONG, T.LongType()),
    (DOUBLE, T.DoubleType()),
    (BOOLEAN, T.BooleanType()),
    (DATE, T.DateType()),
    (TIMESTAMP, T.TimestampType()),
)

WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*$"
NUMBER = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"
INFINITE = r"(?i)^\s*[+-]?inf(inity)?\s*$"
DAY = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
MOMENT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?"


def _fits(text: Column) -> Column:
    """The types that a text fits, as bits."""
    as_int, as_long = text.try_cast("int").isNotNull(), text.try_cast("long").isNotNull()
    whole = F.when(as_int, INT | LONG | DOUBLE).when(as_long, LONG | DOUBLE).otherwise(DOUBLE)
    return (
        F.when(text.rlike(WHOLE_NUMBER), whole)
        .when(text.rlike(NUMBER) | text.rlike(INFINITE), DOUBLE)
        .when(F.lower(text).isin("true", "false"), BOOLEAN)
        .when(text.rlike(DAY) & text.try_cast("date").isNotNull(), DATE | TIMESTAMP)
        .when(text.rlike(MOMENT) & text.try_cast("timestamp").isNotNull(), TIMESTAMP)
        .otherwise(0)
    )


def infer_types(
    texts: DataFrame, keys: Sequence[str] = (), missing: Sequence[str] = (), like_pandas: bool = False
) -> dict[str, T.DataType]:
    """The type of every column of ``texts``, in one pass that is run now.

    Null, an empty text and each of ``missing`` fit any type. ``keys``, in any
    case, stay text. A column without any value is text. Whole numbers beyond 64
    bits count as doubles. Leading zeros do not make a number a text.

    With ``like_pandas`` the types are those that pandas would choose: whole
    numbers are 64 bits wide, or doubles where a value is missing; a column
    without any value is double; truth values with a missing one, dates and
    moments are text.
    """
    as_text = {k.lower() for k in keys}
    names = [c for c in texts.columns if c.lower() not in as_text]
    types: dict[str, T.DataType] = {c: T.StringType() for c in texts.columns}
    if not names:
        return types
    found = []
    for i, name in enumerate(names):
        absent = quoted(name).isNull() | quoted(name).isin("", *missing)
        found.append(F.bit_and(F.when(~absent, _fits(quoted(name)))).alias(f"fits{i}"))
        found.append(F.count_if(absent).alias(f"absent{i}"))
    row = texts.agg(*found).first()
    for i, name in enumerate(names):
        fits, absent = row[f"fits{i}"], row[f"absent{i}"] > 0
        if like_pandas:
            types[name] = _like_pandas(ANY if fits is None else fits, absent or fits is None)
        elif fits is not None:
            types[name] = next((kind for bit, kind in TYPES if fits & bit), T.StringType())
    return types


def _like_pandas(fits: int, absent: bool) -> T.DataType:
    if fits & LONG and not absent:
        return T.LongType()
    if fits & DOUBLE:
        return T.DoubleType()
    if fits & BOOLEAN and not absent:
        return T.BooleanType()
    return T.StringType()
