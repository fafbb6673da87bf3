"""Exact quantiles by narrowing, and the outlier counts built on them.

A quantile needs the values at two neighbouring ranks. Sorting a whole column,
or gathering its distinct values in one aggregate buffer, does not scale. Here
a mergeable quantile sketch gives two values around each wanted rank, and one
more pass counts what lies below, at, between and above them. The ranks are
then in a part that holds a small share of the values, whatever these are, and
so on until one task can order it. A round is two passes and leaves a few
thousandths of the values; their number alone decides how many rounds there
are. Sketches and counts are shuffled, never rows, so that a value holding a
third of all rows costs no more than another. Infinite values are refused, at
any size, since no fence or bin could be drawn around them.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardframe.operators.columns import number, numbers_long, numeric_columns, quoted
from wardframe.operators.profile import is_missing
from wardframe.operators.rows import outside

# Values one task may order at the end; more are narrowed down first.
VALUES_PER_TASK = 1_000_000
# A sketch misses a rank by the number of values over this, or less, in 99 of 100 cases.
SKETCH_ACCURACY = 2000

# The quartiles and the reach of the fences beyond them.
QUARTILES = (0.25, 0.75)
FENCE_REACH = 1.5


@dataclass(frozen=True)
class Bracket:
    """Values of a column between two bounds, inclusive."""

    column: str
    lo: float
    hi: float
    below: int  # how many values lie below ``lo``
    inside: int


def _of_bracket(numbers: Sequence[float]) -> Column:
    """The number that belongs to the row's bracket."""
    return F.element_at(F.array(*[F.lit(n) for n in numbers]), F.col("bracket") + 1)


def _bracketed(df: DataFrame, brackets: Sequence[Bracket]) -> DataFrame:
    """Rows (bracket, value): each value once per bracket that holds it.

    The bounds are compared after the columns are stacked. One comparison per
    column before that makes code too long for the JVM to compile.
    """
    stacked = numbers_long(df, [number(b.column) for b in brackets])
    lows, highs = _of_bracket([b.lo for b in brackets]), _of_bracket([b.hi for b in brackets])
    return stacked.withColumnRenamed("series", "bracket").filter(F.col("value").between(lows, highs))


def _holds_rank(wanted: Mapping[int, set[int]]) -> Column:
    """True where the running count passes a wanted rank of the bracket."""
    passes = [
        f"(bracket = {i} AND upto - n <= {r} AND upto > {r})"
        for i, ranks in wanted.items()
        for r in sorted(ranks)
    ]
    return F.expr(" OR ".join(passes))


def _running(counts: DataFrame, order: str) -> DataFrame:
    """Adds ``upto``: values of the bracket up to and including this row.

    A bracket has a few parts or at most VALUES_PER_TASK rows here.
    """
    in_bracket = Window.partitionBy("bracket").orderBy(order)
    return counts.withColumn("upto", F.sum("n").over(in_bracket))


def _cuts(
    df: DataFrame, brackets: Sequence[Bracket], wanted: Mapping[int, set[int]], accuracy: int
) -> list[list[float]]:
    """One pass: for each bracket values of it a little below and above each wanted rank."""
    reach = 1.5 / accuracy
    places = {
        i: [p for r in wanted[i] for p in ((r + 0.5) / b.inside - reach, (r + 0.5) / b.inside + reach)]
        for i, b in enumerate(brackets)
    }
    asked = {i: sorted({min(max(p, 0.0), 1.0) for p in ps}) for i, ps in places.items()}
    kept = min(max(math.ceil((2.296 * accuracy) ** 1.1085), 8), 65535)
    # A sketch per bracket in one row, without stacking. The numbers are projected once per column.
    columns = list(dict.fromkeys(b.column for b in brackets))
    numbers = df.select(*[number(c).alias(f"{i}") for i, c in enumerate(columns)])
    value = [F.col(f"{columns.index(b.column)}") for b in brackets]
    sketches = numbers.agg(
        *[
            F.kll_sketch_agg_double(F.when(v.between(b.lo, b.hi), v), F.lit(kept)).alias(f"{i}")
            for i, (b, v) in enumerate(zip(brackets, value))
        ]
    )
    at = lambda i: F.array(*[F.lit(p) for p in asked[i]])
    found = sketches.select(*[F.kll_sketch_get_quantile_double(f"{i}", at(i)).alias(f"{i}") for i in asked]).first()
    return [sorted(set(found[i])) for i in range(len(brackets))]


def _narrow(
    df: DataFrame, brackets: Sequence[Bracket], wanted: Mapping[int, set[int]], accuracy: int
) -> list[Bracket]:
    """One round: for each bracket, the parts between two cuts that hold a wanted rank.

    The parts are counted, so a sketch that misses costs a round, not the result.
    """
    cuts = _cuts(df, brackets, wanted, accuracy)
    most = max(map(len, cuts))
    part = F.lit(0)
    for k in range(most):
        # The last cut again where a bracket has fewer than the others.
        cut = _of_bracket([c[min(k, len(c) - 1)] for c in cuts])
        part = part + (F.col("value") > cut).cast("int") + (F.col("value") >= cut).cast("int")
    counts = (
        _bracketed(df, brackets)
        .groupBy("bracket", part.alias("part"))
        .agg(
            F.count("*").alias("n"),
            F.min("value").alias("lo"),
            F.max("value").alias("hi"),
        )
    )
    found = _running(counts, "part").filter(_holds_rank(wanted)).collect()
    return [
        Bracket(
            column=brackets[row.bracket].column,
            lo=row.lo,
            hi=row.hi,
            below=brackets[row.bracket].below + row.upto - row.n,
            inside=row.n,
        )
        for row in found
    ]


def _values_at(
    df: DataFrame, ranks: Mapping[str, set[int]], whole: Sequence[Bracket], limit: int, accuracy: int
) -> dict[tuple[str, int], float]:
    """The value at each wanted rank (from 0) of each column."""

    def wanted_in(brackets: Sequence[Bracket]) -> dict[int, set[int]]:
        return {
            i: {r - b.below for r in ranks[b.column] if b.below <= r < b.below + b.inside}
            for i, b in enumerate(brackets)
        }

    brackets = list(whole)
    while wide := [b for b in brackets if b.inside > limit and b.lo < b.hi]:
        settled = [b for b in brackets if b not in wide]
        brackets = settled + _narrow(df, wide, wanted_in(wide), accuracy)

    values = {}
    several = [b for b in brackets if b.lo < b.hi]
    if several:
        counts = _bracketed(df, several).groupBy("bracket", "value").agg(F.count("*").alias("n"))
        wanted = wanted_in(several)
        for row in _running(counts, "value").filter(_holds_rank(wanted)).collect():
            bracket = several[row.bracket]
            for r in wanted[row.bracket]:
                if row.upto - row.n <= r < row.upto:
                    values[bracket.column, r + bracket.below] = row.value
    for i, local in wanted_in(brackets).items():
        if brackets[i].lo == brackets[i].hi:
            values.update({(brackets[i].column, r + brackets[i].below): brackets[i].lo for r in local})
    return values


def _ends(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple]:
    """Per column the number of values, the least and the greatest."""
    row = df.agg(
        *[
            f(number(c)).alias(f"{name}{i}")
            for i, c in enumerate(columns)
            for name, f in (("n", F.count), ("lo", F.min), ("hi", F.max))
        ]
    ).first()
    return {c: (row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(columns)}


def column_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    limit: int = VALUES_PER_TASK,
    accuracy: int = SKETCH_ACCURACY,
    ends: Mapping[str, tuple[int, float | None, float | None]] | None = None,
) -> dict[str, list[float | None]]:
    """Exact quantiles per column, linear between neighbouring values.

    Runs its passes now; what reaches the driver is a few numbers per column.
    A column without values gives None, one with infinite values an error.
    ``ends`` spares the first pass where the number of values and the least and
    greatest of each column are known.
    """
    if not columns:
        return {}
    if ends is None:
        ends = _ends(df, columns)
    endless = [c for c in columns if any(v is not None and math.isinf(v) for v in ends[c][1:])]
    if endless:
        raise ValueError(f"infinite values in {endless}; replace them before taking quantiles")
    whole = [Bracket(c, ends[c][1], ends[c][2], 0, ends[c][0]) for c in columns if ends[c][0]]
    places = {b.column: [(b.inside - 1) * p for p in probabilities] for b in whole}
    ranks = {
        c: {edge for at in ats for edge in (math.floor(at), math.ceil(at))}
        for c, ats in places.items()
    }
    values = _values_at(df, ranks, whole, limit, accuracy) if whole else {}

    def between(column: str, at: float) -> float:
        low, high = values[column, math.floor(at)], values[column, math.ceil(at)]
        return low + (high - low) * (at - math.floor(at))

    return {
        c: [between(c, at) for at in places[c]] if c in places else [None] * len(probabilities)
        for c in columns
    }


def quantiles(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    probabilities: Sequence[float] = QUARTILES,
    **limits,
) -> DataFrame:
    """Rows (column, probability, value); all numeric columns by default."""
    found = column_quantiles(df, numeric_columns(df) if columns is None else columns, probabilities, **limits)
    rows = [(c, float(p), v) for c, vs in found.items() for p, v in zip(probabilities, vs)]
    return df.sparkSession.createDataFrame(rows, "column string, probability double, value double")


def fences(
    df: DataFrame, columns: Sequence[str] | None = None, **limits
) -> dict[str, tuple[float, float]]:
    """Per column the bounds beyond which a value is an outlier; none without values."""
    found = column_quantiles(df, numeric_columns(df) if columns is None else columns, QUARTILES, **limits)
    bounds = {}
    for column, (q1, q3) in found.items():
        if q1 is not None:
            reach = FENCE_REACH * (q3 - q1)
            bounds[column] = (q1 - reach, q3 + reach)
    return bounds


def _is_outlier(df: DataFrame, column: str, bounds: Mapping[str, tuple[float, float]]) -> Column:
    """Beyond its fences; false for a missing value."""
    if column not in bounds:
        return F.lit(False)
    return ~is_missing(df, column) & outside(quoted(column), *bounds[column])


def outlier_flags(df: DataFrame, columns: Sequence[str] | None = None, **limits) -> DataFrame:
    """``df`` with each numeric column replaced by whether its value is an outlier."""
    columns = numeric_columns(df) if columns is None else columns
    bounds = fences(df, columns, **limits)
    return df.select(
        *[
            _is_outlier(df, c, bounds).alias(c) if c in set(columns) else quoted(c)
            for c in df.columns
        ]
    )


def outlier_counts(df: DataFrame, columns: Sequence[str] | None = None, **limits) -> DataFrame:
    """Rows (column, lower, upper, n_outliers): the fences and the values beyond them."""
    columns = numeric_columns(df) if columns is None else columns
    bounds = fences(df, columns, **limits)
    counts = df.agg(
        *[F.count_if(_is_outlier(df, c, bounds)).alias(f"n{i}") for i, c in enumerate(columns)]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(bounds.get(c, (None, None))[0]).cast("double").alias("lower"),
            F.lit(bounds.get(c, (None, None))[1]).cast("double").alias("upper"),
            F.col(f"n{i}").alias("n_outliers"),
        )
        for i, c in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*rows)))
