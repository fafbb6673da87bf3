"""Statistics kept per month, merged when they are read.

Each group has a row per column: counts, ends, a sketch of the distinct values and
one of the ranks. Statistics of any set of months come from these rows alone, and a
month that is written anew replaces its own. Counts and ends are exact. A
distinct count is within ``DISTINCT_ERROR`` of the exact one, the rank of a quantile
within ``RANK_ERROR`` of all values, the two ends of a bin of a histogram as well. Both
bounds are three standard errors or more of the sketches.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardframe.operators.columns import number, numeric_columns, quoted
from wardframe.operators.profile import is_missing

# Sizes of the sketches, and what they are good for.
DISTINCT_LOG_SIZE, DISTINCT_ERROR = 14, 0.03
RANKS_KEPT, RANK_ERROR = 800, 0.01
# Columns of one pass. Many more make code too long for the JVM to compile.
COLUMNS_PER_PASS = 7


def _identity(df: DataFrame, column: str) -> Column:
    """A hash that is equal for equal values, null for a missing one."""
    value = quoted(column)
    if dict(df.dtypes)[column] in ("float", "double"):
        value = value + F.lit(0.0)  # -0.0 equals 0.0
    return F.when(~is_missing(df, column), F.xxhash64(value))


def sketched(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (by..., column, n_rows, n_present, least, greatest, values, ranks).

    A pass over ``df`` reads ``by`` and some columns, so that each column is read once.
    Sketches are merged before the shuffle: a row per group and task reaches it,
    whatever the number of rows of a group. Texts have no ends and ranks. A group
    may be null; a table without rows gives none, or counts of 0 where ``by`` is empty.
    """
    columns = [c for c in df.columns if c not in by] if columns is None else list(columns)
    passes = -(-len(columns) // COLUMNS_PER_PASS)
    # Neighbours are dealt to several passes, since texts and numbers come in runs.
    return reduce(DataFrame.unionByName, [_sketched(df, by, columns[i::passes]) for i in range(passes)])


def _sketched(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The rows of ``sketched`` for some columns, in one pass."""
    numbers = set(numeric_columns(df))
    # Identities and numbers are projected first: an aggregate would interpret them for each sketch.
    same = [_identity(df, c).alias(f"same{i}") for i, c in enumerate(columns)]
    values = [number(c).alias(f"number{i}") for i, c in enumerate(columns) if c in numbers]
    groups = [quoted(b).alias(f"group{i}") for i, b in enumerate(by)]
    found = [F.count("*").alias("n_rows")]
    for i, c in enumerate(columns):
        found += [F.count(f"same{i}").alias(f"n{i}"), F.hll_sketch_agg(f"same{i}", F.lit(DISTINCT_LOG_SIZE)).alias(f"v{i}")]
        if c in numbers:
            ends = [F.min(f"number{i}").alias(f"lo{i}"), F.max(f"number{i}").alias(f"hi{i}")]
            found += [*ends, F.kll_sketch_agg_double(f"number{i}", F.lit(RANKS_KEPT)).alias(f"r{i}")]

    def of_number(name: str, i: int, c: str, kind: str) -> Column:
        return F.col(f"{name}{i}") if c in numbers else F.lit(None).cast(kind)

    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("n_rows").alias("n_rows"),
            F.col(f"n{i}").alias("n_present"),
            of_number("lo", i, c, "double").alias("least"),
            of_number("hi", i, c, "double").alias("greatest"),
            F.col(f"v{i}").alias("values"),
            of_number("r", i, c, "binary").alias("ranks"),
        )
        for i, c in enumerate(columns)
    ]
    counted = df.select(*groups, *same, *values).groupBy(*[f"group{i}" for i in range(len(by))]).agg(*found)
    return counted.select(*[F.col(f"group{i}").alias(b) for i, b in enumerate(by)], F.inline(F.array(*rows)))


def replaced(kept: DataFrame, fresh: DataFrame, by: Sequence[str]) -> DataFrame:
    """``kept`` with the groups that ``fresh`` has taken from there."""
    groups = fresh.select(*[F.col(b).alias(f"new_{b}") for b in by]).distinct()
    same = F.lit(True)
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"new_{b}"))
    return kept.join(groups, same, "left_anti").unionByName(fresh)


def merged(kept: DataFrame) -> DataFrame:
    """Rows (column, n_rows, n_present, least, greatest, n_distinct) over all groups of ``kept``."""
    return kept.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_present").alias("n_present"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        F.hll_sketch_estimate(F.hll_union_agg("values")).alias("n_distinct"),
    )


def _ranks(kept: DataFrame) -> DataFrame:
    """Rows (column, n, least, greatest, ranks) of the columns that have numbers."""
    filled = kept.filter("ranks IS NOT NULL AND n_present > 0").groupBy("column")
    return filled.agg(
        F.sum("n_present").alias("n_present"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        F.kll_merge_agg_double("ranks").alias("ranks"),
    )


def merged_quantiles(kept: DataFrame, shares: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Rows (column, share, value): a value of the column near each share of its values."""
    found = [
        F.struct(F.lit(float(s)).alias("share"), F.kll_sketch_get_quantile_double("ranks", F.lit(float(s))).alias("value"))
        for s in shares
    ]
    return _ranks(kept).select("column", F.inline(F.array(*found)))


def merged_histogram(kept: DataFrame, bins: int = 50) -> DataFrame:
    """Rows (column, bin, bin_start, bin_end, n) of bins of one width, as ``histogram`` draws them.

    Asks for the ends of each column first, since a sketch is asked for ranks at
    constants; two numbers per column reach the driver. Infinite ends are refused.
    """
    ranks = _ranks(kept)
    ends = {row.column: (row.least, row.greatest) for row in ranks.select("column", "least", "greatest").collect()}
    endless = [c for c, both in ends.items() if any(map(math.isinf, both))]
    if endless:
        raise ValueError(f"infinite values in {endless}; replace them before drawing bins")
    borders, shares = F.lit(None).cast("array<double>"), F.lit(None).cast("array<double>")
    for column, (least, greatest) in ends.items():
        single = 0.5 if least == greatest else 0.0
        lo, hi = least - single, greatest + single
        edges = [*[lo + i * ((hi - lo) / bins) for i in range(bins)], hi]
        # A rank counts the values up to its edge; those at an edge are of the next bin.
        below = [F.lit(math.nextafter(e, -math.inf)) for e in edges[:-1]] + [F.lit(hi)]
        of_column = F.col("column") == column
        borders = F.when(of_column, F.array(*map(F.lit, edges))).otherwise(borders)
        shares = F.when(of_column, F.kll_sketch_get_rank_double("ranks", F.array(*below))).otherwise(shares)
    upto = F.transform("shares", lambda share: F.round(share * F.col("n_present")).cast("long"))
    placed = ranks.select("column", "n_present", borders.alias("borders"), shares.alias("shares"))
    edge = lambda name, at: F.element_at(name, F.col("bin") + at)
    return placed.select(
        "column", "borders", upto.alias("upto"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    ).select(
        "column",
        "bin",
        edge("borders", 1).alias("bin_start"),
        edge("borders", 2).alias("bin_end"),
        (edge("upto", 2) - edge("upto", 1)).alias("n"),
    )
