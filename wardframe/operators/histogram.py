"""Equal-width histograms of many columns in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.operators.columns import number, numbers_long, numeric_columns


def _range(
    df: DataFrame, columns: Sequence[str], bins: int, known: Mapping[str, tuple] | None
) -> DataFrame:
    """One row: per column its lower end, upper end and bin width, as an array.

    A column with one value gets a range of 1 around it, an empty one 0 to 1.
    Infinite values are an error when the query runs.
    """
    if known is None:
        ends = df.agg(
            *[
                f(number(c)).alias(f"{end}{i}")
                for i, c in enumerate(columns)
                for end, f in (("lo", F.min), ("hi", F.max))
            ]
        )
    else:
        values = [
            F.lit(known[c][at]).cast("double").alias(f"{end}{i}")
            for i, c in enumerate(columns)
            for end, at in (("lo", 1), ("hi", 2))
        ]
        ends = df.sparkSession.range(1).select(*values)
    ranges = []
    for i in range(len(columns)):
        least, most = F.col(f"lo{i}"), F.col(f"hi{i}")
        endless = least.isin(float("inf"), float("-inf")) | most.isin(float("inf"), float("-inf"))
        message = F.lit(f"infinite values in {columns[i]}; replace them before drawing bins")
        least = F.when(endless, F.raise_error(message)).otherwise(least)
        single = F.when(least == most, 0.5).otherwise(0.0)
        lo, hi = F.coalesce(least - single, F.lit(0.0)), F.coalesce(most + single, F.lit(1.0))
        ranges.append(F.struct(lo.alias("lo"), hi.alias("hi"), ((hi - lo) / bins).alias("width")))
    return ends.select(F.array(*ranges).alias("ranges"))


def histogram(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    bins: int = 50,
    ends: Mapping[str, tuple[int, float | None, float | None]] | None = None,
) -> DataFrame:
    """Rows (column, bin, bin_start, bin_end, n), empty bins included.

    A bin holds ``bin_start <= value < bin_end``; the last one also its end.
    Only bin counts are shuffled: at most ``bins`` rows per column and task.
    ``ends``, as of a table summary, spares the pass that looks for the range.
    """
    columns = numeric_columns(df) if columns is None else columns
    # A scalar subquery: run once over the table, then a constant of the plan.
    ranges = _range(df, columns, bins, ends).scalar()
    series = F.col("series")
    lo, hi, width = (F.element_at(ranges, series + 1)[end] for end in ("lo", "hi", "width"))

    values = numbers_long(df, [number(c) for c in columns])
    value, guess = F.col("value"), F.col("guess")
    # The division may land one bin beside the edges that are reported.
    bin_of_value = (
        guess
        - F.when(value < lo + guess * width, 1).otherwise(0)
        + F.when((guess < bins - 1) & (value >= lo + (guess + 1) * width), 1).otherwise(0)
    )
    counts = (
        values.withColumn(
            "guess", F.least(F.floor((value - lo) * bins / (hi - lo)), F.lit(bins - 1))
        )
        .groupBy("series", bin_of_value.cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )

    names = F.array(*[F.lit(c) for c in columns])
    grid = df.sparkSession.range(len(columns)).select(
        F.col("id").cast("int").alias("series"),
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
    )
    bin_start, next_start = (lo + (F.col("bin") + i) * width for i in (0, 1))
    return grid.join(counts, ["series", "bin"], "left").select(
        F.element_at(names, series + 1).alias("column"),
        "bin",
        bin_start.alias("bin_start"),
        F.when(F.col("bin") == bins - 1, hi).otherwise(next_start).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
