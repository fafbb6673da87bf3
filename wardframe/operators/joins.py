"""Equi-joins of a large table with a dimension of unknown size."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wardframe.operators.columns import quoted


def join_dimension(
    dim: DataFrame,
    fact: DataFrame,
    dim_key: str,
    fact_key: str,
    suffixes: tuple[str, str],
    null_safe: bool = False,
    slices: str | None = None,
) -> DataFrame:
    """Inner join that keeps both keys; other names on both sides get a suffix.

    Names clash as they do for Spark, in any case. The planner broadcasts a
    dimension that it knows to be small, also one that turns out so while the
    query runs. Otherwise both sides are shuffled on the key, where adaptive
    execution splits a partition that one hot key has made too large. With
    ``null_safe``, null keys match. With ``slices``, a column of both sides that
    has to match as well and is left out, both are merged as they are stored.
    """
    clashing = {c.lower() for c in dim.columns} & {c.lower() for c in fact.columns}
    dim_names = {c: c + suffixes[0] for c in dim.columns if c.lower() in clashing}
    fact_names = {c: c + suffixes[1] for c in fact.columns if c.lower() in clashing}
    dim, fact = dim.withColumnsRenamed(dim_names), fact.withColumnsRenamed(fact_names)
    dim_column = dim[dim_names.get(dim_key, dim_key)]
    fact_column = fact[fact_names.get(fact_key, fact_key)]
    matches = fact_column.eqNullSafe(dim_column) if null_safe else fact_column == dim_column
    if slices:
        matches = matches & (fact[fact_names[slices]] == dim[dim_names[slices]])
        dim = dim.hint("merge")
    # The fact comes first: a merge join streams its left side and holds the
    # right side's rows of one key in memory, which must not be the hot ones.
    joined = fact.join(dim, matches, "inner")
    shown = [c for c in (*dim.columns, *fact.columns) if not slices or c not in (dim_names[slices], fact_names[slices])]
    return joined.select(*[quoted(c) for c in shown])
