"""Repeated rows and repeated keys.

Every count is partially aggregated before its shuffle, so that a row or key
that holds a third of the table arrives as one record per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.operators.columns import quoted

# Copies written by one task when counted rows are spelled out again.
COPIES_PER_BLOCK = 100_000


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, null taken as a value, with their count."""
    counts = df.groupBy(*[quoted(k) for k in keys]).agg(F.count("*").alias("copies"))
    return counts.filter("copies > 1")


def has_repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: whether any key value occurs more than once."""
    return repeated_keys(df, keys).agg((F.count("*") > 0).alias("has_duplicates"))


def repeated_rows(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, each listed once with its ``copies``.

    First 8-byte hashes are counted, then only rows whose hash recurs are
    compared in full. Where rows have to be dealt out to meet those hashes, they
    are looked up in a hash table of these and not sorted: sorting spills every
    row at full width, the table holds 8 bytes a hash.
    """
    row_hash = F.xxhash64(*[quoted(c) for c in df.columns])
    counts = df.select(row_hash.alias("_row_hash")).groupBy("_row_hash").agg(F.count("*").alias("n"))
    # Another form of the hash: were the counts already dealt out by the key of
    # the join, the rows of a hot hash could not be split over tasks there.
    turned = F.bitwise_not("_row_hash").alias("_turned_hash")
    recurring = counts.filter("n > 1").select(turned)
    suspects = (
        df.withColumn("_turned_hash", F.bitwise_not(row_hash))
        .join(recurring.hint("shuffle_hash"), "_turned_hash", "left_semi")
        .drop("_turned_hash")
    )
    return repeated_keys(suspects, df.columns)


def has_repeated_rows(df: DataFrame) -> DataFrame:
    """One row: whether any row occurs more than once."""
    return repeated_rows(df).agg((F.count("*") > 0).alias("has_duplicates"))


def extra_copies(df: DataFrame, block: int = COPIES_PER_BLOCK) -> DataFrame:
    """Every row that repeats an earlier one: all copies but the first.

    Copies are equal in every column, so it does not matter which one is
    first. They are spelled out from their count in blocks spread over all
    tasks; no task writes all the copies of one row.
    """
    rows = [quoted(c) for c in df.columns]
    extra = F.col("copies") - 1
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((extra - 1) / block))
    size = F.least(F.lit(block).cast("long"), extra - F.col("_block") * block)
    # A stated number of partitions is not merged by their small size in bytes.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        repeated_rows(df)
        .select(*rows, "copies", F.explode(blocks).alias("_block"))
        .repartition(tasks, "_block", *rows)
        .select(*rows, F.explode(F.sequence(F.lit(1).cast("long"), size)).alias("_copy"))
        .drop("_copy")
    )
