"""Parquet tables and path handling."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardframe.operators.columns import quoted
from wardframe.session import shuffles_released


def join_path(base: str, *parts: str) -> str:
    """Path below ``base``, whether or not it ends in a slash."""
    return "/".join([base.rstrip("/"), *(p.strip("/") for p in parts)])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_parts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All parts as one table; a column missing from a part is null there.

    Parts may disagree on the type of a column: the schemas are read from the
    footers of the files, by tasks, and the column gets the narrowest type that
    holds all of theirs. Where there is none, the error names column and files.
    """
    files = files_below(spark, paths)
    kinds = _schemas(spark, files)
    if len(kinds) <= 1:
        return spark.read.option("mergeSchema", True).parquet(*paths)
    wanted = reconciled([(spark.read.parquet(k.example).schema, k.example) for k in kinds])
    frames = []
    for kind in kinds:
        part = spark.read.parquet(*kind.files)
        have = {c.lower(): c for c in part.columns}
        values = [
            (quoted(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in wanted
        ]
        frames.append(part.select(*values))
    return reduce(DataFrame.unionByName, frames)


def files_below(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Rows (path, length, modified) of the Parquet files below ``paths``; no file is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = listed.option("pathGlobFilter", "*.parquet").load(list(paths))
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def _footers(batches):
    from pyarrow import fs, parquet

    for batch in batches:
        found = []
        for path in batch.column(0).to_pylist():
            store, place = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
            with store.open_input_file(place) as file:
                schema = parquet.read_schema(file).remove_metadata()
            found.append("\n".join(f"{f.name}\t{f.type}" for f in schema))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["path", "kind"])


def _schemas(spark: SparkSession, files: DataFrame) -> list[Row]:
    """One row per different schema of the files: an example, and the files that have it."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kinds = files.select("path").repartition(tasks, "path").mapInArrow(_footers, "path string, kind string")
    grouped = kinds.groupBy("kind").agg(F.min("path").alias("example"), F.sort_array(F.collect_list("path")).alias("files"))
    return grouped.orderBy("example").collect()


# The narrower type first; each holds all values of those before it.
WHOLE_NUMBERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
DIGITS = dict(zip(WHOLE_NUMBERS, (3, 5, 10, 19)))


def common_type(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """The narrowest type that both convert to; None if there is none.

    A whole number or a decimal beside a float or double is a double, as it is for
    any sum of the two; whole numbers beyond 2^53 then lose their last digits.
    """
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    if one in WHOLE_NUMBERS and other in WHOLE_NUMBERS:
        return max(one, other, key=WHOLE_NUMBERS.index)
    floating = (T.FloatType, T.DoubleType)
    numeric = (*floating, T.DecimalType, *map(type, WHOLE_NUMBERS))
    if isinstance(one, numeric) and isinstance(other, numeric):
        if isinstance(one, floating) or isinstance(other, floating):
            return T.DoubleType()
        whole, parts = zip(*[_places(t) for t in (one, other)])
        total = max(whole) + max(parts)
        return T.DecimalType(total, max(parts)) if total <= 38 else None
    if {type(one), type(other)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return None


def _places(kind: T.DataType) -> tuple[int, int]:
    """Digits before and after the point."""
    return (kind.precision - kind.scale, kind.scale) if isinstance(kind, T.DecimalType) else (DIGITS[kind], 0)


def reconciled(schemas: Sequence[tuple[T.StructType, str]]) -> T.StructType:
    """One schema for all of (schema, file): columns in order of appearance, in their common types."""
    found: dict[str, tuple[str, T.DataType, str]] = {}
    for schema, file in schemas:
        for f in schema:
            name, kind, first = found.get(f.name.lower(), (f.name, f.dataType, file))
            common = common_type(kind, f.dataType)
            if common is None:
                have, other = kind.simpleString(), f.dataType.simpleString()
                raise TypeError(f"column {name} is {have} in {first} and {other} in {file}")
            found[f.name.lower()] = (name, common, first)
    return T.StructType([T.StructField(name, kind) for name, kind, _ in found.values()])


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    lookup_by: Sequence[str] = (),
    max_records_per_file: int = 0,
    append: bool = False,
    last: Callable[[DataFrame], DataFrame] | None = None,
    folders: Sequence[str] = (),
) -> None:
    """Replace the table at ``path``; with ``append``, add to it.

    ``lookup_by`` columns get a Bloom filter per row group, so that a search
    for one value skips the row groups without it, at no cost of a shuffle.

    A partitioned table is first dealt out by its partition columns, so that a
    partition is a few files of good size, not one per task; a partition that
    holds much of the table is split over tasks. ``last`` is applied to the rows
    as they are dealt out, right before the write; it may add the columns ``folders``, by
    which the files of a partition are told apart in folders below its own. The files of the
    shuffle that deals rows out go when the write ends.

    Overwriting deletes first and is not a transaction: one writer per path,
    and never read and write one path in the same plan. Tables that belong
    together are published by ``versions.Publication``.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if last:
        df = last(df)
    writer = df.write.mode("append" if append else "overwrite")
    for column in lookup_by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if not partition_by:
        writer.parquet(path)
        return
    with shuffles_released(df.sparkSession):
        writer.partitionBy(*partition_by, *folders).parquet(path)
