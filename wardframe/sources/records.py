"""Records of delimited files that may span lines, read in splits.

A line break belongs to a value if an odd number of quotes stands before it. The
quotes of a block are counted by the task that reads it; a running sum over the
blocks of a file, one row each, tells which blocks begin within a value. Then
every task cuts its blocks into records by itself. What a block begins with, if it
begins within a value, is the only text that moves: to the record it completes.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

QUOTE = '"'
WHOLE, OPEN, REST = 0, 1, 2
CUT = "file string, block long, line long, value string, kind int, is_header boolean"


def _physical_lines(
    spark: SparkSession, path: str | Sequence[str], decode: Column | None, pattern: str | None, recursive: bool
) -> DataFrame:
    """Rows (file, block, line, value), blank lines too; only the newline separates."""
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    lines = reader.schema("value string").text(path if isinstance(path, str) else list(path))
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        (F.col("value") if decode is None else decode).alias("value"),
    )


def _cut(batches):
    """Records of the blocks of one task, whose lines come block by block and in order."""
    place, inside, held, seen = None, False, None, False

    def row(kind, line, value):
        """One record, marked if it is the first of its file that is not blank."""
        nonlocal seen
        header = kind != REST and not seen and place[1] == 0 and bool(value.strip())
        seen = seen or header
        return (*place, line, value, kind, header)

    for batch in batches:
        files, blocks = batch.column(0), batch.column(1)
        lines, values, opened = batch.column(2), pc.fill_null(batch.column(3), ""), batch.column(4)
        n = batch.num_rows
        if not n:
            continue
        odd = pc.count_substring(values, QUOTE).to_numpy(zero_copy_only=False) % 2
        codes = files.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        numbers = blocks.to_numpy()
        edge = np.flatnonzero((codes[1:] != codes[:-1]) | (numbers[1:] != numbers[:-1])) + 1
        for a, b in zip([0, *edge.tolist()], [*edge.tolist(), n]):
            rows = []
            here = (files[a].as_py(), int(numbers[a]))
            if here != place:
                if held is not None:
                    rows.append(row(OPEN if inside and held[0] != REST else held[0], held[1], "\n".join(held[2])))
                place, inside, held, seen = here, bool(opened[a].as_py()), None, False
            before = (int(inside) + np.concatenate([[0], np.cumsum(odd[a:b])])) % 2
            starts = np.flatnonzero(before[:-1] == 0)
            inside = bool(before[-1])
            lead = int(starts[0]) if len(starts) else b - a
            if lead:
                text = values.slice(a, lead).to_pylist()
                if held is None:
                    held = (REST, lines[a].as_py(), text)
                else:
                    held[2].extend(text)
            if not len(starts):
                if rows:
                    yield _batch(rows)
                continue
            if held is not None:
                rows.append(row(held[0], held[1], "\n".join(held[2])))
            # All records but the last are complete; the last may go on in the next batch.
            ends = starts[1:]
            whole = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), values.slice(a, b - a))
            texts = pc.binary_join(whole, "\n").to_pylist() if len(ends) else []
            numbered = lines.slice(a, b - a).take(pa.array(starts)).to_pylist()
            rows += [row(WHOLE, at, text) for at, text in zip(numbered, texts)]
            held = (WHOLE, numbered[-1], values.slice(a + int(starts[-1]), b - a - int(starts[-1])).to_pylist())
            yield _batch(rows)
    if held is not None:
        yield _batch([row(OPEN if inside and held[0] != REST else held[0], held[1], "\n".join(held[2]))])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.bool_()]
    names = [part.split()[0] for part in CUT.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def records(
    spark: SparkSession,
    path: str | Sequence[str],
    decode: Column | None = None,
    pattern: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Rows (file, block, line, value, is_header): the records that are not blank.

    Three passes over the files, each in splits: one counts quotes, one finds the
    pieces of records that span blocks, one gives the others. A file of any size
    is read by as many tasks as its size asks for. A record belongs to the block it starts in;
    ``line`` orders the records of a block. ``is_header`` marks the first record
    of a file. Quotes may stand around a value and, doubled, within it; a quote
    elsewhere would be taken for the start of a value. A quote that is never
    closed makes the rest of its file one record.

    ``decode`` makes text of the column ``value`` as read, whose bytes are those
    of the file; newline and quote must be single bytes.
    """
    lines = _physical_lines(spark, path, decode, pattern, recursive)
    n_quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    blocks = lines.groupBy("file", "block").agg(F.sum(n_quotes).alias("quotes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = (
        blocks.withColumn("before", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)))
        .filter("before % 2 = 1")
        .select("file", "block", F.lit(True).alias("opened"))
    )
    # However the few blocks that begin within a value are joined, lines come in order.
    marked = lines.join(inside, ["file", "block"], "left").select(
        "file", "block", "line", "value", F.coalesce("opened", F.lit(False)).alias("opened")
    )
    cut = marked.sortWithinPartitions("line").mapInArrow(_cut, CUT)
    # At most two pieces of a block are parts of a record that spans blocks.
    parts = cut.filter(F.col("kind") != WHOLE)
    upto = Window.partitionBy("file").orderBy("block", F.desc("kind"))
    joined = (
        parts.withColumn("n", F.sum((F.col("kind") == OPEN).cast("int")).over(upto))
        .groupBy("file", "n")
        .agg(F.sort_array(F.collect_list(F.struct("block", "line", "value", "is_header"))).alias("parts"))
        .select(
            "file",
            F.col("parts")[0]["block"].alias("block"),
            F.col("parts")[0]["line"].alias("line"),
            F.array_join(F.col("parts.value"), "\n").alias("value"),
            F.exists("parts", lambda p: p["is_header"]).alias("is_header"),
        )
    )
    whole = cut.filter(F.col("kind") == WHOLE).select(*joined.columns)
    return whole.unionByName(joined).filter(F.length(F.trim(F.regexp_replace("value", r"[\r\n]", ""))) > 0)
