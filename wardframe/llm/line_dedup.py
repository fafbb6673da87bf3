"""Lines that recur across documents.

Normalised lines are exploded and hashed, distinct documents are counted per
hash, and lines over the threshold are dropped everywhere but in the document
with the largest id. Only hashes and positions are shuffled for that; the kept
lines are put together again by position in one join with the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardframe.llm.common import SPACES, closed, opened, stored

MIN_DOCS = 3
MIN_CHARS = 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line stripped of white space at both ends, A-Z in lower case."""
    stripped = F.btrim(line, F.lit(SPACES))
    ascii_only = F.octet_length(stripped) == F.char_length(stripped)
    return F.when(ascii_only, F.lower(stripped)).otherwise(F.translate(stripped, UPPER, LOWER))


def _lines(body: Column) -> Column:
    return F.split(F.coalesce(body, F.lit("")), "\n", -1)


def _hashed_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """Rows (id, version, at, h1, h2): the long enough lines by position.

    Two hashes of different kinds, 96 bits together, stand for a key. The
    version tells apart rows that share an id but not the text.
    """
    return (
        rows.select("id", F.xxhash64("body").alias("version"), F.posexplode(_lines(F.col("body"))))
        .select("id", "version", F.col("pos").alias("at"), line_key(F.col("col")).alias("key"))
        .filter(F.char_length("key") >= min_chars)
        .select("id", "version", "at", F.xxhash64("key").alias("h1"), F.hash("key").alias("h2"))
    )


def recurring_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows (h1, h2, n_docs, last): keys found in ``min_docs`` distinct ids or more.

    Each (key, id) pair is counted once, merged in every task before the
    shuffle, so a line that a third of all documents share is one record per task.
    """
    rows = _hashed_lines(opened(docs, id_col, text_col), min_chars)
    return (
        rows.groupBy("h1", "h2")
        .agg(F.count_distinct("id").alias("n_docs"), F.max("id").alias("last"))
        .filter(F.col("n_docs") >= min_docs)
    )


def dedup_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with the recurring lines dropped, and ``n_lines`` and ``n_dropped``.

    A key of ``min_chars`` code points or more found in ``min_docs`` distinct
    documents loses all its lines except in the largest id holding it, where
    all its repetitions stay. A null or empty text is one empty line and comes
    back as an empty text. A null id counts as no document: its lines neither
    add to a count nor are spared. Repeated rows are treated alike, each by
    itself. Input columns named ``n_lines`` or ``n_dropped`` are replaced, all
    others pass through. An empty table gives an empty table.
    """
    rows = opened(docs, id_col, text_col)
    recurring = stored(
        recurring_lines(docs, min_docs, min_chars, id_col, text_col).select("h1", "h2", "last"),
        "recurring-lines",
    )
    # The lines come first: a merge join streams its left side, whose hot keys may be split.
    dropped = (
        _hashed_lines(rows, min_chars)
        .join(recurring, ["h1", "h2"])
        .filter(~F.col("id").eqNullSafe(F.col("last")))
        .groupBy("id", "version")
        .agg(F.collect_set("at").alias("gone"))
        .withColumnsRenamed({"id": "gone_id", "version": "gone_version"})
    )
    dropped = stored(dropped, "dropped-lines")
    joined = rows.withColumn("version", F.xxhash64("body")).join(
        dropped,
        F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("version") == F.col("gone_version")),
        "left",
    )
    at = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.transform(F.array_except(at, F.col("gone")), lambda i: F.get(F.col("lines"), i))
    whole = F.coalesce(F.col("body"), F.lit(""))
    cut = joined.withColumn("lines", _lines(F.col("body"))).select(
        "id",
        F.when(F.col("gone").isNull(), whole).otherwise(F.array_join(kept, "\n")).alias("body"),
        "rest",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
    added = {"n_lines": F.col("n_lines"), "n_dropped": F.col("n_dropped")}
    return closed(cut, docs, id_col, text_col, added)
