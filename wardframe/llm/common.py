"""What the operators share: column handling, stored intermediates, white space."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardframe.session import scratch_path

# The white space of the word and line rules, \x20 and \x09-\x0D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SPACED = r"[^\x20\x09-\x0D]"


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Later jobs start from the files, so a lost executor costs no recomputation
    of what came before, and the planner knows the size of the table.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def opened(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns ``id``, ``body`` and ``rest``, a struct of all other columns.

    Inside an operator no column of the caller can then clash with its own.
    """
    others = [c for c in docs.columns if c.lower() not in (id_col.lower(), text_col.lower())]
    rest = F.struct(*[quoted(c) for c in others]) if others else F.lit(None).cast("string")
    return docs.select(
        quoted(id_col).alias("id"), quoted(text_col).alias("body"), rest.alias("rest")
    )


def closed(
    df: DataFrame, docs: DataFrame, id_col: str, text_col: str, added: dict[str, Column]
) -> DataFrame:
    """The columns of ``docs`` in their order, from ``opened`` form, then ``added``.

    An added column takes the place of an input column of the same name.
    """
    taken = {name.lower() for name in added}
    kept = []
    for c in docs.columns:
        if c.lower() in taken:
            continue
        if c.lower() == id_col.lower():
            kept.append(F.col("id").alias(c))
        elif c.lower() == text_col.lower():
            kept.append(F.col("body").alias(c))
        else:
            kept.append(F.col("rest").getField(c).alias(c))
    return df.select(*kept, *[value.alias(name) for name, value in added.items()])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once per row.

    A filter that the planner moves below a projection takes the projection's
    expressions with it. A column used inside a lambda would then be computed
    again for every element; a variable of a lambda is not.
    """
    return F.get(F.transform(F.array(value), body), 0)


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_RUN)).otherwise(
        F.array().cast("array<string>")
    )


def crc32_rest(id_col: Column, parts: int) -> Column:
    """crc32 of the id's decimal text, modulo ``parts``; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % parts
