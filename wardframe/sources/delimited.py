"""CSV scans with declared types, and checks on raw headers."""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wardframe.operators.columns import quoted
from wardframe.sources.inference import infer_types
from wardframe.sources.records import records

# Fixed value: charsets Spark reads from CSV by itself.
SPARK_CHARSETS = ("utf-8", "us-ascii", "iso-8859-1", "utf-16", "utf-16be", "utf-16le", "utf-32")
WIDE_CHARSETS = ("utf-16", "utf-16be", "utf-16le", "utf-32")

# Fixed value: texts that stand for a missing value in exported tables.
MISSING_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# A comma followed by an even number of quotes, that is, outside any quoted name.
COMMA_OUTSIDE_QUOTES = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
# No file holds this character, so that a line is one value.
NO_SEPARATOR = "\x01"


class Charset:
    """How Spark reads a charset: by itself, or as Latin-1 with some characters replaced.

    Any charset of one byte per character whose lower half is ASCII can be read
    the second way, without a setting of the session.
    """

    def __init__(self, name: str):
        self.spark_name, self.read, self.meant = name, "", ""
        if name.lower() in SPARK_CHARSETS:
            return
        try:
            found = [bytes([b]).decode(name, "replace") for b in range(256)]
        except LookupError:
            raise ValueError(f"unknown charset {name}") from None
        pairs = [bytes([a, b]).decode(name, "replace") for a in range(128, 256) for b in (65, 161, a)]
        if "".join(found[:128]) != bytes(range(128)).decode("ascii") or {len(p) for p in pairs} != {2}:
            raise ValueError(f"charset {name} is neither one of {SPARK_CHARSETS} nor of single bytes")
        self.spark_name = "iso-8859-1"
        other = [(chr(b), c) for b, c in enumerate(found) if chr(b) != c]
        self.read, self.meant = ("".join(side) for side in zip(*other)) if other else ("", "")

    def column(self, text: Column) -> Column:
        return F.translate(text, self.read, self.meant) if self.read else text

    def name(self, text: str) -> str:
        return text.translate(str.maketrans(self.read, self.meant))


    def of_bytes(self, value: Column) -> Column | None:
        """The text of a value whose bytes are those of the file; None if they are it already."""
        if self.spark_name.lower() in ("utf-8", "us-ascii"):
            return None
        if self.spark_name.lower() in WIDE_CHARSETS:
            raise ValueError(f"records that span lines are not read in {self.spark_name}")
        return self.column(F.decode(value.cast("binary"), self.spark_name))


def _reader(spark: SparkSession, charset: Charset, multi_line: bool) -> DataFrameReader:
    reader = spark.read.option("header", True).option("encoding", charset.spark_name)
    # A quote within a quoted value is doubled.
    return reader.option("escape", '"').option("multiLine", multi_line).option("enforceSchema", False)


def _texts(
    spark: SparkSession, path: str | Sequence[str], charset: Charset, multi_line: bool, file_column: str | None
) -> DataFrame:
    """All columns as text, under the names of the header, and the file of each record if asked for."""
    path = path if isinstance(path, str) else list(path)
    # Without inference this looks at the first record only.
    names = _reader(spark, charset, multi_line).csv(path).columns
    own = [charset.name(n) for n in names]
    if not multi_line or charset.spark_name.lower() in WIDE_CHARSETS:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        raw = _reader(spark, charset, multi_line).schema(schema).csv(path)
        texts = [charset.column(quoted(n)).alias(o) for n, o in zip(names, own)]
        return raw.select(*texts, *([F.col("_metadata.file_path").alias(file_column)] if file_column else []))
    found = records(spark, path, charset.of_bytes(F.col("value")))
    fields = F.from_csv(
        F.regexp_replace("value", "^\ufeff|\r$", ""),
        ", ".join(f"c{i} string" for i in range(len(own))),
        {"escape": '"', "maxCharsPerColumn": "-1"},
    )
    parsed = found.select("file", "is_header", fields.alias("x"))
    # A header is compared with the first file's, as for files without such records.
    as_expected = F.lit(True)
    for i, name in enumerate(own):
        as_expected &= F.lower(F.coalesce(F.col(f"x.c{i}"), F.lit(""))).eqNullSafe(name.lower())
    other = F.raise_error(F.concat(F.lit("another header than in the first file: "), F.col("file")))
    is_data = F.when(~F.col("is_header"), True).when(as_expected, False).otherwise(other.cast("boolean"))
    texts = [F.col(f"x.c{i}").alias(o) for i, o in enumerate(own)]
    return parsed.filter(is_data).select(*texts, *([F.col("file").alias(file_column)] if file_column else []))


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    type_of: Callable[[str], T.DataType],
    encoding: str = "utf-8",
    rejects: str | None = None,
    null_value: str | None = None,
    missing: Sequence[str] = (),
    multi_line: bool = False,
    file_column: str | None = None,
) -> DataFrame:
    """CSV with header, in one pass: ``type_of`` names the type of every header column.

    All columns are read as text and cast in the plan, so what a query uses
    does not change what it finds. A value that does not fit its type becomes
    null. With ``rejects``, a text column of that name holds the record wherever
    this happened in any column. ``null_value`` and each of ``missing`` stand
    for a missing value in every column. ``file_column`` names a column for the
    file that a record comes from.

    Every file of a folder must carry the same header. With ``multi_line``,
    quoted values may hold line breaks; the files are read in splits all the
    same, in three passes (in UTF-16 and UTF-32 a file is one task). Without it,
    such files are read wrongly; ``sweep_csv`` refuses them.
    """
    texts = _texts(spark, path, Charset(encoding), multi_line, file_column)
    names = [c for c in texts.columns if c != file_column]
    tokens = [*missing, *([] if null_value is None else [null_value])]
    typed, unfit = [], F.lit(False)
    for name in names:
        text = quoted(name)
        if tokens:
            text = F.when(~text.isin(tokens), text)
        kind = type_of(name)
        if not isinstance(kind, T.StringType):
            value = text.try_cast(kind)
            unfit = unfit | (text.isNotNull() & (text != "") & value.isNull())
            text = value
        typed.append(text.alias(name))
    if rejects:
        record = F.to_csv(F.struct(*[quoted(n) for n in names]))
        typed.append(F.when(unfit, record).alias(rejects))
    return texts.select(*typed, *([quoted(file_column)] if file_column else []))


def read_csv_inferred(
    spark: SparkSession,
    path: str | Sequence[str],
    keys: Sequence[str] = (),
    encoding: str = "utf-8",
    multi_line: bool = False,
    missing: Sequence[str] = (),
    like_pandas: bool = False,
) -> DataFrame:
    """CSV with inferred types, at the price of one more pass over the files.

    ``keys`` always stay text, so that a leading zero survives. ``missing`` and
    ``like_pandas`` are those of ``infer_types``.
    """
    texts = _texts(spark, path, Charset(encoding), multi_line, None)
    types = infer_types(texts, keys, missing, like_pandas)
    return read_csv(spark, path, types.__getitem__, encoding, missing=missing, multi_line=multi_line)


def _lines(spark: SparkSession, folder: str, encoding: str, pattern: str | None) -> DataFrame:
    """Non-blank lines of the files below ``folder``, numbered in file order.

    Lines of one block have neighbouring numbers.
    """
    charset = Charset(encoding)
    reader = (
        spark.read.option("recursiveFileLookup", True)
        .option("encoding", charset.spark_name)
        .option("sep", NO_SEPARATOR)
        .option("quote", "")
        .option("escape", "")
    )
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return (
        reader.schema("value string")
        .csv(folder)
        .filter(F.length(F.trim("value")) > 0)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
            charset.column(F.col("value")).alias("value"),
        )
    )


def _names_of(header: Column) -> Column:
    return F.transform(
        F.split(header, COMMA_OUTSIDE_QUOTES),
        lambda n: F.regexp_replace(n, '^﻿?"?|"?\r?$', ""),
    )


def header_names(spark: SparkSession, path: str, encoding: str = "utf-8") -> list[str]:
    """Names in the first line of a CSV file, exactly as written."""
    first = _lines(spark, path, encoding, None).select("value").head(1)
    return next(csv.reader([first[0][0].lstrip("﻿")])) if first else []


def duplicate_headers(
    spark: SparkSession, path: str, encoding: str = "utf-8", pattern: str | None = None
) -> DataFrame:
    """Rows (file, name, occurrences, first_position): names that repeat in a file's header.

    Case is ignored. Looks at the raw first line of every file below ``path``,
    since the CSV reader renames clashing columns.
    """
    lines = _lines(spark, path, encoding, pattern)
    headers = lines.groupBy("file").agg(F.min_by("value", F.struct("block", "line")).alias("header"))
    return (
        headers.select("file", F.posexplode(_names_of(F.col("header"))))
        .groupBy("file", F.lower("col").alias("name"))
        .agg(F.count("*").alias("occurrences"), F.min("pos").alias("first_position"))
        .filter("occurrences > 1")
    )


def sweep_csv(
    spark: SparkSession,
    folder: str,
    encoding: str = "utf-8",
    pattern: str = "*.csv",
    multi_line: bool = False,
) -> DataFrame:
    """One row per CSV file below ``folder``: its rows, its columns, its header.

    One distributed pass over all files, whatever their schemas. A file with a
    record that spans lines has a line with an odd number of quotes; it is
    refused, with its name, unless ``multi_line`` asks for records to be cut by
    the quotes before them, which takes three passes.
    """
    at = F.struct("block", "line")
    if multi_line:
        charset = Charset(encoding)
        lines = records(spark, folder, charset.of_bytes(F.col("value")), pattern, recursive=True)
        odd = F.lit(0)
    else:
        lines = _lines(spark, folder, encoding, pattern)
        n_quotes = F.length("value") - F.length(F.regexp_replace("value", '"', ""))
        odd = F.count_if(n_quotes % 2 == 1)
    per_file = lines.groupBy("file").agg(
        (F.count("*") - 1).alias("n_rows"), F.min_by("value", at).alias("header"), odd.alias("odd")
    )
    refused = F.raise_error(F.concat(F.lit("records span lines, ask for multi_line: "), F.col("file")))
    names = _names_of(F.col("header"))
    return per_file.select(
        "file",
        F.when(F.col("odd") > 0, refused.cast("long")).otherwise(F.col("n_rows")).alias("n_rows"),
        F.size(names).alias("n_columns"),
        names.alias("columns"),
    )


def sweep_heads(
    spark: SparkSession,
    folder: str,
    n: int = 5,
    encoding: str = "utf-8",
    pattern: str = "*.csv",
) -> DataFrame:
    """The first ``n`` data lines of every CSV file below ``folder``.

    A first pass counts the lines of each block. The counts, a few per file,
    tell where the head of a file ends; no line is sorted.
    """
    lines = _lines(spark, folder, encoding, pattern)
    blocks = lines.groupBy("file", "block").agg(
        F.count("*").alias("n_lines"), F.min("line").alias("first_line")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    heads = (
        blocks.withColumn("before", F.coalesce(F.sum("n_lines").over(earlier), F.lit(0)))
        .filter(F.col("before") <= n)
        .select("file", "block", "first_line", "before")
    )
    number = F.col("before") + F.col("line") - F.col("first_line")
    return (
        lines.join(heads, ["file", "block"])
        .select("file", number.cast("int").alias("line"), "value")
        .filter(F.col("line").between(1, n))
    )
