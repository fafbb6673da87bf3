"""Audit of the raw files as they landed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardframe.sources.listing import list_files

# Line hashes are taken modulo this prime, so that their sums stay exact.
MODULUS = 2**31 - 1


def manifest(
    spark: SparkSession,
    folder: str,
    pattern: str = "*.csv",
    expected: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """One row per landed or expected file, with a fingerprint of its content.

    ``expected`` lists (source, path below the folder). Its files come with
    their source; one that has not landed has no bytes. ``landed`` says whether
    a file is there, and a file without any byte has 0 lines.

    ``hash_sum`` adds the hashes of the lines, ``hash_order`` adds each times
    its line number, so two lines that changed places are seen. A file is read
    in splits by many tasks: sums are taken per block with numbers that start
    there, and moved by the lines before the block once these are known. Both
    do not depend on how a file is split. Tasks, not the driver, make a row per
    file; the driver holds the file list of Spark's own scans.
    """
    # Only the newline separates lines; a carriage return is part of the content.
    reader = (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .option("lineSep", "\n")
    )
    text = reader.schema("value string").text(folder)
    lines = text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("n_bytes"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        F.pmod(F.xxhash64("value"), F.lit(MODULUS)).cast("decimal(38,0)").alias("h"),
    )
    whole = lambda c: c.cast("decimal(38,0)")
    blocks = lines.groupBy("path", "n_bytes", "modified", "block").agg(
        F.count("*").alias("n"),
        F.min("id").alias("first"),
        F.sum("h").alias("h"),
        F.sum(F.col("h") * F.col("id")).alias("h_id"),
    )
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0)) + 1
    ordered = whole(F.col("h_id")) + whole(F.col("h")) * whole(before - F.col("first"))
    files = (
        blocks.withColumn("h_order", ordered)
        .groupBy("path", "n_bytes", "modified")
        .agg(
            F.sum("n").alias("n_lines"),
            whole(F.sum("h")).alias("hash_sum"),
            whole(F.sum("h_order")).alias("hash_order"),
        )
    )
    # The listing knows files without bytes too, which no scan returns.
    listed = list_files(spark, folder, pattern).select(F.col("path").alias("listed"))
    below = folder.rstrip("/") + "/"
    wanted = [(source, below + path.lstrip("/")) for source, path in expected]
    return _against(spark, files, listed, wanted)


def _against(spark, files: DataFrame, landed: DataFrame, wanted: list) -> DataFrame:
    """Files that landed and files that were expected, each once, by the end of their path."""
    # A scan names its files as in a URL, the listing does not.
    plain = lambda c: F.regexp_replace(c, "^[a-z0-9]+:/*", "/")
    counted = files.withColumn("place", plain(F.url_decode("path")))
    there = landed.withColumn("place", plain("listed")).join(counted, "place", "left")
    asked = spark.createDataFrame(wanted, "source string, asked string").withColumn("place", plain("asked"))
    joined = asked.join(there, "place", "full")
    name = F.element_at(F.split(F.col("place"), "/"), -1)
    return joined.select(
        "source",
        F.regexp_replace(F.coalesce("path", "listed", "asked"), "^file:/+", "file:///").alias("path"),
        name.alias("file_name"),
        F.col("listed").isNotNull().alias("landed"),
        F.when(F.col("listed").isNotNull(), F.coalesce("n_bytes", F.lit(0))).alias("n_bytes"),
        "modified",
        F.when(F.col("listed").isNotNull(), F.coalesce("n_lines", F.lit(0))).alias("n_lines"),
        "hash_sum",
        "hash_order",
    )
