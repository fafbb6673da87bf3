"""Two tables stored so that their join needs no shuffle.

Both are bucketed and sorted by the join key and a slice. A key with many rows on
the large side has several slices, over which its rows are dealt by hash; its row
of the small side is stored once per slice. So the rows of a hot key lie in many
buckets, and both sides of any join partner lie in the same one.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardframe.operators.columns import backticked, quoted
from wardframe.operators.joins import join_dimension
from wardframe.sources.tables import join_path

ROWS_PER_SLICE = 1_000_000
# A task sorts a bucket when it is written and when it is joined.
ROWS_PER_BUCKET = 1_000_000
SLICE = "JOIN_SLICE"


def store_for_join(
    dim: DataFrame,
    fact: DataFrame,
    dim_key: str,
    fact_key: str,
    folder: str,
    buckets: int,
    rows_per_slice: int = ROWS_PER_SLICE,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> None:
    """Writes both tables below ``folder``, each bucket as one file; the layout comes last.

    There are ``buckets`` of them, or more if the larger side has over
    ``rows_per_bucket`` rows for each; so a task's share does not grow with the tables.
    The small side grows by at most one row per key and ``rows_per_slice`` rows of
    the large side. Rows without a key are kept, spread over all buckets. Equal
    rows of one input split stay in one slice. A folder without its layout cannot be opened.
    """
    spark = dim.sparkSession
    buckets = max(buckets, math.ceil(max(fact.count(), dim.count()) / rows_per_bucket))
    counts = fact.filter(quoted(fact_key).isNotNull()).groupBy(quoted(fact_key).alias("sliced_key"))
    slices = counts.agg(F.ceil(F.count("*") / F.lit(rows_per_slice)).cast("int").alias("slices")).filter("slices > 1")
    # The split's number parts equal rows, and a task that runs again deals as before.
    deal = F.xxhash64(*[quoted(c) for c in fact.columns], F.spark_partition_id()).alias("deal")
    dealt = fact.select("*", deal).join(slices, quoted(fact_key) == F.col("sliced_key"), "left")
    parts = F.when(quoted(fact_key).isNull(), F.lit(buckets)).otherwise(F.coalesce("slices", F.lit(1)))
    large = dealt.select(*[quoted(c) for c in fact.columns], F.pmod("deal", parts).cast("int").alias(SLICE))
    copies = F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)
    sliced = dim.join(slices, quoted(dim_key) == F.col("sliced_key"), "left")
    small = sliced.select(*[quoted(c) for c in dim.columns], F.explode(copies).alias(SLICE))
    layout = []
    for side, df, key in (("dim", small, dim_key), ("fact", large, fact_key)):
        path = join_path(folder, side)
        name = _fresh_name()
        writer = df.repartition(buckets, quoted(key), F.col(SLICE)).write.mode("overwrite").option("path", path)
        writer.bucketBy(buckets, key, SLICE).sortBy(key, SLICE).saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")  # the name only; the files stay
        columns = ", ".join(f"{backticked(f.name)} {f.dataType.simpleString()}" for f in df.schema)
        layout.append((side, key, buckets, columns))
    rows = spark.createDataFrame(layout, "side string, key string, buckets int, columns string")
    rows.coalesce(1).write.mode("overwrite").parquet(join_path(folder, "layout"))


def join_stored(spark: SparkSession, folder: str, suffixes: tuple[str, str]) -> DataFrame:
    """``join_dimension`` of the two stored tables, merged bucket by bucket."""
    tables, keys = _opened(spark, folder)
    return join_dimension(tables["dim"], tables["fact"], keys["dim"], keys["fact"], suffixes, slices=SLICE)


def read_stored(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The two tables as they were before they were stored."""
    tables, _ = _opened(spark, folder)
    return tables["dim"].filter(F.col(SLICE) == 0).drop(SLICE), tables["fact"].drop(SLICE)


def _opened(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], dict[str, str]]:
    tables, keys = {}, {}
    for row in spark.read.parquet(join_path(folder, "layout")).collect():
        name, by = _fresh_name(), f"{backticked(row.key)}, {SLICE}"
        place = join_path(folder, row.side).replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({row.columns}) USING parquet"
            f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {row.buckets} BUCKETS LOCATION '{place}'"
        )
        tables[row.side], keys[row.side] = spark.table(name), row.key
    return tables, keys


def _fresh_name() -> str:
    return f"bucketed_{uuid.uuid4().hex}"
