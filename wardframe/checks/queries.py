"""One query per operator, over whole tables.

Sums and means of doubles are rounded here, since the order of addition is not
fixed; the operators themselves return them unrounded.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wardframe import schema as S
from wardframe.checks import derived
from wardframe.operators import columns as C
from wardframe.operators import duplicates, histogram, profile, quantiles, rows
from wardframe.plans import gold, incremental, metrics, pipeline, profiling, quality, silver, statistics
from wardframe.session import remove_scratch, scratch_path, shuffles_released
from wardframe.sources import (
    MISSING_TOKENS,
    duplicate_headers,
    join_path,
    manifest,
    read_csv,
    read_csv_inferred,
    read_parts,
    sweep_csv,
    sweep_heads,
    write_table,
)

Query = Callable[[SparkSession, str], DataFrame]

PROVIDER_TYPE = "Medicare"
PROVIDER_NUMBER = "000000000001"
PROVIDER_NAME = "Supplier#000000002"

SUM_DIGITS = 4
MEAN_DIGITS = 9

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(C.quoted(n), digits) for n in names})


def _silver_fact(spark: SparkSession, folder: str) -> DataFrame:
    return silver.silver_fact(derived.fact_raw(spark, folder))


def _silver_dim(spark: SparkSession, folder: str) -> DataFrame:
    return silver.silver_dim(derived.dim_raw(spark, folder))


def _bed(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_bed(_silver_dim(spark, folder))


def _nurse(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_nurse(_silver_dim(spark, folder))


def _staff(spark: SparkSession, folder: str) -> DataFrame:
    return gold.fact_staff(_silver_fact(spark, folder))


# Silver and Gold


@query
def silver_fact(spark, folder):
    return _silver_fact(spark, folder)


@query
def silver_dim(spark, folder):
    return _silver_dim(spark, folder)


@query
def dim_bed(spark, folder):
    return _bed(spark, folder)


@query
def dim_bed_without_footnote(spark, folder):
    return gold.dim_bed(_silver_dim(spark, folder), include_footnote=False)


@query
def dim_nurse(spark, folder):
    return _nurse(spark, folder)


@query
def fact_staff(spark, folder):
    return _staff(spark, folder)


@query
def fact_dates(spark, folder):
    dated = gold.fact_dates(_silver_fact(spark, folder))
    return dated.select("PROVNUM", "WORKDATE", "WORKYEAR", "WORKMONTH", "WORKDAY")


# Join


@query
def provider_join(spark, folder):
    return metrics.provider_frame(_bed(spark, folder), _staff(spark, folder))


@query
def provider_join_stored(spark, folder):
    """The join of the stored tables, with a provider's days in slices of a hundred."""
    path = scratch_path(spark, "joined")
    metrics.store_provider_frame(_bed(spark, folder), _staff(spark, folder), path, buckets=8, rows_per_slice=100)
    return metrics.stored_provider_frame(spark, path)


@query
def join_null_safe(spark, folder):
    unknown = F.col("l_orderkey") % 29 == 0
    days = derived.table(spark, folder, "lineitem").select(
        F.when(~unknown, F.col("l_suppkey")).alias("PROVNUM"), "l_quantity"
    )
    providers = derived.table(spark, folder, "supplier").select(
        F.when(F.col("s_suppkey") != 3, F.col("s_suppkey")).alias("PROVIDER_NUM"), "s_name"
    )
    return metrics.provider_frame(providers, days, null_safe=True)


# Reports


@query
def beds_patients_by_state(spark, folder):
    by_state = metrics.beds_by_state(_bed(spark, folder), PROVIDER_TYPE)
    return rounded(by_state, SUM_DIGITS, S.RESIDENTS_TOTAL)


@query
def beds_by_state(spark, folder):
    return metrics.beds_by_state(_bed(spark, folder), PROVIDER_TYPE, "Beds")


@query
def patients_by_state(spark, folder):
    by_state = metrics.beds_by_state(_bed(spark, folder), PROVIDER_TYPE, "Patients")
    return rounded(by_state, SUM_DIGITS, S.RESIDENTS_TOTAL)


@query
def beds_patients_long(spark, folder):
    return rounded(metrics.beds_by_state_long(_bed(spark, folder), PROVIDER_TYPE), SUM_DIGITS, "Count")


@query
def bed_utilization_by_state(spark, folder):
    by_state = metrics.utilization_by_state(_bed(spark, folder), PROVIDER_TYPE)
    return rounded(by_state, MEAN_DIGITS, S.UTILIZATION)


def _nurse_rate(label: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        by_state = metrics.nurse_rate_by_state(_nurse(spark, folder), PROVIDER_TYPE, label)
        return rounded(by_state, MEAN_DIGITS, S.NURSE_LABELS[label])

    return run


def nurse_query(label: str) -> str:
    return f"nurse_rate_by_state_{label.lower().replace(' ', '_')}"


QUERIES.update({nurse_query(label): _nurse_rate(label) for label in S.NURSE_LABELS})


@query
def nurse_rate_headline(spark, folder):
    headlines = metrics.nurse_rate_headlines(_nurse(spark, folder), PROVIDER_TYPE)
    return rounded(headlines, MEAN_DIGITS, "rate")


@query
def provider_picklist(spark, folder):
    return metrics.provider_choices(_bed(spark, folder), _staff(spark, folder), "PROVIDER_NUM")


@query
def provider_name_picklist(spark, folder):
    return metrics.provider_choices(_bed(spark, folder), _staff(spark, folder), "PROVIDER_NAME")


@query
def provider_days_by_number(spark, folder):
    return metrics.provider_days(
        _bed(spark, folder), _staff(spark, folder), number=PROVIDER_NUMBER
    )


@query
def provider_days_by_name(spark, folder):
    return metrics.provider_days(_bed(spark, folder), _staff(spark, folder), name=PROVIDER_NAME)


@query
def provider_daily_census(spark, folder):
    _, census = metrics.provider_report(
        _bed(spark, folder), _staff(spark, folder), number=PROVIDER_NUMBER
    )
    return census


@query
def provider_daily_census_by_name(spark, folder):
    return metrics.daily_census(provider_days_by_name(spark, folder))


@query
def provider_card(spark, folder):
    return metrics.provider_card(provider_days_by_name(spark, folder))


@query
def staff_hours_by_state(spark, folder):
    hours = metrics.staff_hours_by_state(_bed(spark, folder), _staff(spark, folder), PROVIDER_TYPE)
    return rounded(hours, SUM_DIGITS, *S.ROLES)


@query
def staff_hours_presummed(spark, folder):
    """The form with many providers; there is only one form now."""
    hours = metrics.staff_hours_by_state(_bed(spark, folder), _staff(spark, folder), PROVIDER_TYPE)
    return rounded(hours, SUM_DIGITS, *S.ROLES)


@query
def staff_hours_long(spark, folder):
    hours = metrics.staff_hours_long(_bed(spark, folder), _staff(spark, folder), PROVIDER_TYPE)
    return rounded(hours, SUM_DIGITS, "Avg Hours")


# Columns and rows


@query
def column_slice(spark, folder):
    shown = ["HRS_MEDAIDE", "HRS_MEDAIDE_EMP", "HRS_MEDAIDE_CTR"]
    return C.select_columns(_silver_fact(spark, folder), shown)


@query
def numeric_columns(spark, folder):
    raw = derived.fact_raw(spark, folder)
    return C.select_columns(raw, C.numeric_columns(raw))


@query
def text_columns(spark, folder):
    raw = derived.fact_raw(spark, folder)
    return C.select_columns(raw, C.text_columns(raw))


@query
def non_numeric_keys(spark, folder):
    raw = derived.dim_raw(spark, folder)
    key = "CMS Certification Number (CCN)"
    return C.select_columns(rows.non_numeric_keys(raw, key), [key, "Provider Name"])


@query
def all_keys_numeric(spark, folder):
    return profile.all_keys_numeric(
        derived.dim_raw(spark, folder), "CMS Certification Number (CCN)"
    )


@query
def distinct_states(spark, folder):
    return rows.distinct_values(_bed(spark, folder), "STATE")


@query
def distinct_provider_types(spark, folder):
    return rows.distinct_values(_nurse(spark, folder), "PROVIDER_TYPE")


@query
def head_n(spark, folder):
    return rows.first_rows(derived.table(spark, folder, "orders"), 10, ["o_orderkey"])


def _without_tax(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Line items in two parts; the second one lacks a column."""
    lines = derived.table(spark, folder, "lineitem")
    returned = F.col("l_returnflag") == "A"
    return [lines.filter(returned), lines.filter(~returned).drop("l_tax")]


@query
def parts_union(spark, folder):
    return rows.union_parts(_without_tax(spark, folder))


@query
def parquet_parts_union(spark, folder):
    base = scratch_path(spark, "parts")
    paths = [join_path(base, "a"), join_path(base, "b")]
    for part, path in zip(_without_tax(spark, folder), paths, strict=True):
        write_table(part, path)
    return read_parts(spark, paths)


@query
def parts_of_several_types(spark, folder):
    """Line items in parts that disagree on the type of a column, and one that lacks a column."""
    lines = derived.table(spark, folder, "lineitem")
    base, paths = scratch_path(spark, "typed"), []
    for i, kind in enumerate(("int", "long", "double")):
        part = lines.filter(F.pmod("l_orderkey", F.lit(3)) == i)
        part = part.withColumn("l_quantity", F.col("l_quantity").cast(kind)).withColumn("l_suppkey", F.col("l_suppkey").cast("int" if i else "long"))
        paths.append(join_path(base, kind))
        write_table(part.drop("l_tax") if i == 2 else part, paths[-1])
    return read_parts(spark, paths)


# Profiling


@query
def distinct_counts(spark, folder):
    return profile.distinct_counts(derived.table(spark, folder, "lineitem"))


@query
def distinct_text_counts(spark, folder):
    raw = derived.fact_raw(spark, folder)
    return profile.distinct_counts(raw, C.text_columns(raw))


@query
def min_max_dates(spark, folder):
    return profile.value_range(derived.fact_raw(spark, folder), "WorkDate")


@query
def null_profile(spark, folder):
    return profile.null_counts(derived.fact_raw(spark, folder))


@query
def any_missing(spark, folder):
    return profile.any_missing(derived.fact_raw(spark, folder))


@query
def table_shape(spark, folder):
    return profile.table_shape(derived.fact_raw(spark, folder))


@query
def table_info(spark, folder):
    return profile.table_info(_staff(spark, folder))


def _fact_hours(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    raw = derived.fact_raw(spark, folder)
    return raw, C.numeric_columns(raw)


@query
def quartiles(spark, folder):
    fact, columns = _fact_hours(spark, folder)
    return rounded(quantiles.quantiles(fact, columns), MEAN_DIGITS, "value")


@query
def quartiles_orders(spark, folder):
    orders = derived.table(spark, folder, "orders")
    return rounded(quantiles.quantiles(orders), MEAN_DIGITS, "value")


@query
def iqr_outliers(spark, folder):
    fact, columns = _fact_hours(spark, folder)
    return rounded(quantiles.outlier_counts(fact, columns), MEAN_DIGITS, "lower", "upper")


@query
def iqr_outliers_events(spark, folder):
    events = derived.table(spark, folder, "events")
    return rounded(quantiles.outlier_counts(events), MEAN_DIGITS, "lower", "upper")


@query
def outlier_flags(spark, folder):
    return quantiles.outlier_flags(derived.fact_raw(spark, folder))


@query
def histogram_fact(spark, folder):
    fact, columns = _fact_hours(spark, folder)
    return histogram.histogram(fact, columns, bins=46)


@query
def histogram_dates(spark, folder):
    return histogram.histogram(derived.fact_raw(spark, folder), ["WorkDate"], bins=231)


@query
def histogram_dim(spark, folder):
    raw = derived.dim_raw(spark, folder)
    return histogram.histogram(raw, C.numeric_columns(raw), bins=50)


@query
def duplicate_rows(spark, folder):
    documents = derived.table(spark, folder, "documents").drop("doc_id")
    return duplicates.extra_copies(documents)


@query
def repeated_rows(spark, folder):
    """Whole work days, some of which were delivered twice."""
    fact = derived.fact_raw(spark, folder)
    return duplicates.repeated_rows(fact.unionByName(fact.filter("MDScensus % 7 = 0")))


@query
def has_duplicate_rows(spark, folder):
    return duplicates.has_repeated_rows(derived.fact_raw(spark, folder))


@query
def key_uniqueness(spark, folder):
    return duplicates.repeated_keys(derived.fact_raw(spark, folder), ["PROVNUM", "WorkDate"])


@query
def has_duplicate_keys(spark, folder):
    return duplicates.has_repeated_keys(derived.fact_raw(spark, folder), ["PROVNUM", "WorkDate"])


@query
def has_duplicate_provider_keys(spark, folder):
    key = "CMS Certification Number (CCN)"
    return duplicates.has_repeated_keys(derived.dim_raw(spark, folder), [key])


@query
def quality_report(spark, folder):
    return quality.quality_report(_silver_dim(spark, folder), _silver_fact(spark, folder))


# Files


def _write_csv(df: DataFrame, path: str, header: bool = True, **options: str) -> str:
    df.write.option("header", header).options(**options).csv(path)
    return path


@query
def csv_roundtrip(spark, folder):
    path = _write_csv(derived.fact_raw(spark, folder), scratch_path(spark, "fact"))
    return read_csv(spark, path, S.fact_type)


@query
def csv_rejects(spark, folder):
    """Records whose census is no number, counted beside other columns, or none."""
    unreadable = F.col("COUNTY_FIPS") == 7
    census = F.when(unreadable, "n/a").otherwise(F.col("MDScensus").cast("string"))
    raw = derived.fact_raw(spark, folder).withColumn("MDScensus", census)
    path = _write_csv(raw, scratch_path(spark, "rejects"))
    read = read_csv(spark, path, S.fact_type, rejects="rejected")
    parts = {
        "census": read.agg(F.count("*"), F.count("rejected"), F.count("MDScensus")),
        "rejects alone": read.agg(F.count("*"), F.count("rejected"), F.lit(0)),
        "another column": read.agg(F.count("*"), F.count("rejected"), F.count("STATE")),
    }
    names = ("n_rows", "n_rejected", "n_values")
    return rows.union_parts(
        [df.toDF(*names).select(F.lit(k).alias("beside"), *names) for k, df in parts.items()]
    )


@query
def csv_missing_tokens(spark, folder):
    """Missing values of every column where a file spells them in several ways."""
    tokens = F.array(*[F.lit(t) for t in MISSING_TOKENS])
    at = F.pmod(F.col("s_suppkey"), F.lit(len(MISSING_TOKENS))).cast("int")
    providers = derived.table(spark, folder, "supplier").select(
        "s_suppkey",
        F.when(F.col("s_suppkey") % 3 == 0, F.get(tokens, at)).otherwise(F.col("s_name")).alias("name"),
        F.when(F.col("s_suppkey") % 4 == 0, F.get(tokens, at))
        .otherwise(F.col("s_nationkey").cast("string"))
        .alias("nation"),
    )
    path = _write_csv(providers, scratch_path(spark, "tokens"))
    types = {"s_suppkey": T.LongType(), "name": T.StringType(), "nation": T.IntegerType()}
    return read_csv(spark, path, types.__getitem__, missing=MISSING_TOKENS)


@query
def csv_multi_line(spark, folder):
    """All customers, with values that hold line breaks, commas and quotes."""
    customers = _spanning(spark, folder)
    path = _write_csv(customers, scratch_path(spark, "lines"), escape='"')
    types = {f.name: f.dataType for f in customers.schema}
    return read_csv(spark, path, types.__getitem__, multi_line=True)


def _spanning(spark: SparkSession, folder: str) -> DataFrame:
    words = F.concat(F.col("c_name"), F.lit('\n"'), F.col("c_mktsegment"), F.lit('", \n\n'), F.col("c_custkey"))
    return derived.table(spark, folder, "customer").withColumn("c_label", words)


@query
def csv_multi_line_sweep(spark, folder):
    """Records of files whose values hold line breaks, by market segment."""
    customers = _spanning(spark, folder).withColumn("segment", F.col("c_mktsegment"))
    path = scratch_path(spark, "segments")
    customers.write.option("header", True).option("escape", '"').partitionBy("segment").csv(path)
    files = sweep_csv(spark, path, multi_line=True)
    segment = F.regexp_extract(F.url_decode("file"), "segment=([^/]*)/", 1)
    return files.groupBy(segment.alias("segment")).agg(
        F.sum("n_rows").alias("n_rows"), F.max("n_columns").cast("long").alias("n_columns")
    )


@query
def csv_pandas_types(spark, folder):
    """All orders from texts with missing tokens, blanks and leading zeros, typed as pandas would."""
    token = F.get(F.array(*[F.lit(t) for t in MISSING_TOKENS]), F.pmod("o_orderkey", F.lit(len(MISSING_TOKENS))).cast("int"))
    text = lambda c: F.col(c).cast("string")
    orders = derived.table(spark, folder, "orders").select(
        F.lpad(text("o_orderkey"), 12, "0").alias("order_key"),
        F.when(F.col("o_orderkey") % 3 == 0, token).otherwise(text("o_custkey")).alias("customer"),
        F.when(F.col("o_orderkey") % 5 != 0, text("o_totalprice")).alias("price"),
        F.when(F.col("o_orderkey") % 2 == 0, "True").otherwise("FALSE").alias("even"),
        F.when(F.col("o_orderkey") % 7 == 0, token).otherwise("false").alias("unsure"),
        F.when(F.col("o_orderkey") % 2 == 0, token).alias("nothing"),
        F.concat("o_orderstatus", F.lit("1")).alias("status"),
        (F.col("o_orderkey") * 1_000_000_007).alias("wide"),
    )
    path = _write_csv(orders, scratch_path(spark, "tokens"))
    return read_csv_inferred(spark, path, missing=MISSING_TOKENS, like_pandas=True)


@query
def csv_inferred(spark, folder):
    path = _write_csv(derived.dim_raw(spark, folder), scratch_path(spark, "dim"))
    return read_csv_inferred(spark, path, ["CMS Certification Number (CCN)", "ZIP Code"])


@query
def csv_charset(spark, folder):
    names = derived.table(spark, folder, "customer").select(
        "c_custkey", F.concat("c_name", F.lit(" – café "), "c_mktsegment").alias("c_label")
    )
    # The dash is byte 0x96 of the charset; Latin-1 writes that byte for character 0x96.
    bytes_of = names.withColumn("c_label", F.translate("c_label", "–", "\x96"))
    path = _write_csv(bytes_of, scratch_path(spark, "charset"), encoding="iso-8859-1")
    types = {f.name: f.dataType for f in names.schema}
    return read_csv(spark, path, types.__getitem__, encoding="windows-1252")


def _dataset(path: str) -> Column:
    """The folder of a file, as the name of the table written there."""
    return F.element_at(F.split(path, "/"), -2)


def _raw_folder(spark: SparkSession, folder: str, header: bool) -> str:
    base = scratch_path(spark, "raw")
    _write_csv(derived.fact_raw(spark, folder), join_path(base, "fact"), header)
    _write_csv(derived.dim_raw(spark, folder), join_path(base, "dim"), header)
    return base


@query
def csv_sweep(spark, folder):
    files = sweep_csv(spark, _raw_folder(spark, folder, header=True))
    return files.groupBy(_dataset("file").alias("dataset")).agg(
        F.sum("n_rows").alias("n_rows"),
        F.max("n_columns").cast("long").alias("n_columns"),
        F.max(F.array_join("columns", "|")).alias("columns"),
    )


@query
def csv_heads(spark, folder):
    """The first lines of sorted files of both raw tables, several files per state."""
    key = "CMS Certification Number (CCN)"
    state = lambda c: F.coalesce(c, F.lit("none"))
    providers = derived.dim_raw(spark, folder).select(
        state(F.col("State")).alias("place"),
        (F.substring(F.col(f"`{key}`"), 12, 1).cast("long") % 4).alias("share"),
        F.col(f"`{key}`").alias("number"),
        F.col("`Provider Name`").alias("name"),
    )
    days = derived.fact_raw(spark, folder).select(
        state(F.col("STATE")).alias("place"),
        (F.col("WorkDate") % 4).cast("long").alias("share"),
        "PROVNUM",
        "WorkDate",
        "MDScensus",
    )
    found = []
    for dataset, df in (("dim", providers), ("fact", days)):
        path = scratch_path(spark, "heads")
        dealt = df.repartition("place", "share").sortWithinPartitions(*df.columns)
        dealt.write.option("header", True).partitionBy("place", "share").csv(path)
        place = F.regexp_extract(F.url_decode("file"), "place=([^/]*)/", 1)
        share = F.regexp_extract("file", "share=([0-9]+)/", 1).cast("long")
        heads = sweep_heads(spark, path, n=3)
        found.append(heads.select(F.lit(dataset).alias("dataset"), place.alias("place"), share.alias("share"), "line", "value"))
    return rows.union_parts(found)


FINGERPRINTED_FILES = 8
# A task sorts the rows of a file.
ROWS_PER_FINGERPRINTED_FILE = 1_000_000


def _fingerprinted(spark: SparkSession, folder: str, expected: Sequence[tuple[str, str]]) -> DataFrame:
    """The manifest of both raw tables three times, in several files: as they are, once more, and in another order.

    A copy goes once its files are in the manifest, before the next one lands, so the disk holds one of them.
    There are more files if a table has over ``ROWS_PER_FINGERPRINTED_FILE`` rows for each.
    """
    fact, dim = derived.fact_raw(spark, folder), derived.dim_raw(spark, folder)
    files = lambda df: max(FINGERPRINTED_FILES, math.ceil(df.count() / ROWS_PER_FINGERPRINTED_FILE))
    dealt_by = lambda df: [*df.columns[:1], *df.columns[7:8]]
    dealt = {
        "fact": derived.fact_raw_dealt(spark, folder, files(fact), dealt_by(fact)),
        "dim": dim.repartition(files(dim), *[C.quoted(c) for c in dealt_by(dim)]),
    }
    found = scratch_path(spark, "manifest")
    for copy in ("first", "second", "turned"):
        base = scratch_path(spark, "landed")
        for table, df in dealt.items():
            columns = [C.quoted(c) for c in df.columns]
            order = [c.desc() for c in columns] if copy == "turned" else columns
            with shuffles_released(spark):
                _write_csv(df.sortWithinPartitions(*order), join_path(base, table, copy), header=False)
        landed = manifest(spark, base, expected=expected if copy == "first" else ())
        landed.write.mode("append").parquet(found)
        remove_scratch(spark, base)
    return spark.read.parquet(found)


@query
def bronze_manifest(spark, folder):
    """Lines per table and copy, and whether the fingerprints of its files tell an order from another."""
    files = _fingerprinted(spark, folder, expected=[("providers", "dim/missing/part-00000-never.csv")])
    part = lambda at: F.element_at(F.split("path", "/"), at)
    number = F.regexp_extract("file_name", "part-([0-9]+)", 1)
    files = files.withColumns({"dataset": part(-3), "copy": part(-2), "number": number})
    first = files.filter("copy = 'first'").select(
        "dataset", "number", *[F.col(c).alias(f"first_{c}") for c in ("n_bytes", "hash_sum", "hash_order")]
    )
    same = lambda c, name: F.bool_and(F.col(c) == F.col(f"first_{c}")).alias(name)
    return (
        files.join(first, ["dataset", "number"], "left")
        .groupBy("dataset", "copy")
        .agg(
            F.max("source").alias("source"),
            F.bool_and("landed").alias("landed"),
            F.sum("n_lines").alias("n_lines"),
            same("n_bytes", "same_bytes"),
            same("hash_sum", "same_lines"),
            same("hash_order", "same_order"),
        )
    )


@query
def duplicate_header_names(spark, folder):
    """Initials of the nations of each region as the header of a file."""
    odd = F.col("n_nationkey") % 2 == 1
    initial = F.substring("n_name", 1, 1)
    nations = derived.table(spark, folder, "nation").select(
        "n_regionkey", F.struct("n_name", F.when(odd, F.lower(initial)).otherwise(initial).alias("initial")).alias("x")
    )
    names = F.transform(F.array_sort(F.collect_list("x")), lambda x: x["initial"])
    headers = nations.groupBy("n_regionkey").agg(F.array_join(names, ",").alias("value"))
    path = scratch_path(spark, "initials")
    headers.repartition("n_regionkey").write.partitionBy("n_regionkey").text(path)
    region = F.regexp_extract("file", "n_regionkey=([0-9]+)", 1).cast("int")
    found = duplicate_headers(spark, path, pattern="*.txt")
    return found.select(region.alias("n_regionkey"), "name", "occurrences", "first_position")


def _kept(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """The raw work days, their stored statistics, which are written in two goes, and the numeric columns."""
    fact, columns = _fact_hours(spark, folder)
    month, path = F.floor(F.col("WorkDate") / 100).alias("month"), scratch_path(spark, "statistics")
    early = F.coalesce(F.col("WorkDate") < 19960101, F.lit(False))
    for some in (early, ~early):
        write_table(statistics.sketched(fact.filter(some).select("*", month), ["month"], fact.columns), path, append=True)
    return fact, read_parts(spark, [path]), columns


@query
def kept_counts(spark, folder):
    """Counts and ends by the stored statistics, and whether distinct counts are within their bound."""
    fact, kept, _ = _kept(spark, folder)
    exact = profile.distinct_counts(fact)
    near = F.abs(F.col("n_about") - F.col("n_distinct")) <= F.ceil(F.col("n_distinct") * statistics.DISTINCT_ERROR)
    found = statistics.merged(kept).withColumnRenamed("n_distinct", "n_about").join(exact, "column")
    return found.select("column", "n_rows", "n_present", "least", "greatest", near.alias("near"))


@query
def kept_quartiles(spark, folder):
    """Whether each quartile by the stored statistics lies between the exact ones at the ends of its bound."""
    fact, kept, columns = _kept(spark, folder)
    shares, reach = (0.25, 0.5, 0.75), statistics.RANK_ERROR
    exact = quantiles.quantiles(fact, columns, [s + d for s in shares for d in (-reach, reach)])
    share = F.round(F.col("probability") * 4) / 4
    ends = exact.groupBy("column", share.alias("share")).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    found = statistics.merged_quantiles(kept, shares).join(ends, ["column", "share"])
    return found.select("column", "share", F.col("value").between(F.col("lo"), F.col("hi")).alias("near"))


@query
def kept_histogram(spark, folder):
    """Whether each bin by the stored statistics is within its bound of the exact count."""
    fact, kept, columns = _kept(spark, folder)
    exact = histogram.histogram(fact, columns, bins=20).select("column", "bin", F.col("n").alias("n_exact"))
    total = F.sum("n_exact").over(Window.partitionBy("column"))
    found = statistics.merged_histogram(kept, bins=20).join(exact.withColumn("total", total), ["column", "bin"])
    near = F.abs(F.col("n") - F.col("n_exact")) <= 2 * statistics.RANK_ERROR * F.col("total")
    return found.select("column", "bin", near.alias("near"))


@query
def partitioned_sink(spark, folder):
    """The work days written by month, and each month read back by itself."""
    path = scratch_path(spark, "months")
    dated = gold.fact_dates(_silver_fact(spark, folder)).select(
        "PROVNUM", "MDSCENSUS", F.col("WORKYEAR").alias("y"), F.col("WORKMONTH").alias("m")
    )
    write_table(dated, path, partition_by=["y", "m"])
    back = read_parts(spark, [path])
    return back.groupBy("y", "m").agg(F.count("*").alias("n"), F.sum("MDSCENSUS").alias("residents"))


@query
def profile_fact(spark, folder):
    return profiling.long_profile(profiling.profile_fact(derived.fact_raw(spark, folder)))


@query
def profile_dim(spark, folder):
    return profiling.long_profile(profiling.profile_dim(derived.dim_raw(spark, folder)))


def _run_pipeline(spark: SparkSession, folder: str) -> pipeline.GoldTables:
    base = scratch_path(spark, "pipeline")
    bronze = join_path(base, "raw")
    _write_csv(derived.fact_raw(spark, folder), join_path(bronze, S.FACT_FILE))
    _write_csv(derived.dim_raw(spark, folder), join_path(bronze, S.DIM_FILE))
    return pipeline.run_pipeline(
        spark, bronze, join_path(base, "silver"), join_path(base, "gold"), unique_providers=True
    )


@query
def full_run(spark, folder):
    tables = _run_pipeline(spark, folder)
    named = {"dim_bed": tables.bed, "dim_nurse": tables.nurse, "fact_staff": tables.staff}
    shapes = [
        profile.table_shape(df).select(F.lit(name).alias("table_name"), "n_rows", "n_columns")
        for name, df in named.items()
    ]
    return rows.union_parts(shapes)


@query
def full_run_gates(spark, folder):
    """What a run counted while it wrote Silver, and the rows that it refused, by reason."""
    base = scratch_path(spark, "gates")
    bronze, refused = join_path(base, "raw"), join_path(base, "refused")
    _write_csv(derived.fact_raw(spark, folder), join_path(bronze, S.FACT_FILE))
    _write_csv(derived.dim_raw(spark, folder), join_path(bronze, S.DIM_FILE))
    counts = pipeline.to_silver_gated(spark, bronze, join_path(base, "silver"), refused)
    kept = [(name, f"silver/{name}") for name in ("dim_table", "fact_table")]
    stored = [
        spark.read.parquet(join_path(base, path)).agg(F.count("*").alias("n")).select(
            F.lit(name).alias("table_name"), F.lit("n_stored").alias("measure"), "n"
        )
        for name, path in kept
    ]
    why = (
        spark.read.parquet(join_path(refused, "dim_table"))
        .select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("n"))
        .select(F.lit("dim_table").alias("table_name"), F.concat(F.lit("stored:"), "reason").alias("measure"), "n")
    )
    return rows.union_parts([counts, *stored, why])


@query
def full_run_staff_hours(spark, folder):
    tables = _run_pipeline(spark, folder)
    hours = metrics.staff_hours_long(tables.bed, tables.staff, PROVIDER_TYPE)
    return rounded(hours, SUM_DIGITS, "Avg Hours")


@query
def incremental_run(spark, folder):
    """Published work days per month, after a run over some files and one over those that landed later."""
    base = scratch_path(spark, "incremental")
    bronze, root = join_path(base, "raw"), join_path(base, "published")
    days, early = derived.fact_raw(spark, folder), F.col("WorkDate") < 19960101
    _write_csv(derived.dim_raw(spark, folder), join_path(bronze, S.DIM_FILE))
    for landed in (days.filter(early), days.filter(~early | F.col("WorkDate").isNull())):
        landed.write.option("header", True).mode("append").csv(join_path(bronze, S.FACT_FILE))
        incremental.run_incremental(spark, bronze, root)
    tables = incremental.load(spark, root)
    return tables.staff.groupBy("WORKYEAR", "WORKMONTH").agg(
        F.count("*").alias("n_days"),
        F.sum("MDSCENSUS").alias("residents"),
        F.round(F.sum("HRS_RN_EMP"), SUM_DIGITS).alias("rn_hours"),
    )
