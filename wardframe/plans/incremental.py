"""Raw files to Silver to Gold, rerun for the files that changed.

The raw files of a run are published as a table of their own. The next run
compares the folder with it, without opening a file, and reads only new and
changed ones. Silver keeps the file of each work day and the run that read it; the
rows of a file are those of the run that read it last. Gold is partitioned by
month: the months that changed files hold, or held, are written anew.

All tables become visible in one commit.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardframe import schema as S
from wardframe.plans import gold, silver
from wardframe.plans.pipeline import GoldTables
from wardframe.sources import Publication, Store, join_path, read_csv
from wardframe.sources.versions import Published

RAW_FILES, FACT, DIM, BED, NURSE, STAFF = (
    "raw_files", "fact_table", "dim_table", "dim_bed", "dim_nurse", "fact_staff",
)
DATE, MONTH, DAY = "WORKDATE", ("WORKYEAR", "WORKMONTH"), "WORKDAY"
FILE, RUN = "SOURCE_FILE", "READ_BY"
# Hours of a kind side by side: a row's equal ones, like those of roles that nobody worked in, then compress as one run.
DEALT = (*S.WORKED, *[h for kind in zip(*map(S.hours, S.ROLES)) for h in kind], *MONTH)
# Work days whose shuffle files are on disk at a time, some 4 GB; each deal reads Silver once.
DAYS_PER_DEAL = 50_000_000


@dataclass(frozen=True)
class Run:
    """What a run did: files read and gone, months written, the number of its commit."""

    read: int
    gone: int
    months: list[tuple[int, int]]
    commit: int


def raw_files(spark: SparkSession, bronze: str, fact_file: str, dim_file: str) -> DataFrame:
    """Rows (path, place, kind, n_bytes, modified) of the files that have landed; none is opened.

    ``path`` is the name that rows read from the file carry, ``place`` the one to read it by.
    """
    found = []
    for kind, name in (("fact", fact_file), ("dim", dim_file)):
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        files = reader.option("pathGlobFilter", "*.csv").load(join_path(bronze, name))
        found.append(
            files.select(
                F.col("_metadata.file_path").alias("path"),
                F.col("path").alias("place"),
                F.lit(kind).alias("kind"),
                F.col("_metadata.file_size").alias("n_bytes"),
                F.col("_metadata.file_modification_time").alias("modified"),
            )
        )
    return found[0].unionByName(found[1])


def changes(landed: DataFrame, known: DataFrame) -> DataFrame:
    """Rows (path, place, kind, change): files that are new, changed or gone since ``known``."""
    before = known.select("path", *[F.col(c).alias(f"old_{c}") for c in ("kind", "n_bytes", "modified")])
    same = (F.col("n_bytes") == F.col("old_n_bytes")) & (F.col("modified") == F.col("old_modified"))
    change = F.when(F.col("old_n_bytes").isNull(), "new").when(F.col("n_bytes").isNull(), "gone").when(~same, "changed")
    compared = landed.join(before, "path", "full").select(
        "path", "place", F.coalesce("kind", "old_kind").alias("kind"), change.alias("change")
    )
    return compared.filter(F.col("change").isNotNull())


def _live(fact: DataFrame, files: DataFrame) -> DataFrame:
    """The work days of the files that are there, as read last."""
    valid = files.filter("kind = 'fact'").select(F.col("path").alias(FILE), RUN)
    return fact.join(valid, [FILE, RUN], "left_semi")


def _months(days: DataFrame) -> DataFrame:
    """Rows (year, month, n_days, n_moved): the work days of each month, and how many have a value in ``moved``.

    They are counted per day first, so each different day is parsed once.
    """
    counted = days.groupBy(DATE).agg(F.count("*").alias("n_days"), F.count("moved").alias("n_moved"))
    return gold.fact_dates(counted).groupBy(*MONTH).agg(F.sum("n_days").alias("n_days"), F.sum("n_moved").alias("n_moved"))


def _deals(months: list[tuple[int, int]], n_days: Mapping[tuple[int, int], int]) -> list[list[tuple[int, int]]]:
    """The months in order, in groups of up to ``DAYS_PER_DEAL`` work days or of one month; one group if there are none.

    A group is dealt out and written before the next one, so the shuffle files
    on disk at a time do not grow with the table.
    """
    deals, size = [[]], 0
    for month in months:
        n = n_days.get(month, 0)
        if deals[-1] and size + n > DAYS_PER_DEAL:
            deals.append([])
            size = 0
        deals[-1].append(month)
        size += n
    return deals


def run_incremental(
    spark: SparkSession,
    bronze: str,
    root: str,
    fact_file: str = S.FACT_FILE,
    dim_file: str = S.DIM_FILE,
    encoding: str = "utf-8",
) -> Run:
    """Brings the tables published below ``root`` up to the raw files in ``bronze``.

    The result equals that of a run over all files. Without any change nothing
    is written. A row whose day has no month is in the month null. A failing run
    leaves what was published before.
    """
    store = Store(spark, root)
    publication = Publication(store)
    base, first = publication.base, RAW_FILES not in publication.base.tables
    landed = raw_files(spark, bronze, fact_file, dim_file)
    known = store.read(RAW_FILES, base) if not first else landed.filter("false").withColumn(RUN, F.lit(""))
    changed = changes(landed, known).collect()
    if not changed:
        return Run(0, 0, [], base.number)
    fresh = {k: [c.place for c in changed if c.kind == k and c.change != "gone"] for k in ("fact", "dim")}
    gone = [c.path for c in changed if c.change == "gone"]
    moved = spark.createDataFrame([(c.path, c.change) for c in changed], "path string, change string")

    # Unchanged files keep the run that read them.
    run_of = known.join(moved, "path", "left_anti").select("path", F.col(RUN).alias("kept"))
    run = F.coalesce("kept", F.lit(publication.version)).alias(RUN)
    files = landed.join(run_of, "path", "left").select(*landed.columns, run)
    publication.write(RAW_FILES, files)
    files = _written(publication, RAW_FILES)

    if fresh["dim"] or first or any(c.kind == "dim" for c in changed):
        dim = silver.silver_dim(read_csv(spark, join_path(bronze, dim_file), S.dim_type, encoding))
        publication.write(DIM, dim)
        dim = _written(publication, DIM)
        publication.write(BED, gold.dim_bed(dim))
        publication.write(NURSE, gold.dim_nurse(dim))

    months: list[tuple[int, int]] = []
    if first or any(c.kind == "fact" for c in changed):
        if fresh["fact"] or first:
            paths = fresh["fact"] or join_path(bronze, fact_file)
            days = read_csv(spark, paths, S.fact_type, encoding, file_column=FILE)
            read = silver.silver_fact(days).withColumn(RUN, F.lit(publication.version))
            publication.write(FACT, read, add=True)
        fact = _written(publication, FACT)
        # Months that a changed file held before, and those that it holds now.
        moved_path = F.broadcast(moved.select(F.col("path").alias(FILE), F.lit(1).alias("moved")))
        live = _live(fact, files)
        held = _months(live.join(moved_path, FILE, "left").select(DATE, "moved")).collect()
        n_days = {(r[MONTH[0]], r[MONTH[1]]): r["n_days"] for r in held}
        touched = {(r[MONTH[0]], r[MONTH[1]]) for r in held if r["n_moved"]}
        if not first:
            old = _live(store.read(FACT, base), known).join(moved_path, FILE).select(DATE, "moved")
            touched |= {(r[MONTH[0]], r[MONTH[1]]) for r in _months(old).collect()}
        months = sorted(touched, key=lambda m: [(v is not None, v) for v in m])
        # What follows from other columns is added to the rows once they are dealt out.
        days = gold.fact_dates(gold.fact_hours(live)).select(*DEALT)
        names = {"/".join(f"{c}={_folder(v)}" for c, v in zip(MONTH, m)) for m in months}
        keep = lambda part: part not in names
        for some in _deals(months, n_days):
            publication.write(STAFF, days.filter(_any_month(some)), MONTH, ["PROVNUM"], keep=keep, last=_staff)
    done = publication.commit()
    return Run(len(fresh["fact"]) + len(fresh["dim"]), len(gone), months, done.number)


def _staff(days: DataFrame) -> DataFrame:
    """Work days with their months as ``gold.fact_staff`` has them."""
    return gold.staff_ratios(gold.fact_hours(days.withColumn(DAY, F.dayofmonth(DATE)), *MONTH, DAY))


def _folder(value) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)


def _any_month(months: list[tuple[int, int]]):
    """Whether a row is of one of the months: one lookup of its month, whatever the number of months touched.

    The filter moves below the projection that parses the day, so each mention of
    the year or month is a parse per row.
    """
    numbered = [100 * year + month for year, month in months if None not in (year, month)]
    found = F.coalesce((100 * F.col(MONTH[0]) + F.col(MONTH[1])).isin(numbered), F.lit(False))
    for year, month in months:
        if None in (year, month):
            found = found | (F.col(MONTH[0]).eqNullSafe(year) & F.col(MONTH[1]).eqNullSafe(month))
    return found


def _written(publication: Publication, name: str) -> DataFrame:
    """A table as this run has written it, before its commit."""
    return publication.store.read(name, Published(publication.base.number, publication.tables))


def load(spark: SparkSession, root: str) -> GoldTables:
    """The three Gold tables of one commit."""
    store = Store(spark, root)
    published = store.current()
    return GoldTables(*[store.read(name, published) for name in (BED, NURSE, STAFF)])
