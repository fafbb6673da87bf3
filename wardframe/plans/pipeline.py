"""Raw files to Silver to Gold, as one run."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from wardframe import schema as S
from wardframe.plans import gates, gold, silver
from wardframe.plans.quality import require_unique_providers
from wardframe.sources import join_path, read_csv, read_table, write_table

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class GoldTables:
    bed: DataFrame
    nurse: DataFrame
    staff: DataFrame

    @classmethod
    def load(cls, spark: SparkSession, folder: str, keep_dims: bool = True) -> GoldTables:
        """The three tables; the two dimensions are kept for the reports that share them.

        The work days are read anew by each report, which needs few of their columns.
        """
        bed = read_table(spark, join_path(folder, "dim_bed"))
        nurse = read_table(spark, join_path(folder, "dim_nurse"))
        if keep_dims:
            bed, nurse = (d.persist(StorageLevel.MEMORY_AND_DISK) for d in (bed, nurse))
        return cls(bed, nurse, read_table(spark, join_path(folder, "fact_staff")))

    def release(self) -> None:
        """Gives up the kept dimensions; they are read anew if used again."""
        self.bed.unpersist()
        self.nurse.unpersist()


def to_silver(
    spark: SparkSession,
    bronze: str,
    silver_dir: str,
    fact_file: str = S.FACT_FILE,
    dim_file: str = S.DIM_FILE,
    encoding: str = "utf-8",
) -> None:
    fact = read_csv(spark, join_path(bronze, fact_file), S.fact_type, encoding)
    dim = read_csv(spark, join_path(bronze, dim_file), S.dim_type, encoding)
    write_table(silver.silver_fact(fact), join_path(silver_dir, "fact_table"))
    write_table(silver.silver_dim(dim), join_path(silver_dir, "dim_table"))


def to_silver_gated(
    spark: SparkSession,
    bronze: str,
    silver_dir: str,
    refused_dir: str | None = None,
    fact_file: str = S.FACT_FILE,
    dim_file: str = S.DIM_FILE,
    encoding: str = "utf-8",
    most_refused: float = 1.0,
) -> DataFrame:
    """``to_silver`` with the checks of ``gates``: rows (table_name, measure, n).

    With ``refused_dir`` refused rows go there instead, one table for each of
    Silver's. Providers whose key recurs are refused, as the join would
    multiply their days.
    """
    fact = silver.silver_fact(read_csv(spark, join_path(bronze, fact_file), S.fact_type, encoding))
    dim = silver.silver_dim(read_csv(spark, join_path(bronze, dim_file), S.dim_type, encoding))
    counted = {}
    for name, df, checks, unique in (
        ("fact_table", fact, gates.FACT_GATES, ()),
        ("dim_table", dim, gates.DIM_GATES, ("PROVIDER_NUM",)),
    ):
        counted[name] = gates.write_gated(
            df,
            join_path(silver_dir, name),
            checks,
            join_path(refused_dir, name) if refused_dir else None,
            unique,
            most_refused,
        )
    return gates.gate_report(spark, counted)


def to_gold_dims(
    spark: SparkSession, silver_dir: str, gold_dir: str, unique_providers: bool = False
) -> None:
    dim = read_table(spark, join_path(silver_dir, "dim_table"))
    if unique_providers:
        require_unique_providers(dim)
    write_table(gold.dim_bed(dim), join_path(gold_dir, "dim_bed"))
    write_table(gold.dim_nurse(dim), join_path(gold_dir, "dim_nurse"))


def to_gold_fact(
    spark: SparkSession, silver_dir: str, gold_dir: str, partition_fact_by: Sequence[str] = ()
) -> None:
    fact = read_table(spark, join_path(silver_dir, "fact_table"))
    write_table(
        gold.fact_staff(fact),
        join_path(gold_dir, "fact_staff"),
        partition_by=partition_fact_by,
        lookup_by=["PROVNUM"],
    )


def run_pipeline(
    spark: SparkSession,
    bronze: str,
    silver_dir: str,
    gold_dir: str,
    unique_providers: bool = False,
    partition_fact_by: Sequence[str] = (),
    keep_dims: bool = False,
    **raw: str,
) -> GoldTables:
    """Runs all steps and returns the Gold tables; a failure is logged and raised.

    With ``keep_dims`` the dimensions are kept until ``release`` is called. ``raw`` takes the file names and the encoding of ``to_silver``.
    """
    with _logged("raw to silver"):
        to_silver(spark, bronze, silver_dir, **raw)
    with _logged("silver to gold dimensions"):
        to_gold_dims(spark, silver_dir, gold_dir, unique_providers)
    with _logged("silver to gold fact"):
        to_gold_fact(spark, silver_dir, gold_dir, partition_fact_by)
    return GoldTables.load(spark, gold_dir, keep_dims)


@contextmanager
def _logged(step: str) -> Iterator[None]:
    log.info("%s: started", step)
    try:
        yield
    except Exception:
        log.exception("%s: failed", step)
        raise
    log.info("%s: done", step)
