"""Checks on the rows of a table while it is written.

The counts are taken on the frame that the write itself runs, so a table is not
read again for them. Rows that a gate refuses go to a table of their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardframe.operators.columns import quoted
from wardframe.operators.duplicates import repeated_keys
from wardframe.plans.quality import QualityError
from wardframe.sources import write_table


@dataclass(frozen=True)
class Gate:
    """A row passes if ``holds``, an SQL condition, is true; null is not."""

    name: str
    holds: str


# The checks that the reports rely on.
DIM_GATES = (
    Gate("provider_key_missing", "PROVIDER_NUM IS NOT NULL"),
    Gate("provider_key_not_numeric", r"PROVIDER_NUM IS NULL OR PROVIDER_NUM RLIKE r'^\p{N}+$'"),
)
FACT_GATES = (Gate("work_day_key_missing", "PROVNUM IS NOT NULL AND WORKDATE IS NOT NULL"),)


def _free(name: str, taken: Sequence[str]) -> str:
    lower = {c.lower() for c in taken}
    while name in lower:
        name = f"_{name}"
    return name


def marked(df: DataFrame, gates: Sequence[Gate], unique: Sequence[str] = ()) -> tuple[DataFrame, str]:
    """``df`` with the names of the gates that refuse a row, and the name of that column.

    With ``unique`` all rows are refused, as ``key_repeated``, whose key of these
    columns occurs more than once, null taken as a value. Only this gate compares
    rows, so only it counts the keys first, in a job over these columns.
    """
    found = [F.when(~F.coalesce(F.expr(g.holds), F.lit(False)), F.lit(g.name)) for g in gates]
    reasons = _free("reasons", df.columns)
    if unique:
        keys = [_free(f"repeated_{i}", df.columns) for i in range(len(unique))]
        again = repeated_keys(df, unique).toDF(*keys, _free("copies", df.columns))
        same = F.lit(True)
        for key, name in zip(keys, unique):
            same = same & quoted(name).eqNullSafe(quoted(key))
        joined = df.join(again, same, "left")
        found.append(F.when(quoted(again.columns[-1]).isNotNull(), F.lit("key_repeated")))
        df = joined
        extra = again.columns
    else:
        extra = []
    if not found:
        return df.withColumn(reasons, F.array().cast("array<string>")), reasons
    return df.withColumn(reasons, F.array_compact(F.array(*found))).drop(*extra), reasons


def write_gated(
    df: DataFrame,
    path: str,
    gates: Sequence[Gate] = (),
    refused_path: str | None = None,
    unique: Sequence[str] = (),
    most_refused: float = 1.0,
    **layout,
) -> dict[str, int]:
    """Writes ``df`` as ``write_table`` does with ``layout``, and returns what was counted meanwhile.

    The counts are ``n_rows`` and ``n_refused`` of all rows, ``refused:`` and a
    gate's name, and ``missing:`` and a column's name. They are taken behind the
    shuffle of a partitioned table, where a lost task counts once.

    With ``refused_path`` refused rows are not in the table but there, with the
    names of their gates in ``reasons`` (``_reasons`` if the table has such a
    column); only if there are any, the input is read again for them. Without
    it they are counted and kept. More than ``most_refused`` of the rows is a
    QualityError; it comes after the write, so a table that others read should
    be written where only a later commit shows it. An empty table counts zeros.
    """
    spark = df.sparkSession
    rows, reasons = marked(df, gates, unique)
    refused = F.size(quoted(reasons)) > 0
    names = [g.name for g in gates] + (["key_repeated"] if unique else [])
    measures = {
        "n_rows": F.count("*"),
        "n_refused": F.count_if(refused),
        **{f"refused:{n}": F.count_if(F.array_contains(quoted(reasons), n)) for n in names},
        **{f"missing:{c}": F.count_if(quoted(c).isNull()) for c in df.columns},
    }
    seen = Observation()

    def watched(dealt: DataFrame) -> DataFrame:
        counted = dealt.observe(seen, *[m.alias(n) for n, m in measures.items()])
        return (counted.filter(~refused) if refused_path else counted).drop(reasons)

    write_table(rows, path, last=watched, **layout)
    counts = {name: int(n) for name, n in seen.get.items()}
    if refused_path:
        if counts["n_refused"]:
            write_table(rows.filter(refused), refused_path)
        else:
            write_table(spark.createDataFrame([], rows.schema), refused_path)
    if counts["n_refused"] > most_refused * counts["n_rows"]:
        raise QualityError(f"{counts['n_refused']} of {counts['n_rows']} rows refused for {path}")
    return counts


def gate_report(spark: SparkSession, counted: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """Rows (table_name, measure, n) of what ``write_gated`` counted per table."""
    rows = [(table, measure, n) for table, counts in counted.items() for measure, n in counts.items()]
    return spark.createDataFrame(rows, "table_name string, measure string, n long")
