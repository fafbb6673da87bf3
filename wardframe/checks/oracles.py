"""For each query the DuckDB SQL over the same tables with the same result."""

from __future__ import annotations

from collections.abc import Sequence

from wardframe import schema as S
from wardframe.checks.derived import DIM_FROM, DIM_RAW, FACT_FROM, FACT_RAW, derivation
from wardframe.checks.queries import (
    MEAN_DIGITS,
    PROVIDER_NAME,
    PROVIDER_NUMBER,
    PROVIDER_TYPE,
    SUM_DIGITS,
    nurse_query,
)

CCN = "CMS Certification Number (CCN)"


def rounded(value: str, digits: int) -> str:
    """Rounds the shortest decimal text of a double half up, as Spark does."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def _silver_name(raw: str) -> str:
    return S.DIM_RENAMED.get(raw, raw).upper().replace(" ", "_")


SILVER_DIM = ", ".join(f'"{raw}" AS {_silver_name(raw)}' for raw in S.DIM_COLUMNS)
SILVER_FACT = ", ".join(f"{raw} AS {raw.upper()}" for raw in FACT_RAW if raw not in S.FACT_DROPPED)


def _zero(column: str) -> str:
    return f"coalesce(CAST({column} AS DOUBLE), 0)"


def _dim_bed(total: str) -> str:
    return f"""
    SELECT PROVIDER_NUM, PROVIDER_NAME, PROVIDER_TYPE, STATE, NUMBER_OF_CERTIFIED_BEDS,
           avg_res AS {S.RESIDENTS}, foot AS {S.RESIDENTS_FOOTNOTE}, {total} AS {S.RESIDENTS_TOTAL},
           {rounded(f'''CASE WHEN NUMBER_OF_CERTIFIED_BEDS = 0 THEN 0e0
                        ELSE 100 * ({total}) / NUMBER_OF_CERTIFIED_BEDS END''', 2)} AS {S.UTILIZATION}
    FROM (SELECT *, {_zero(S.RESIDENTS)} AS avg_res,
                 CAST(coalesce({S.RESIDENTS_FOOTNOTE}, 0) AS INT) AS foot FROM silver_dim)"""


def _rate(weekday: str, weekend: str) -> str:
    return rounded(f"(5 * {_zero(weekday)} + 2 * {_zero(weekend)}) / 7", 2)


DIM_NURSE = f"""
    SELECT PROVIDER_NUM, PROVIDER_NAME, PROVIDER_TYPE, STATE,
           {", ".join(f"{_zero(h)} AS {h}" for h in (
               S.AIDE_HOURS, S.LPN_HOURS, S.RN_HOURS, S.NURSE_HOURS,
               S.WEEKEND_HOURS, S.RN_WEEKEND_HOURS))},
           {_rate(S.AIDE_HOURS, S.WEEKEND_HOURS)} AS NURSE_AIDE_TO_PATIENT_RATE,
           {_rate(S.LPN_HOURS, S.WEEKEND_HOURS)} AS LPN_TO_PATIENT_RATE,
           {_rate(S.RN_HOURS, S.RN_WEEKEND_HOURS)} AS RN_TO_PATIENT_RATE,
           {_rate(S.NURSE_HOURS, S.WEEKEND_HOURS)} AS NURSE_TO_PATIENT_RATE
    FROM silver_dim"""



def _gates() -> str:
    """Counts per Silver table: all rows, refused ones by reason, missing values by column, and what was stored."""
    odd, no_day = "NOT regexp_full_match(PROVIDER_NUM, '[0-9]+')", "PROVNUM IS NULL OR WORKDATE IS NULL"
    dim = {
        "n_rows": "true",
        "n_refused": f"PROVIDER_NUM IS NULL OR {odd}",
        "refused:provider_key_missing": "PROVIDER_NUM IS NULL",
        "refused:provider_key_not_numeric": odd,
        "refused:key_repeated": "PROVIDER_NUM IN (SELECT PROVIDER_NUM FROM silver_dim GROUP BY 1 HAVING count(*) > 1)",
        **{f"missing:{_silver_name(c)}": f"{_silver_name(c)} IS NULL" for c in S.DIM_COLUMNS},
        "n_stored": "regexp_full_match(PROVIDER_NUM, '[0-9]+')",
        "stored:provider_key_not_numeric": odd,
    }
    fact = {
        "n_rows": "true",
        "n_refused": no_day,
        "refused:work_day_key_missing": no_day,
        **{f"missing:{c.upper()}": f"{c} IS NULL" for c in FACT_RAW if c not in S.FACT_DROPPED},
        "n_stored": f"NOT ({no_day})",
    }
    return " UNION ALL ".join(
        f"SELECT '{table}_table' AS table_name, '{name}' AS measure, count(*) AS n FROM silver_{table} WHERE {condition}"
        for table, found in (("dim", dim), ("fact", fact))
        for name, condition in found.items()
    )


HOURS = [f"HRS_{role}_{kind}" for role in S.ROLES for kind in ("EMP", "CTR")]
RATIOS = ", ".join(
    rounded(f"CASE WHEN HRS_{r}_CTR < 0.001 THEN 10000e0 ELSE HRS_{r}_EMP / HRS_{r}_CTR END", 2)
    + f" AS STAFF_RATIO_{r}"
    for r in S.ROLES
)
WORK_DATE = "CAST(strptime(CAST(WORKDATE AS VARCHAR), '%Y%m%d') AS DATE)"
DATE_PARTS = ", ".join(
    f"CAST({part}({WORK_DATE}) AS INT) AS WORK{part.upper()}" for part in ("year", "month", "day")
)

WITH = f"""
WITH dim_raw AS ({derivation(DIM_RAW, DIM_FROM)}),
     fact_raw AS ({derivation(FACT_RAW, FACT_FROM)}),
     silver_dim AS (SELECT {SILVER_DIM} FROM dim_raw),
     silver_fact AS (SELECT {SILVER_FACT} FROM fact_raw),
     dim_bed AS ({_dim_bed("avg_res + foot")}),
     dim_nurse AS ({DIM_NURSE}),
     fact_staff AS (
         SELECT PROVNUM, PROVNAME, CITY, STATE, {WORK_DATE} AS WORKDATE, MDSCENSUS,
                {", ".join(HOURS)}, {DATE_PARTS}, {RATIOS}
         FROM silver_fact),
     days AS (
         SELECT b.* EXCLUDE (STATE), f.* EXCLUDE (STATE), b.STATE AS "STATE_bed",
                f.STATE AS "STATE_staff"
         FROM dim_bed b JOIN fact_staff f ON b.PROVIDER_NUM = f.PROVNUM),
     beds_by_state AS (
         SELECT STATE, CAST(coalesce(sum({S.BEDS}), 0) AS BIGINT) AS {S.BEDS},
                {rounded(f"coalesce(sum({S.RESIDENTS_TOTAL}), 0)", SUM_DIGITS)} AS {S.RESIDENTS_TOTAL}
         FROM dim_bed WHERE PROVIDER_TYPE = '{PROVIDER_TYPE}' AND STATE IS NOT NULL GROUP BY STATE),
     hours_by_state AS (
         SELECT "STATE_bed", {", ".join(
             rounded(f"coalesce(sum(HRS_{r}_EMP), 0) + coalesce(sum(HRS_{r}_CTR), 0)", SUM_DIGITS)
             + f' AS "{r}"' for r in S.ROLES)}
         FROM days WHERE PROVIDER_TYPE = '{PROVIDER_TYPE}' AND "STATE_bed" IS NOT NULL
         GROUP BY "STATE_bed")
"""


def _mean_by_state(table: str, column: str) -> str:
    return f"""SELECT STATE, {rounded(f"coalesce(avg({column}), 0)", MEAN_DIGITS)} AS {column}
        FROM {table} WHERE PROVIDER_TYPE = '{PROVIDER_TYPE}' AND STATE IS NOT NULL GROUP BY STATE"""


def _headline(label: str, rate: str) -> str:
    return f"""SELECT '{label}' AS nurse_type, {rounded("avg(m)", MEAN_DIGITS)} AS rate,
        printf('%.2f', avg(m)) AS text
        FROM (SELECT coalesce(avg({rate}), 0) AS m FROM dim_nurse
              WHERE PROVIDER_TYPE = '{PROVIDER_TYPE}' AND STATE IS NOT NULL GROUP BY STATE)"""


def _union(queries: Sequence[str]) -> str:
    return " UNION ALL ".join(queries)


HOURS_LONG = _union(
    [
        f'SELECT "STATE_bed", \'{r}\' AS "Staff Type", "{r}" AS "Avg Hours" FROM hours_by_state'
        for r in S.ROLES
    ]
)

FACT_NUMBERS = ["COUNTY_FIPS", "WorkDate", "MDScensus"] + [c for c in FACT_RAW if c[:4] == "Hrs_"]
FACT_TEXTS = [c for c in FACT_RAW if c not in FACT_NUMBERS]
DIM_NUMBERS = list(S.DIM_COLUMNS)[6:]
LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
COUNTED_FACT = ["PROVNAME", "CITY", "STATE", "COUNTY_NAME", "MDScensus", "WorkDate"]


def _quartiles(table: str, columns: Sequence[str]) -> str:
    return _union(
        [
            f"""SELECT '{c}' AS "column", CAST({p} AS DOUBLE) AS probability,
            {rounded(f'quantile_cont(CAST("{c}" AS DOUBLE), {p})', MEAN_DIGITS)} AS value
            FROM {table}"""
            for c in columns
            for p in (0.25, 0.75)
        ]
    )


def _fences(table: str, column: str) -> str:
    return f"""(SELECT q1 - 1.5e0 * (q3 - q1) AS lo, q3 + 1.5e0 * (q3 - q1) AS hi FROM
        (SELECT quantile_cont(CAST("{column}" AS DOUBLE), 0.25) AS q1,
                quantile_cont(CAST("{column}" AS DOUBLE), 0.75) AS q3 FROM {table}))"""


def _outliers(table: str, columns: Sequence[str]) -> str:
    return _union(
        [
            f"""SELECT '{c}' AS "column", {rounded("lo", MEAN_DIGITS)} AS lower,
            {rounded("hi", MEAN_DIGITS)} AS upper,
            (SELECT count(*) FROM {table} WHERE "{c}" < lo OR "{c}" > hi) AS n_outliers
            FROM {_fences(table, c)}"""
            for c in columns
        ]
    )


def _profile(
    table: str,
    columns: Sequence[str],
    numbers: Sequence[str],
    keys: Sequence[str],
    counted: Sequence[str],
    bins: int,
) -> str:
    """The exploration of a table in long form."""

    def row(frame: str, item: str, measure: str, value: str, source: str = table) -> str:
        return f"""SELECT '{frame}' AS frame, '{item}' AS item, '{measure}' AS measure,
            CAST({value} AS DOUBLE) AS value FROM {source}"""

    names = ", ".join(f'"{c}"' for c in columns)
    some_missing = " OR ".join(f'"{c}" IS NULL' for c in columns)
    found = [
        row("shape", "table", "n_rows", "count(*)"),
        row("shape", "table", "n_columns", str(len(columns)), "(SELECT 1)"),
        row("any_missing", "table", "any", f"coalesce(bool_or({some_missing}), false)"),
        row(
            "duplicate_rows",
            "table",
            "n",
            "coalesce(sum(n - 1), 0)",
            f"(SELECT count(*) AS n FROM {table} GROUP BY {names})",
        ),
        row("repeated_keys", "table", "n", "count(*)", f"({_repeated(table, keys)})"),
    ]
    for c in columns:
        found.append(row("info", c, "n_present", f'count("{c}")'))
        found.append(row("missing", c, "n_missing", f'count(*) - count("{c}")'))
    found += [row("distinct", c, "n_distinct", f'count(DISTINCT "{c}")') for c in dict.fromkeys(counted)]
    for c in numbers:
        found.append(
            f"""SELECT 'histogram', "column", CAST(bin AS VARCHAR), CAST(n AS DOUBLE)
            FROM ({_histogram(table, c, bins)})"""
        )
        found.append(
            f"""SELECT 'outliers', "column", 'n_outliers', CAST(n_outliers AS DOUBLE)
            FROM ({_outliers(table, [c])})"""
        )
    return _union(found)


def _flag(column: str) -> str:
    bounds = _fences("fact_raw", column)
    return f"""coalesce({column} < (SELECT lo FROM {bounds})
        OR {column} > (SELECT hi FROM {bounds}), false) AS {column}"""


def _histogram(table: str, column: str, bins: int) -> str:
    """All bins of one column; a guessed bin is moved if its edges do not hold the value."""
    x = f'CAST("{column}" AS DOUBLE)'
    return f"""
    SELECT '{column}' AS "column", CAST(i AS INT) AS bin, lo + i * w AS bin_start,
           CASE WHEN i = {bins - 1} THEN hi ELSE lo + (i + 1) * w END AS bin_end,
           coalesce(n, 0) AS n
    FROM (SELECT *, (hi - lo) / {bins} AS w FROM
             (SELECT CASE WHEN a = b THEN a - 0.5e0 ELSE a END AS lo,
                     CASE WHEN a = b THEN b + 0.5e0 ELSE b END AS hi
              FROM (SELECT coalesce(min({x}), 0) AS a, coalesce(max({x}), 1) AS b FROM {table}))) e
    CROSS JOIN (SELECT CAST(unnest(generate_series(0, {bins - 1})) AS DOUBLE) AS i) g
    LEFT JOIN (
        SELECT g - CASE WHEN x < lo + g * w THEN 1 ELSE 0 END
                 + CASE WHEN g < {bins - 1} AND x >= lo + (g + 1) * w THEN 1 ELSE 0 END AS b,
               count(*) AS n
        FROM (SELECT x, lo, w, least(floor((x - lo) * {bins} / (hi - lo)), {bins - 1}) AS g
              FROM (SELECT *, (hi - lo) / {bins} AS w FROM
                       (SELECT x, CASE WHEN a = b THEN a - 0.5e0 ELSE a END AS lo,
                               CASE WHEN a = b THEN b + 0.5e0 ELSE b END AS hi
                        FROM (SELECT {x} AS x, min({x}) OVER () AS a, max({x}) OVER () AS b
                              FROM {table})))
              WHERE x IS NOT NULL)
        GROUP BY ALL) c ON c.b = i"""


def _counts(table: str, columns: Sequence[str], value: str, name: str) -> str:
    return _union(
        [f"""SELECT '{c}' AS "column", {value.format(c=f'"{c}"')} AS {name} FROM {table}""" for c in columns]
    )


SPARK_TYPES = {"WORKDATE": "date"} | {
    c: "string" for c in ("PROVNUM", "PROVNAME", "CITY", "STATE")
} | {c: "int" for c in ("MDSCENSUS", "WORKYEAR", "WORKMONTH", "WORKDAY")}
STAFF_COLUMNS = (
    list(S.WORKED)
    + HOURS
    + ["WORKYEAR", "WORKMONTH", "WORKDAY"]
    + [f"STAFF_RATIO_{r}" for r in S.ROLES]
)

CARD = f"""SELECT PROVIDER_NUM, PROVIDER_NAME, PROVIDER_TYPE, "STATE_bed" AS STATE, CITY,
    CAST({S.BEDS} AS INT) AS CERTIFIED_BEDS
    FROM days WHERE PROVIDER_NAME = '{PROVIDER_NAME}' ORDER BY PROVIDER_NUM, WORKDATE LIMIT 1"""


def _census(condition: str) -> str:
    return f"""SELECT WORKDATE, CAST(coalesce(sum(MDSCENSUS), 0) AS BIGINT) AS MDSCENSUS
        FROM days WHERE {condition} GROUP BY WORKDATE"""


def _repeated(table: str, keys: Sequence[str]) -> str:
    names = ", ".join(f'"{k}"' for k in keys)
    return f"SELECT {names}, count(*) AS copies FROM {table} GROUP BY {names} HAVING count(*) > 1"


def _has_repeated(table: str, keys: Sequence[str]) -> str:
    return f"SELECT count(*) > 0 AS has_duplicates FROM ({_repeated(table, keys)})"


def _failed(check: str, rows: str) -> str:
    return f"SELECT '{check}' AS \"check\", count(*) AS n_failed FROM ({rows})"


TAX_UNION = """SELECT * FROM lineitem WHERE l_returnflag = 'A' UNION ALL BY NAME
    SELECT * EXCLUDE (l_tax) FROM lineitem WHERE l_returnflag <> 'A'"""

_BODIES = {
    "silver_fact": "SELECT * FROM silver_fact",
    "silver_dim": "SELECT * FROM silver_dim",
    "dim_bed": "SELECT * FROM dim_bed",
    "dim_bed_without_footnote": _dim_bed("avg_res"),
    "dim_nurse": "SELECT * FROM dim_nurse",
    "fact_staff": "SELECT * FROM fact_staff",
    "fact_dates": f"SELECT PROVNUM, {WORK_DATE} AS WORKDATE, {DATE_PARTS} FROM silver_fact",
    "provider_join": "SELECT * FROM days",
    "provider_join_stored": "SELECT * FROM days",
    "join_null_safe": """SELECT * FROM
        (SELECT CASE WHEN s_suppkey <> 3 THEN s_suppkey END AS PROVIDER_NUM, s_name FROM supplier) s
        JOIN (SELECT CASE WHEN l_orderkey % 29 <> 0 THEN l_suppkey END AS PROVNUM, l_quantity
              FROM lineitem) l
        ON s.PROVIDER_NUM IS NOT DISTINCT FROM l.PROVNUM""",
    "beds_patients_by_state": "SELECT * FROM beds_by_state",
    "beds_by_state": f"SELECT STATE, {S.BEDS} FROM beds_by_state",
    "patients_by_state": f"SELECT STATE, {S.RESIDENTS_TOTAL} FROM beds_by_state",
    "beds_patients_long": _union(
        [
            f"SELECT STATE, '{c}' AS \"Metric\", CAST({c} AS DOUBLE) AS \"Count\" FROM beds_by_state"
            for c in (S.BEDS, S.RESIDENTS_TOTAL)
        ]
    ),
    "bed_utilization_by_state": _mean_by_state("dim_bed", S.UTILIZATION),
    **{nurse_query(n): _mean_by_state("dim_nurse", c) for n, c in S.NURSE_LABELS.items()},
    "nurse_rate_headline": _union([_headline(n, c) for n, c in S.NURSE_LABELS.items()]),
    "provider_picklist": "SELECT DISTINCT PROVIDER_NUM FROM days",
    "provider_name_picklist": "SELECT DISTINCT PROVIDER_NAME FROM days",
    "provider_days_by_number": f"SELECT * FROM days WHERE PROVIDER_NUM = '{PROVIDER_NUMBER}'",
    "provider_days_by_name": f"SELECT * FROM days WHERE PROVIDER_NAME = '{PROVIDER_NAME}'",
    "provider_daily_census": _census(f"PROVIDER_NUM = '{PROVIDER_NUMBER}'"),
    "provider_daily_census_by_name": _census(f"PROVIDER_NAME = '{PROVIDER_NAME}'"),
    "provider_card": CARD,
    "staff_hours_by_state": "SELECT * FROM hours_by_state",
    "staff_hours_presummed": "SELECT * FROM hours_by_state",
    "staff_hours_long": HOURS_LONG,
    "column_slice": "SELECT HRS_MEDAIDE, HRS_MEDAIDE_EMP, HRS_MEDAIDE_CTR FROM silver_fact",
    "numeric_columns": f"SELECT {', '.join(FACT_NUMBERS)} FROM fact_raw",
    "text_columns": f"SELECT {', '.join(FACT_TEXTS)} FROM fact_raw",
    "non_numeric_keys": f"""SELECT "{CCN}", "Provider Name" FROM dim_raw
        WHERE NOT regexp_full_match("{CCN}", '[0-9]+')""",
    "all_keys_numeric": f"""SELECT bool_and(regexp_full_match("{CCN}", '[0-9]+')) AS all_numeric
        FROM dim_raw""",
    "distinct_states": "SELECT DISTINCT STATE FROM dim_bed",
    "distinct_provider_types": "SELECT DISTINCT PROVIDER_TYPE FROM dim_nurse",
    "head_n": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10",
    "parts_union": TAX_UNION,
    "parquet_parts_union": TAX_UNION,
    "parts_of_several_types": """SELECT * REPLACE (CAST(l_quantity AS DOUBLE) AS l_quantity,
        CAST(l_suppkey AS BIGINT) AS l_suppkey, CASE WHEN l_orderkey % 3 <> 2 THEN l_tax END AS l_tax) FROM lineitem""",
    "distinct_counts": _counts("lineitem", LINE_COLUMNS, "count(DISTINCT {c})", "n_distinct"),
    "distinct_text_counts": _counts("fact_raw", FACT_TEXTS, "count(DISTINCT {c})", "n_distinct"),
    "min_max_dates": "SELECT min(WorkDate) AS first, max(WorkDate) AS last FROM fact_raw",
    "null_profile": _counts("fact_raw", list(FACT_RAW), "count(*) - count({c})", "n_missing"),
    "any_missing": f"""SELECT bool_or({" OR ".join(f"{c} IS NULL" for c in FACT_RAW)})
        AS any_missing FROM fact_raw""",
    "table_shape": f"""SELECT count(*) AS n_rows, CAST({len(FACT_RAW)} AS BIGINT) AS n_columns
        FROM fact_raw""",
    "table_info": _union(
        [
            f"""SELECT CAST({i} AS INT) AS position, '{c}' AS "column",
            '{SPARK_TYPES.get(c, "double")}' AS type, count({c}) AS n_present FROM fact_staff"""
            for i, c in enumerate(STAFF_COLUMNS)
        ]
    ),
    "quartiles": _quartiles("fact_raw", FACT_NUMBERS),
    "quartiles_orders": _quartiles("orders", ["o_orderkey", "o_custkey", "o_totalprice"]),
    "iqr_outliers": _outliers("fact_raw", FACT_NUMBERS),
    "iqr_outliers_events": _outliers("events", ["event_id", "user_id", "value"]),
    "outlier_flags": f"""SELECT {", ".join(FACT_TEXTS)}, {", ".join(map(_flag, FACT_NUMBERS))}
        FROM fact_raw""",
    "histogram_fact": _union([_histogram("fact_raw", c, 46) for c in FACT_NUMBERS]),
    "histogram_dates": _histogram("fact_raw", "WorkDate", 231),
    "histogram_dim": _union([_histogram("dim_raw", c, 50) for c in DIM_NUMBERS]),
    "duplicate_rows": """SELECT text, lang, source, n_chars FROM
        (SELECT *, row_number() OVER (PARTITION BY text, lang, source, n_chars) AS rn FROM documents)
        WHERE rn > 1""",
    "repeated_rows": _repeated(
        "(SELECT * FROM fact_raw UNION ALL SELECT * FROM fact_raw WHERE MDScensus % 7 = 0)", list(FACT_RAW)
    ),
    "has_duplicate_rows": _has_repeated("fact_raw", list(FACT_RAW)),
    "key_uniqueness": _repeated("fact_raw", ["PROVNUM", "WorkDate"]),
    "has_duplicate_keys": _has_repeated("fact_raw", ["PROVNUM", "WorkDate"]),
    "has_duplicate_provider_keys": _has_repeated("dim_raw", [CCN]),
    "quality_report": _union(
        [
            _failed("provider_key_repeated", _repeated("silver_dim", ["PROVIDER_NUM"])),
            _failed(
                "provider_key_missing", "SELECT 1 FROM silver_dim WHERE PROVIDER_NUM IS NULL"
            ),
            _failed(
                "provider_key_not_numeric",
                "SELECT 1 FROM silver_dim WHERE NOT regexp_full_match(PROVIDER_NUM, '[0-9]+')",
            ),
            _failed("work_day_key_repeated", _repeated("silver_fact", ["PROVNUM", "WORKDATE"])),
            _failed(
                "work_day_key_missing",
                "SELECT 1 FROM silver_fact WHERE PROVNUM IS NULL OR WORKDATE IS NULL",
            ),
        ]
    ),
    "csv_roundtrip": "SELECT * FROM fact_raw",
    "csv_rejects": _union(
        [
            f"""SELECT '{beside}' AS beside, count(*) AS n_rows,
            count(*) FILTER (COUNTY_FIPS = 7) AS n_rejected, {values} AS n_values FROM fact_raw"""
            for beside, values in (
                ("census", "count(MDScensus) FILTER (COUNTY_FIPS <> 7)"),
                ("rejects alone", "CAST(0 AS INT)"),
                ("another column", "count(STATE)"),
            )
        ]
    ),
    "csv_missing_tokens": """SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_name END AS name,
        CAST(CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_nationkey END AS INT) AS nation FROM supplier""",
    "csv_multi_line": """SELECT *, concat(c_name, chr(10), '"', c_mktsegment, '", ', chr(10), chr(10), c_custkey)
        AS c_label FROM customer""",
    "csv_multi_line_sweep": """SELECT c_mktsegment AS segment, count(*) AS n_rows,
        (SELECT count(*) + 1 FROM (DESCRIBE customer)) AS n_columns FROM customer GROUP BY 1""",
    "csv_pandas_types": """SELECT CAST(o_orderkey AS BIGINT) AS order_key,
        CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS DOUBLE) END AS customer,
        CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_totalprice AS DOUBLE) END AS price, o_orderkey % 2 = 0 AS even,
        CASE WHEN o_orderkey % 7 <> 0 THEN 'false' END AS unsure, CAST(NULL AS DOUBLE) AS nothing,
        concat(o_orderstatus, '1') AS status, CAST(o_orderkey * 1000000007 AS BIGINT) AS wide FROM orders""",
    "csv_inferred": "SELECT * FROM dim_raw",
    "csv_charset": """SELECT c_custkey, concat(c_name, ' – café ', c_mktsegment) AS c_label
        FROM customer""",
    "csv_sweep": f"""SELECT 'fact' AS dataset, count(*) AS n_rows,
        CAST({len(FACT_RAW)} AS BIGINT) AS n_columns, '{"|".join(FACT_RAW)}' AS columns FROM fact_raw
        UNION ALL SELECT 'dim', count(*), {len(DIM_RAW)}, '{"|".join(DIM_RAW)}' FROM dim_raw""",
    "csv_heads": f"""SELECT dataset, place, share, CAST(line AS INT) AS line, value FROM (
        SELECT 'dim' AS dataset, coalesce("State", 'none') AS place, CAST(substr("{CCN}", 12, 1) AS BIGINT) % 4 AS share,
               concat("{CCN}", ',', "Provider Name") AS value, row_number() OVER (
                   PARTITION BY coalesce("State", 'none'), CAST(substr("{CCN}", 12, 1) AS BIGINT) % 4
                   ORDER BY "{CCN}", "Provider Name") AS line
        FROM dim_raw UNION ALL
        SELECT 'fact' AS dataset, STATE AS place, CAST(WorkDate % 4 AS BIGINT) AS share,
               concat_ws(',', PROVNUM, WorkDate, coalesce(CAST(MDScensus AS VARCHAR), '')) AS value, row_number() OVER (
                   PARTITION BY STATE, WorkDate % 4 ORDER BY PROVNUM, WorkDate, MDScensus NULLS FIRST) AS line
        FROM fact_raw) WHERE line <= 3""",
    "bronze_manifest": """SELECT d.*, CASE WHEN NOT landed THEN NULL WHEN dataset = 'dim' THEN (SELECT count(*) FROM dim_raw)
        ELSE (SELECT count(*) FROM fact_raw) END AS n_lines
        FROM (VALUES ('dim', 'first', NULL, true, true, true, true), ('dim', 'second', NULL, true, true, true, true),
                     ('dim', 'turned', NULL, true, true, true, false), ('fact', 'first', NULL, true, true, true, true),
                     ('fact', 'second', NULL, true, true, true, true), ('fact', 'turned', NULL, true, true, true, false),
                     ('dim', 'missing', 'providers', false, NULL, NULL, NULL))
             AS d (dataset, copy, source, landed, same_bytes, same_lines, same_order)""",
    "duplicate_header_names": """SELECT n_regionkey, lower(initial) AS name, count(*) AS occurrences,
        CAST(min(pos) AS INT) AS first_position FROM (
            SELECT CAST(n_regionkey AS INT) AS n_regionkey, substr(n_name, 1, 1) AS initial,
                   row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) - 1 AS pos FROM nation)
        GROUP BY 1, 2 HAVING count(*) > 1""",
    "partitioned_sink": """SELECT CAST(WorkDate // 10000 AS INT) AS y, CAST(WorkDate // 100 % 100 AS INT) AS m,
        count(*) AS n, CAST(sum(MDScensus) AS BIGINT) AS residents FROM fact_raw GROUP BY 1, 2""",
    "profile_fact": _profile(
        "fact_raw", list(FACT_RAW), FACT_NUMBERS, ["PROVNUM", "WorkDate"], [*COUNTED_FACT, *FACT_TEXTS], 46
    ),
    "profile_dim": _profile("dim_raw", list(DIM_RAW), DIM_NUMBERS, [CCN], [CCN, "Provider Type"], 50),
    "incremental_run": """SELECT WORKYEAR, WORKMONTH, count(*) AS n_days, CAST(sum(MDSCENSUS) AS BIGINT) AS residents,
        round(sum(HRS_RN_EMP), 4) AS rn_hours FROM fact_staff GROUP BY 1, 2""",
    "kept_counts": _union(
        [
            f"""SELECT '{c}' AS "column", count(*) AS n_rows, count("{c}") AS n_present, {ends}, true AS near FROM fact_raw"""
            for c in FACT_RAW
            for ends in [", ".join(
                f'CAST({f}("{c}") AS DOUBLE) AS {n}' if c in FACT_NUMBERS else f"CAST(NULL AS DOUBLE) AS {n}"
                for f, n in (("min", "least"), ("max", "greatest"))
            )]
        ]
    ),
    "kept_quartiles": _union(
        [f"""SELECT '{c}' AS "column", CAST(s AS DOUBLE) AS share, true AS near FROM (VALUES (0.25), (0.5), (0.75)) v (s)
        WHERE (SELECT count("{c}") FROM fact_raw) > 0""" for c in FACT_NUMBERS]
    ),
    "kept_histogram": _union(
        [f"""SELECT '{c}' AS "column", CAST(bin AS INT) AS bin, true AS near FROM generate_series(0, 19) g (bin)
        WHERE (SELECT count("{c}") FROM fact_raw) > 0""" for c in FACT_NUMBERS]
    ),
    "full_run": _union(
        [
            f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST({n} AS BIGINT) AS n_columns FROM {t}"
            for t, n in (("dim_bed", 9), ("dim_nurse", 14), ("fact_staff", 33))
        ]
    ),
    "full_run_gates": _gates(),
    "full_run_staff_hours": HOURS_LONG,
}

ORACLES = {name: WITH + body for name, body in _BODIES.items()}
