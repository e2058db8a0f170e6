"""The stand-in survey: a deterministic wide table computed from ``orders``.

One row per order, every cell integer arithmetic on the order key, so Spark SQL
and the checking database give the same text. The recipe is in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from surveyflow.operators.clean import clean_cells
from surveyflow.plans.curate import curate
from surveyflow.rules import (
    IMPORTANCE_COLUMNS,
    MISSING_TOKENS,
    PREFERENCE_COLUMNS,
    SURVEY_RANGES,
    SURVEY_RULES,
)
from surveyflow.session import scratch_path, tune

KEY = "rec_id"
SPARSE = "expected_num_interested_in_me"
RULED = [name for name, _, _ in SURVEY_RANGES]
RAW = [*RULED, SPARSE]


def q(name: str, spark: bool) -> str:
    return f"`{name}`" if spark else f'"{name}"'


def _cell(j: int, name: str, low: int, high: int, text: str) -> str:
    k = "k"
    if name == "gender":
        return (
            "CASE WHEN k%7=0 THEN ' Male ' WHEN k%7<3 THEN 'male' "
            "WHEN k%7=6 AND k%5=0 THEN '?' WHEN k%7=5 THEN 'FEMALE' ELSE 'female' END"
        )
    if name == "interests_correlate":
        return "CAST((k*37)%201-100 AS DOUBLE)/1e2"
    if name == "met":
        return "CAST(CASE WHEN k%20=0 THEN NULL ELSE k%2 END AS INT)"
    if name == "match":
        return "CASE WHEN (k*65+961)%11+(k*117+3249)%11+k%4>16 THEN 1 ELSE 0 END"
    spread = ["k%5", "k%7", "k%11", "k%3", "k%13"]
    value = f"{low}+({k}*{2 * j + 3}+{j * j})%{high - low + 1}"
    for group, period in ((PREFERENCE_COLUMNS, 41), (IMPORTANCE_COLUMNS, 43)):
        if name in group:
            at = group.index(name)
            value = (
                f"10+{spread[at]}"
                if at < 5
                else f"50-({'+'.join(spread)})+CASE WHEN k%{period}=0 THEN 5 ELSE 0 END"
            )
    return (
        f"CASE WHEN (k+{13 * j})%211=0 THEN '?' WHEN (k+{17 * j})%997=0 "
        f"THEN CAST({high + 5} AS {text}) ELSE CAST({value} AS {text}) END"
    )


def raw_sql(spark: bool = False) -> str:
    """SELECT of the raw survey."""
    text = "STRING" if spark else "VARCHAR"
    cells = [
        f"{_cell(j, name, low, high, text)} AS {q(name, spark)}"
        for j, (name, low, high) in enumerate(SURVEY_RANGES)
    ]
    sparse = f"CASE WHEN k%14<11 THEN '?' ELSE CAST(k%21 AS {text}) END AS {q(SPARSE, spark)}"
    body = ",\n  ".join([f"k AS {KEY}", *cells, sparse])
    return f"SELECT {body}\nFROM (SELECT o_orderkey AS k FROM {{orders}}) o"


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its files are too few for that: keys of 8 bytes move, not what is made of them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def derive_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw survey as a lazy plan over ``orders``."""
    orders = spread(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey"))
    return spark.sql(raw_sql(spark=True), orders=orders)


_written: dict[tuple[str, str, str], str] = {}


def written(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A derived table, written once per session to the shared folder and read from there.

    Stages meet at tables, as between a raw and a curated layer: later plans scan typed
    Parquet with pruned columns instead of recomputing the wide expressions above it.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = scratch_path(spark, name)
        build().write.parquet(path)
        _written[key] = path
    return spark.read.parquet(_written[key])


def survey_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return written(spark, sf_dir, "survey_raw", lambda: derive_raw(spark, sf_dir))


def survey_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed cells, no row removed."""
    raw = survey_raw(spark, sf_dir)
    return written(spark, sf_dir, "survey_clean", lambda: clean_cells(raw, SURVEY_RULES))


def survey_curated(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    raw = survey_raw(spark, sf_dir)
    return written(spark, sf_dir, f"survey_{mode}", lambda: curate(raw, mode))


# ---- SQL texts of the checking side -------------------------------------------------

TEXT = [c for c in RAW if c not in ("interests_correlate", "met", "match")]


def raw_cte() -> str:
    return "survey_raw AS (" + raw_sql().format(orders="orders") + ")"


def tokens_sql(tokens=MISSING_TOKENS) -> str:
    return ", ".join(f"'{token}'" for token in tokens)


def gender_sql(cell: str = '"gender"') -> str:
    return (
        f"CASE lower(trim({cell})) WHEN 'male' THEN 1 WHEN 'female' THEN 0 "
        "WHEN '1' THEN 1 WHEN '0' THEN 0 WHEN '1.0' THEN 1 WHEN '0.0' THEN 0 END"
    )


def clean_cte() -> str:
    """``clean``: the survey after coding, tokens, casts and dropping the sparse column."""
    cells = []
    for name in RULED:
        if name == "gender":
            cells.append(f'{gender_sql()} AS "gender"')
        elif name in TEXT:
            cells.append(
                f'TRY_CAST(CASE WHEN "{name}" IN ({tokens_sql()}) THEN NULL ELSE "{name}" END AS DOUBLE) '
                f'AS "{name}"'
            )
        else:
            cells.append(f'"{name}"')
    return f"{raw_cte()}, clean AS (SELECT {KEY}, {', '.join(cells)} FROM survey_raw)"


def range_sql() -> str:
    return " AND ".join(
        f'("{name}" IS NULL OR "{name}" BETWEEN {low} AND {high})' for name, low, high in SURVEY_RANGES
    )


def sum_text(columns) -> str:
    return "+".join(f'"{c}"' for c in columns)


def sum_sql(tolerance: float = 0.01, missing: str = "pass") -> str:
    parts = []
    for columns in (PREFERENCE_COLUMNS, IMPORTANCE_COLUMNS):
        if missing == "zero":
            total = "+".join(f'coalesce("{c}", 0)' for c in columns)
            parts.append(f"abs({total} - 100) <= {tolerance}")
        else:
            nulls = " OR ".join(f'"{c}" IS NULL' for c in columns)
            parts.append(f"({nulls} OR abs({sum_text(columns)} - 100) <= {tolerance})")
    return " AND ".join(parts)


def complete_sql(columns=RULED) -> str:
    return " AND ".join(f'"{c}" IS NOT NULL' for c in columns)


def curated_cte() -> str:
    """``imputed`` and ``dropped``: the two curated tables."""
    return (
        f"{clean_cte()}, imputed AS (SELECT * FROM clean WHERE {range_sql()} AND {sum_sql()}), "
        f"dropped AS (SELECT * FROM imputed WHERE {complete_sql()})"
    )

