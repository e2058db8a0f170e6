"""Queries for cleaning, filtering, validation and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.fixture import (
    IMPORTANCE_COLUMNS,
    KEY,
    PREFERENCE_COLUMNS,
    RAW,
    RULED,
    SPARSE,
    SURVEY_RANGES,
    TEXT,
    clean_cte,
    complete_sql,
    curated_cte,
    gender_sql,
    range_sql,
    raw_cte,
    sum_sql,
    sum_text,
    survey_clean,
    survey_curated,
    survey_raw,
    tokens_sql,
)
from surveyflow.functions.cells import quoted
from surveyflow.operators import clean, profile, validate
from surveyflow.plans.curate import curate
from surveyflow.rules import LOADER_TOKENS, SURVEY_RULES

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def names_sql(columns, prefix="") -> str:
    return ", ".join(f'{prefix}"{c}"' for c in columns)


@query("q_curate_imputed", f"WITH {curated_cte()} SELECT * FROM imputed")
def _(spark, d):
    return curate(survey_raw(spark, d), "imputed")


@query("q_curate_dropped", f"WITH {curated_cte()} SELECT * FROM dropped")
def _(spark, d):
    return curate(survey_raw(spark, d), "dropped")


@query(
    "q_encode_gender",
    f'WITH {raw_cte()} SELECT {KEY}, {gender_sql()} AS "gender", "match" FROM survey_raw',
)
def _(spark, d):
    raw = survey_raw(spark, d).select(KEY, "gender", "match")
    return clean.encode_binary(raw, "gender", SURVEY_RULES.binary["gender"])


@query(
    "q_null_tokens",
    f"WITH {raw_cte()} SELECT {KEY}, "
    + ", ".join(
        f'CASE WHEN "{c}" IN ({tokens_sql()}) THEN NULL ELSE "{c}" END AS "{c}"' if c in TEXT else f'"{c}"'
        for c in RAW
    )
    + " FROM survey_raw",
)
def _(spark, d):
    return clean.null_tokens(survey_raw(spark, d))


@query(
    "q_null_tokens_trim",
    f"WITH {raw_cte()} SELECT {KEY}, "
    + ", ".join(
        f'CASE WHEN trim("{c}") IN ({tokens_sql(LOADER_TOKENS)}) THEN NULL ELSE trim("{c}") END AS "{c}"'
        if c in TEXT
        else f'"{c}"'
        for c in RAW
    )
    + " FROM survey_raw",
)
def _(spark, d):
    return clean.null_tokens(survey_raw(spark, d), LOADER_TOKENS, trim=True)


@query(
    "q_to_numeric",
    f"WITH {raw_cte()} SELECT {KEY}, "
    + ", ".join(
        f'TRY_CAST("{c}" AS DOUBLE) AS "{c}"' if c in TEXT and c != "gender" else f'"{c}"' for c in RAW
    )
    + " FROM survey_raw",
)
def _(spark, d):
    return clean.to_numeric(survey_raw(spark, d), text_columns=["gender"])


# Each cell of odd text is a spelling around the age and the order key: suffixes, words, exponents, signs, blanks.
ODD = [
    ("suffix_d", "concat(age, 'd')"), ("suffix_f", "concat(k, 'F')"), ("word", "CASE WHEN k%2=0 THEN 'Infinity' ELSE '-inf' END"),
    ("nan_word", "CASE WHEN k%3=0 THEN 'NaN' ELSE age END"), ("huge", "concat(k%9+1, 'e', k%7*100)"), ("tiny", "concat('-', k%9+1, 'E-', k%7*60)"),
    ("no_lead", "concat('.', k)"), ("no_tail", "concat(k, '.')"), ("blanks", "concat('  +', k, ' ')"), ("comma", "concat(k, ',5')"),
    ("hexadecimal", "concat('0x', k)"), ("empty", "CASE WHEN k%2=0 THEN '' ELSE ' ' END"), ("missing", "CASE WHEN k%2=0 THEN NULL ELSE age END"),
]
ODD_SELECT = f"SELECT k AS {KEY}, {', '.join(f'{x} AS {c}' for c, x in ODD)} FROM (SELECT {KEY} AS k, age FROM {{0}}) o"
ODD_NUMBER = "regexp_full_match({0}, '\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*')"


@query(
    "q_to_numeric_odd",
    f"WITH {raw_cte()}, odd AS ({ODD_SELECT.format('survey_raw')}) SELECT {KEY}, "
    + ", ".join(
        f"CASE WHEN {ODD_NUMBER.format(c)} AND isfinite(TRY_CAST({c} AS DOUBLE)) THEN TRY_CAST({c} AS DOUBLE) END AS {c}"
        for c, _ in ODD
    )
    + " FROM odd",
)
def _(spark, d):
    return clean.to_numeric(spark.sql(ODD_SELECT.format("{raw}"), raw=survey_raw(spark, d)))


@query(
    "q_drop_sparse",
    f"""WITH {raw_cte()}, t AS (SELECT {KEY}, {', '.join(
        f'CASE WHEN "{c}" IN ({tokens_sql()}) THEN NULL ELSE "{c}" END AS "{c}"' if c in TEXT else f'"{c}"'
        for c in RAW)} FROM survey_raw),
s AS (SELECT 'rec_id' AS column_name, 0.0 AS share UNION ALL {' UNION ALL '.join(
        f"SELECT '{c}', avg(CASE WHEN {chr(34)}{c}{chr(34)} IS NULL THEN 1.0 ELSE 0.0 END) FROM t"
        for c in RAW)})
SELECT s.column_name, (SELECT count(*) FROM t) AS rows FROM s WHERE share <= 0.5""",
)
def _(spark, d):
    tokens = clean.null_tokens(survey_raw(spark, d))
    kept = clean.drop_sparse(tokens, max_missing=0.5, keep=[KEY])
    wide = kept.agg(*[F.count(F.lit(1)).alias(c) for c in kept.columns])
    return wide.unpivot([], [quoted(c) for c in kept.columns], "column_name", "rows")


MESSY = {
    "o_orderkey": " Order Key ",
    "o_custkey": "order-key",
    "o_orderstatus": "ORDER__KEY",
    "o_totalprice": "%%",
    "o_orderdate": "",
    "o_orderpriority": "Order.Priority (text)",
}


@query(
    "q_normalize_names",
    "SELECT o_orderkey AS order_key, o_custkey AS order_key_2, o_orderstatus AS order__key, "
    'o_totalprice AS "column", o_orderdate AS column_2, o_orderpriority AS order_priority_text FROM orders',
)
def _(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet").select(*MESSY)
    return clean.normalize_names(orders.toDF(*MESSY.values()))


ALIGNED = ["like", "age", "not_in_the_data", "wave"]


@query(
    "q_align",
    f'WITH {clean_cte()} SELECT "like", "age", CAST(NULL AS DOUBLE) AS not_in_the_data, "wave" FROM clean',
)
def _(spark, d):
    return clean.align(survey_clean(spark, d), ALIGNED)


@query("q_label", f'WITH {clean_cte()} SELECT {KEY}, "like", CAST("met" AS INT) AS "met" FROM clean WHERE "met" IS NOT NULL')
def _(spark, d):
    return clean.label_rows(survey_clean(spark, d).select(KEY, "like", "met"), "met")


@query(
    "q_surrogate_id",
    "SELECT o_orderkey, md5(concat_ws('|', CAST(o_custkey AS VARCHAR), o_orderstatus, "
    "CAST(o_orderkey AS VARCHAR))) AS id FROM orders",
)
def _(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    keyed = clean.surrogate_key(orders, ["o_custkey", "o_orderstatus", "o_orderkey"])
    return keyed.select("o_orderkey", "id")


# ---- filters ------------------------------------------------------------------------


@query("q_range_filter", f"WITH {clean_cte()} SELECT {KEY} FROM clean WHERE {range_sql()}")
def _(spark, d):
    return validate.filter_ranges(survey_clean(spark, d), SURVEY_RULES).select(KEY)


@query("q_sum_filter", f"WITH {clean_cte()} SELECT {KEY} FROM clean WHERE {sum_sql()}")
def _(spark, d):
    return validate.filter_sums(survey_clean(spark, d), SURVEY_RULES).select(KEY)


@query("q_sum_filter_strict", f"WITH {clean_cte()} SELECT {KEY} FROM clean WHERE {sum_sql(missing='zero')}")
def _(spark, d):
    return validate.filter_sums(survey_clean(spark, d), SURVEY_RULES, missing="zero").select(KEY)


@query("q_sum_filter_loose", f"WITH {clean_cte()} SELECT {KEY} FROM clean WHERE {sum_sql(tolerance=1)}")
def _(spark, d):
    return validate.filter_sums(survey_clean(spark, d), SURVEY_RULES.with_tolerance(1)).select(KEY)


@query("q_complete_cases", f"WITH {clean_cte()} SELECT {KEY} FROM clean WHERE {complete_sql()}")
def _(spark, d):
    return validate.complete_cases(survey_clean(spark, d)).select(KEY)


def reasons_sql() -> str:
    parts = [
        f"CASE WHEN \"{name}\" < {low} OR \"{name}\" > {high} "
        f"THEN '{name} must be between {low} and {high}' END"
        for name, low, high in SURVEY_RANGES
    ]
    for columns, label in ((PREFERENCE_COLUMNS, "preference"), (IMPORTANCE_COLUMNS, "importance")):
        parts.append(
            f"CASE WHEN abs({sum_text(columns)} - 100) > 0.01 "
            f"THEN '{label} percentages must sum to 100' END"
        )
    return f"concat_ws('; ', {', '.join(parts)})"


@query("q_validation_reasons", f"WITH {clean_cte()} SELECT {KEY}, {reasons_sql()} AS reasons FROM clean")
def _(spark, d):
    found = validate.with_reasons(survey_clean(spark, d), SURVEY_RULES)
    return found.select(KEY, F.concat_ws("; ", "reasons").alias("reasons"))


@query(
    "q_invalid_records",
    f"WITH {clean_cte()} SELECT * FROM (SELECT {KEY}, {reasons_sql()} AS reasons FROM clean) t WHERE reasons <> ''",
)
def _(spark, d):
    _valid, invalid = validate.split_rows(survey_clean(spark, d), SURVEY_RULES, [KEY])
    return invalid.select(KEY, F.concat_ws("; ", "reasons").alias("reasons"))


@query("q_valid_records", f"WITH {clean_cte()} SELECT * FROM clean WHERE {range_sql()} AND {sum_sql()}")
def _(spark, d):
    valid, _invalid = validate.split_rows(survey_clean(spark, d), SURVEY_RULES, [KEY])
    return valid


# ---- profiles -----------------------------------------------------------------------


@query(
    "q_funnel",
    f"""WITH {curated_cte()}
SELECT 'raw' AS stage, count(*) AS rows FROM clean
UNION ALL SELECT 'in_range', count(*) FROM clean WHERE {range_sql()}
UNION ALL SELECT 'sums_ok', count(*) FROM imputed
UNION ALL SELECT 'complete', count(*) FROM dropped""",
)
def _(spark, d):
    return profile.funnel(survey_clean(spark, d), SURVEY_RULES)


def null_rows_sql(columns, table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count(\"{c}\") AS missing, "
        f"round((count(*) - count(\"{c}\")) * 100.0 / count(*), 2) AS pct FROM {table}"
        for c in columns
    )


@query(
    "q_null_profile",
    f"""WITH {raw_cte()}, t AS MATERIALIZED (SELECT {', '.join(
        f'CASE WHEN "{c}" IN ({tokens_sql()}) THEN NULL ELSE "{c}" END AS "{c}"' if c in TEXT else f'"{c}"'
        for c in RAW)} FROM survey_raw)
SELECT column_name, missing, CAST(pct AS DOUBLE) AS pct FROM ({null_rows_sql(RAW, 't')}) p
ORDER BY missing DESC, column_name LIMIT 25""",
)
def _(spark, d):
    return profile.null_profile(clean.null_tokens(survey_raw(spark, d)).drop(KEY), top=25)


@query(
    "q_null_counts",
    f"WITH {clean_cte()} SELECT " + ", ".join(f'count(*) - count("{c}") AS "{c}"' for c in RULED) + " FROM clean",
)
def _(spark, d):
    return profile.null_counts(survey_clean(spark, d).drop(KEY))


@query(
    "q_out_of_range",
    f"WITH {clean_cte()}, w AS (SELECT "
    + ", ".join(
        f'sum(CASE WHEN "{c}" < {low} OR "{c}" > {high} THEN 1 ELSE 0 END) AS "{c}"'
        for c, low, high in SURVEY_RANGES
    )
    + " FROM clean) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(\"{c}\" AS BIGINT) AS out_of_range FROM w" for c in RULED
    ),
)
def _(spark, d):
    return profile.out_of_range_counts(survey_clean(spark, d), SURVEY_RULES)


@query("q_dedupe", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def _(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    return clean.normalize_table(lines)


@query(
    "q_dedupe_rows",
    "SELECT DISTINCT * REPLACE (CASE WHEN trim(l_returnflag) IN ({t}) THEN NULL ELSE trim(l_returnflag) END AS l_returnflag, "
    "CASE WHEN trim(l_linestatus) IN ({t}) THEN NULL ELSE trim(l_linestatus) END AS l_linestatus) FROM lineitem".format(
        t=tokens_sql(LOADER_TOKENS)
    ),
)
def _(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    return clean.normalize_table(lines.union(lines))


HALF_OFF = f'SELECT * REPLACE ("pref_o_attractive" + CASE WHEN {KEY} % 3 = 0 THEN 0.5 ELSE 0 END AS "pref_o_attractive") FROM clean'


@query(
    "q_sum_tolerances",
    f"WITH {clean_cte()}, half AS ({HALF_OFF}) SELECT {KEY}, {sum_sql()} AS strict, {sum_sql(tolerance=1)} AS loose FROM half",
)
def _(spark, d):
    """Sums that are off by one half pass the wider tolerance only."""
    off = F.when(F.col(KEY) % 3 == 0, 0.5).otherwise(0.0)
    half = survey_clean(spark, d).withColumn("pref_o_attractive", F.col("pref_o_attractive") + off)
    rows = {name: validate.filter_sums(half, rules).select(KEY, F.lit(True).alias(name)) for name, rules in TOLERANCES.items()}
    # A row per survey row on each side: its few bytes in Parquet would have it broadcast through the driver.
    joined = half.select(KEY).join(rows["strict"].hint("merge"), KEY, "left").join(rows["loose"].hint("merge"), KEY, "left")
    return joined.select(KEY, *[F.coalesce(name, F.lit(False)).alias(name) for name in rows])


TOLERANCES = {"strict": SURVEY_RULES, "loose": SURVEY_RULES.with_tolerance(1)}

NAN = "CASE WHEN o_orderkey % 9 = 0 THEN CAST('NaN' AS DOUBLE) WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END"


@query(
    "q_nan_profile",
    f"""WITH t AS (SELECT o_orderkey, {NAN} AS price FROM orders)
SELECT 'o_orderkey' AS column_name, FALSE AS with_nan, 0 AS missing UNION ALL SELECT 'o_orderkey', TRUE, 0
UNION ALL SELECT 'price', FALSE, count_if(price IS NULL) FROM t
UNION ALL SELECT 'price', TRUE, count_if(price IS NULL OR isnan(price)) FROM t""",
)
def _(spark, d):
    """NaN counts as missing in one profile and not in the other."""
    rows = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.expr(NAN).alias("price"))
    both = [
        profile.null_profile(rows, count_nan=nan).select("column_name", F.lit(nan).alias("with_nan"), "missing")
        for nan in (False, True)
    ]
    return both[0].union(both[1])


MEANS = ["like", "funny_partner", "intelligence_partner", "guess_prob_liked"]


def means_sql(by: str) -> str:
    means = ", ".join(f'round(avg("{c}"), 6) AS "avg_{c}"' for c in MEANS)
    return f'WITH {curated_cte()} SELECT "{by}", count(*) AS rows, {means} FROM imputed GROUP BY 1'


@query("q_means_by_match", means_sql("match"))
def _(spark, d):
    return profile.group_means(survey_curated(spark, d, "imputed"), ["match"], MEANS)


@query("q_means_by_wave", means_sql("wave"))
def _(spark, d):
    return profile.group_means(survey_curated(spark, d, "imputed"), ["wave"], MEANS)


def quality_sql(name: str) -> str:
    nulls = "+".join(f'(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END)' for c in RULED)
    return (
        f"SELECT '{name}' AS dataset, CAST(\"match\" AS INT) AS \"match\", count(*) AS rows, "
        f"CAST(sum({nulls}) AS BIGINT) AS nulls FROM {name} GROUP BY 2"
    )


@query("q_quality_by_dataset", f"WITH {curated_cte()} {quality_sql('imputed')} UNION ALL {quality_sql('dropped')}")
def _(spark, d):
    return profile.quality({mode: survey_curated(spark, d, mode) for mode in ("imputed", "dropped")})


@query(
    "q_scatter",
    f'WITH {curated_cte()} SELECT "attractive_partner", "shared_interests_partner", "match", count(*) AS rows '
    "FROM imputed GROUP BY 1, 2, 3",
)
def _(spark, d):
    curated = survey_curated(spark, d, "imputed")
    return profile.scatter(curated, "attractive_partner", "shared_interests_partner", "match")


__all__ = ["ORACLE", "QUERIES", "SPARSE"]
