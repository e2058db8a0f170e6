"""Queries for sampling, encoding, scaling, metrics and the learned operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.fixture import IMPORTANCE_COLUMNS, KEY, RULED, curated_cte, survey_curated
from surveyflow.functions.cells import quoted
from surveyflow.operators import encode, metrics, sampling, select

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


@query(
    "q_stratified_split",
    f"""WITH {curated_cte()}, ranked AS (
  SELECT {KEY}, "match", row_number() OVER (PARTITION BY "match" ORDER BY md5({KEY} || '|456')) AS position,
         count(*) OVER (PARTITION BY "match") AS n FROM imputed)
SELECT {KEY}, "match", CASE WHEN position <= floor(0.3 * n + 0.5) THEN 'test' ELSE 'train' END AS part FROM ranked""",
)
def _(spark, d):
    rows = survey_curated(spark, d, "imputed").select(KEY, "match")
    flagged = sampling.with_test_flag(rows, "match", [KEY], test=0.3, seed=456)
    return flagged.select(KEY, "match", F.when(F.col("is_test"), "test").otherwise("train").alias("part"))


@query(
    "q_oversample",
    """WITH n AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1),
r AS (SELECT doc_id, l.quality, n, (SELECT max(n) FROM n) AS largest,
        row_number() OVER (PARTITION BY l.quality ORDER BY md5(doc_id || '|2600')) AS position
      FROM labels l JOIN n ON l.quality = n.quality),
c AS (SELECT doc_id, quality,
        CAST(floor(largest / n) AS BIGINT) + CASE WHEN position <= largest % n THEN 1 ELSE 0 END AS copies FROM r)
SELECT doc_id, quality, copy FROM (SELECT doc_id, quality, unnest(range(copies)) AS copy FROM c) t""",
)
def _(spark, d):
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality")
    return sampling.oversample(labels, "quality", ["doc_id"], seed=2600)


DUMMIES_SQL = """SELECT o_orderkey, {} FROM orders""".format(
    ", ".join(
        f"CASE WHEN {column} = '{value}' THEN 1.0 ELSE 0.0 END::DOUBLE AS \"{column}_{value}\""
        for column, value in [
            ("o_orderstatus", "O"),
            ("o_orderstatus", "P"),
            ("o_orderpriority", "2-HIGH"),
            ("o_orderpriority", "3-MEDIUM"),
            ("o_orderpriority", "4-NOT SPECIFIED"),
            ("o_orderpriority", "5-LOW"),
        ]
    )
)


@query("q_dummies", DUMMIES_SQL)
def _(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    model = encode.fit_dummies(orders, ["o_orderstatus", "o_orderpriority"])
    return encode.encode_dummies(orders, model)


NUMERIC = [c for c in RULED if c != "match"]


@query(
    "q_mean_impute",
    f"WITH {curated_cte()} SELECT {KEY}, "
    + ", ".join(f'round(coalesce("{c}", avg("{c}") OVER ()), 6) AS "{c}"' for c in NUMERIC)
    + " FROM imputed",
)
def _(spark, d):
    rows = survey_curated(spark, d, "imputed").select(KEY, *NUMERIC)
    numbers = rows.select(KEY, *[quoted(c).cast("double").alias(c) for c in NUMERIC])
    filled = encode.fill_means(numbers, encode.column_means(numbers, NUMERIC))
    return filled.select(KEY, *[F.round(quoted(c), 6).alias(c) for c in NUMERIC])


@query(
    "q_standardize",
    f"WITH {curated_cte()} SELECT {KEY}, "
    + ", ".join(
        f'round(("{c}" - avg("{c}") OVER ()) / coalesce(nullif(stddev_pop("{c}") OVER (), 0), 1), 6) AS "{c}"'
        for c in NUMERIC
    )
    + " FROM dropped",
)
def _(spark, d):
    rows = survey_curated(spark, d, "dropped").select(KEY, *NUMERIC)
    scaled = encode.scale(rows, encode.fit_scale(rows, NUMERIC))
    return scaled.select(KEY, *[F.round(quoted(c), 6).alias(c) for c in NUMERIC])


SCORED_SQL = """scored AS (SELECT l.doc_id, l.quality AS y, CAST(n_chars AS DOUBLE) AS score,
  CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END AS predicted
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""
COUNTS_SQL = """counts AS (SELECT
  count(*) FILTER (y = 0 AND predicted = 0) AS true_negative,
  count(*) FILTER (y = 0 AND predicted = 1) AS false_positive,
  count(*) FILTER (y = 1 AND predicted = 0) AS false_negative,
  count(*) FILTER (y = 1 AND predicted = 1) AS true_positive FROM scored)"""


def scored(spark, d):
    labels = spark.read.parquet(f"{d}/labels.parquet")
    documents = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "n_chars")
    joined = labels.join(documents, "doc_id")
    return joined.select(
        "doc_id",
        F.col("quality").alias("y"),
        F.col("n_chars").cast("double").alias("score"),
        (F.col("n_chars") > 1000).cast("int").alias("predicted"),
    )


@query("q_confusion", f"WITH {SCORED_SQL}, {COUNTS_SQL} SELECT * FROM counts")
def _(spark, d):
    return metrics.confusion(scored(spark, d), "y", "predicted")


RATES_SQL = """round((true_positive + true_negative) * 1e0
    / (true_positive + true_negative + false_positive + false_negative), 6) AS accuracy,
  round(CASE WHEN true_positive + false_negative = 0 THEN 0
    ELSE true_positive * 1e0 / (true_positive + false_negative) END, 6) AS sensitivity,
  round(CASE WHEN true_negative + false_positive = 0 THEN 0
    ELSE true_negative * 1e0 / (true_negative + false_positive) END, 6) AS specificity"""
AUC_SQL = """SELECT round(sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0 END)
    / count(*), 6)::DOUBLE FROM scored p, scored n WHERE p.y = 1 AND n.y = 0"""
RATES = ("accuracy", "sensitivity", "specificity")


@query("q_class_metrics", f"WITH {SCORED_SQL}, {COUNTS_SQL} SELECT *, {RATES_SQL} FROM counts")
def _(spark, d):
    rates = metrics.class_metrics(metrics.confusion(scored(spark, d), "y", "predicted"))
    return rates.select(*[F.round(c, 6).alias(c) if c in RATES else c for c in rates.columns])


@query("q_auc", f"WITH {SCORED_SQL} SELECT ({AUC_SQL}) AS auc")
def _(spark, d):
    return metrics.auc(scored(spark, d), "y", "score").select(F.round("auc", 6).alias("auc"))


@query("q_evaluate", f"WITH {SCORED_SQL}, {COUNTS_SQL} SELECT *, {RATES_SQL}, ({AUC_SQL}) AS auc FROM counts")
def _(spark, d):
    row = metrics.evaluate(scored(spark, d), "y", "predicted", "score")
    return row.select(*[F.round(c, 6).alias(c) if c in (*RATES, "auc") else c for c in row.columns])


@query(
    "q_auc_by_group",
    """WITH s AS (SELECT l.quality AS y, CAST(n_chars AS DOUBLE) AS score, lang FROM labels l
  JOIN documents d ON l.doc_id = d.doc_id WHERE l.quality IS NOT NULL AND n_chars IS NOT NULL),
g AS (SELECT lang, count_if(y = 1) AS p, count_if(y = 0) AS n FROM s GROUP BY 1),
w AS (SELECT p.lang, sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0 END) AS won
  FROM s p JOIN s n ON p.lang IS NOT DISTINCT FROM n.lang WHERE p.y = 1 AND n.y = 0 GROUP BY 1)
SELECT g.lang, CASE WHEN p * n > 0 THEN round(won / (p * n), 6)::DOUBLE END AS auc
FROM g LEFT JOIN w ON g.lang IS NOT DISTINCT FROM w.lang""",
)
def _(spark, d):
    labels = spark.read.parquet(f"{d}/labels.parquet")
    documents = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "n_chars", "lang")
    areas = metrics.auc(labels.join(documents, "doc_id"), "quality", "n_chars", by=["lang"])
    return areas.select("lang", F.round("auc", 6).alias("auc"))


@query(
    "q_rank_features",
    f"WITH {curated_cte()}, w AS MATERIALIZED (SELECT "
    + ", ".join(f'round(covar_pop("{c}", "match"), 6) AS "{c}"' for c in NUMERIC)
    + " FROM imputed), c AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, \"{c}\" AS coefficient FROM w" for c in NUMERIC)
    + ") SELECT feature, coefficient, row_number() OVER (ORDER BY abs(coefficient) DESC, feature) AS position "
    "FROM c WHERE coefficient <> 0",
)
def _(spark, d):
    rows = survey_curated(spark, d, "imputed").select("match", *NUMERIC)
    wide = rows.agg(*[F.round(F.covar_pop(quoted(c), F.col("match")), 6).alias(c) for c in NUMERIC])
    table = wide.unpivot([], [quoted(c) for c in NUMERIC], "feature", "coefficient")
    return select.rank_features(table)


__all__ = ["IMPORTANCE_COLUMNS", "ORACLE", "QUERIES"]
