"""Queries for record batches, files, loading, training, scoring and clustering."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from queries.cleaning import reasons_sql
from queries.fixture import (
    KEY,
    RAW,
    RULED,
    TEXT,
    clean_cte,
    curated_cte,
    raw_cte,
    spread,
    survey_curated,
    survey_raw,
    tokens_sql,
)
from surveyflow.functions.cells import quoted
from surveyflow.operators import clean, cluster, impute, profile, select, validate
from surveyflow.operators.encode import column_means
from surveyflow.plans.load import load_all
from surveyflow.plans.score import cleaned_records, score
from surveyflow.plans.train import TrainConfig, features_of, train
from surveyflow.rules import LOADER_TOKENS, SURVEY_RULES
from surveyflow.session import scratch_path, tune
from surveyflow.sources.discover import discover
from surveyflow.sources.bundle import load_bundle, save_bundle, summary_row
from surveyflow.sources.files import read_csv, write_csv, write_parquet
from surveyflow.sources.records import NO_OBJECT, NO_RECORDS, explode_records, read_body_lines, read_records, with_problems

QUERIES = {}
ORACLE = {}
NUMERIC = [c for c in RULED if c != "match"]


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


# ---- record batches: each survey row as a body of three records -----------------------

VARIANTS = {0: '"age"', 1: "99", 2: "NULL"}


def variant_sql() -> str:
    rest = ", ".join(f'"{c}"' for c in RULED if c != "age")
    return " UNION ALL ".join(
        f'SELECT {KEY}, {index} AS "index", CAST({age} AS DOUBLE) AS "age", {rest} FROM clean'
        for index, age in VARIANTS.items()
    )


@query(
    "q_record_batch",
    f'WITH {clean_cte()}, records AS ({variant_sql()}) SELECT {KEY}, "index", {reasons_sql()} AS reasons FROM records',
)
def _(spark, d):
    raw = survey_raw(spark, d)
    as_is = F.to_json(F.struct(*[quoted(c) for c in RULED]))
    too_old = F.to_json(F.struct(F.lit(99).alias("age"), *[quoted(c) for c in reversed(RULED) if c != "age"]))
    ageless = F.to_json(F.struct(*[quoted(c) for c in RULED if c != "age"], F.lit("ignored").alias("other")))
    body = F.concat(F.lit('{"records":['), F.concat_ws(",", as_is, too_old, ageless), F.lit("]}"))
    records = explode_records(raw.select(KEY, body.alias("body")), "body", RULED, keys=[KEY])
    cleaned = clean.bind(clean.clean_cells(records, SURVEY_RULES), RULED)
    found = validate.with_reasons(cleaned, SURVEY_RULES)
    return found.select(KEY, "index", F.concat_ws("; ", "reasons").alias("reasons"))


@query(
    "q_record_rejects",
    f"""WITH {clean_cte()}
SELECT {KEY}, 'broken' AS kind, CAST(NULL AS INTEGER) AS "index", '{NO_RECORDS}' AS reasons FROM clean
UNION ALL SELECT {KEY}, 'empty', NULL, '{NO_RECORDS}' FROM clean
UNION ALL SELECT {KEY}, 'number', NULL, '{NO_RECORDS}' FROM clean
UNION ALL SELECT {KEY}, 'mixed', i, '{NO_OBJECT}' FROM clean, (VALUES (0), (2), (3)) v(i)
UNION ALL SELECT {KEY}, 'mixed', 1, {reasons_sql()} FROM clean""",
)
def _(spark, d):
    raw = survey_raw(spark, d)
    whole = F.to_json(F.struct(*[quoted(c) for c in RULED]))
    kinds = {
        "broken": F.concat(F.lit('{"records":['), whole),
        "empty": F.lit('{"records":[]}'),
        "number": F.lit("17"),
        "mixed": F.concat(F.lit('{"records":[1,'), whole, F.lit(',null,"text"]}')),
    }
    bodies = F.explode(F.create_map(*[x for kind, body in kinds.items() for x in (F.lit(kind), body)])).alias("kind", "body")
    records = read_records(raw.select(KEY, bodies), "body", RULED, keys=[KEY, "kind"])
    keys = [KEY, "kind", "index"]
    cleaned = clean.bind(clean.clean_cells(records, SURVEY_RULES, keys=[*keys, "problem"]), RULED)
    found = with_problems(validate.with_reasons(cleaned, SURVEY_RULES))
    return found.select(*keys, F.concat_ws("; ", "reasons").alias("reasons"))


@query(
    "q_record_lines",
    f"""WITH {clean_cte()}, r AS (
  SELECT NULL::INTEGER AS i, '{NO_RECORDS}' AS reasons FROM clean, (VALUES (1), (2)) v(x)
  UNION ALL SELECT i, '{NO_OBJECT}' FROM clean, (VALUES (0), (2), (3)) v(i)
  UNION ALL SELECT 1, {reasons_sql()} FROM clean)
SELECT i AS "index", reasons, count(*) AS rows, count(*) AS places FROM r GROUP BY 1, 2""",
)
def _(spark, d):
    """Bodies by lines through files that are read in ranges: what each record is refused for, and how many places that makes."""
    raw = survey_raw(spark, d)
    whole = F.to_json(F.struct(*[quoted(c) for c in RULED]))
    kinds = [
        F.concat(F.lit('{"records":['), whole), F.lit('{"records":[]}'),
        F.concat(F.lit('{"records":[1,'), whole, F.lit(',null,"text"]}')),
    ]
    path = scratch_path(spark, "request-lines")
    raw.select(F.explode(F.array(*kinds)).alias("value")).write.text(path)
    records = read_records(read_body_lines(spark, path, split_bytes=1 << 20), "value", RULED, keys=["body"])
    keys = ["body", "index"]
    cleaned = clean.bind(clean.clean_cells(records, SURVEY_RULES, keys=[*keys, "problem"]), RULED)
    found = with_problems(validate.with_reasons(cleaned, SURVEY_RULES))
    found = found.select(*keys, F.concat_ws("; ", "reasons").alias("reasons"))
    return found.groupBy("index", "reasons").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("body").alias("places"))


# ---- files ----------------------------------------------------------------------------


@query(
    "q_csv_roundtrip",
    f"WITH {raw_cte()} SELECT CAST({KEY} AS VARCHAR) AS {KEY}, "
    + ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' if c == "interests_correlate" else f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in RAW)
    + " FROM survey_raw",
)
def _(spark, d):
    raw = survey_raw(spark, d)
    path = scratch_path(spark, "csv")
    write_csv(raw, path)
    back = read_csv(spark, path, raw.columns)
    # All 63 columns as text; the one written from doubles is compared as such, for engines spell them unlike.
    return back.withColumn("interests_correlate", F.col("interests_correlate").cast("double")).select(KEY, *[quoted(c) for c in RAW])


@query("q_parquet_roundtrip", f"WITH {curated_cte()} SELECT * FROM imputed")
def _(spark, d):
    path = scratch_path(spark, "parquet")
    write_parquet(survey_curated(spark, d, "imputed"), path)
    return spark.read.parquet(path)


@query(
    "q_discover",
    "SELECT t AS table_name, 'parquet' AS format FROM (VALUES "
    + ", ".join(
        f"('{t}')"
        for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
    )
    + ") v(t)",
)
def _(spark, d):
    return discover(spark, d, parquet_unit="file").select("table_name", "format")


TABLE_TEXT = {
    "region": ["r_name"],
    "nation": ["n_name"],
    "customer": ["c_name", "c_mktsegment"],
    "supplier": ["s_name"],
    "part": ["p_name", "p_brand", "p_type"],
    "orders": ["o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_returnflag", "l_linestatus"],
    "events": ["event_type", "props"],
    "documents": ["text", "lang", "source"],
    "embeddings": [],
    "pages": ["url", "html"],
    "benchmark": ["text"],
    "labels": [],
    "conversations": ["role", "text"],
}


def loaded_sql(table: str, columns: list[str]) -> str:
    changed = ", ".join(
        f"CASE WHEN trim({c}) IN ({tokens_sql(LOADER_TOKENS)}) THEN NULL ELSE trim({c}) END AS {c}" for c in columns
    )
    star = f"* REPLACE ({changed})" if columns else "*"
    return f"SELECT '{table}' AS table_name, count(*) AS rows FROM (SELECT DISTINCT {star} FROM {table}) t"


@query("q_load_all", " UNION ALL ".join(loaded_sql(t, c) for t, c in TABLE_TEXT.items()))
def _(spark, d):
    """Every loaded table is read back and has the fingerprint of what was written."""
    tune(spark)
    target = scratch_path(spark, "loaded")
    write = lambda df, name: write_parquet(df, f"{target}/{name}")
    audit = load_all(spark, d, write, parquet_unit="file", read_back=lambda name: spark.read.parquet(f"{target}/{name}"))
    return audit.select("table_name", "rows")


def contents_sql(table: str, columns: list[str], source: str) -> str:
    """(table, column, present, digest): the sum of a part of each text's MD5, which any engine has."""
    number = "('0x' || substr(md5({0}), 1, 8))::BIGINT" if source == "sql" else "cast(conv(substr(md5({0}), 1, 8), 16, 10) AS BIGINT)"
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count({c}) AS present, "
        f"CAST(coalesce(sum({number.format(c)}), 0) AS BIGINT) AS digest FROM {{0}}"
        for c in columns
    )


def _loaded_contents_sql() -> str:
    parts = []
    for table, columns in TABLE_TEXT.items():
        changed = ", ".join(
            f"CASE WHEN trim({c}) IN ({tokens_sql(LOADER_TOKENS)}) THEN NULL ELSE trim({c}) END AS {c}" for c in columns
        )
        if columns:
            parts.append(contents_sql(table, columns, "sql").replace("{0}", f"(SELECT DISTINCT * REPLACE ({changed}) FROM {table}) t"))
    return " UNION ALL ".join(parts)


@query("q_load_contents", _loaded_contents_sql())
def _(spark, d):
    """What the loaded tables hold: present cells and digests of every text column."""
    tune(spark)
    target = scratch_path(spark, "loaded")
    load_all(spark, d, lambda df, name: write_parquet(df, f"{target}/{name}"), parquet_unit="file")
    parts = []
    for table, columns in TABLE_TEXT.items():
        if columns:
            loaded = spark.read.parquet(f"{target}/{table}")
            parts.append(spark.sql(contents_sql(table, columns, "spark").replace("{0}", "{loaded}"), loaded=loaded))
    return reduce(lambda a, b: a.union(b), parts)


# ---- training and scoring ---------------------------------------------------------------

_bundles: dict[tuple[str, str, str], str] = {}
CONFIG = TrainConfig()


def trained(spark, d, mode: str):
    """A bundle trained on the whole curated table, once per session, and read back from storage."""
    key = (spark.sparkContext.applicationId, d, mode)
    if key not in _bundles:
        path = scratch_path(spark, f"bundle_{mode}")
        save_bundle(spark, train(survey_curated(spark, d, mode), [KEY], config=CONFIG), path)
        _bundles[key] = path
    return load_bundle(spark, _bundles[key])


@query("q_iterative_impute")
def _(spark, d):
    rows = survey_curated(spark, d, "imputed").select(KEY, *NUMERIC)
    return impute.impute(rows, impute.fit_imputer(rows, NUMERIC))


@query("q_l1_select")
def _(spark, d):
    rows = survey_curated(spark, d, "dropped")
    model = select.fit_l1(rows, "match", NUMERIC, [KEY])
    table = spark.createDataFrame(list(model.coefficients.items()), "feature string, coefficient double")
    return select.rank_features(table)


def certified(model: select.L1Model, rows, label: str):
    """Each feature's optimality condition, by plain aggregates over all rows that do not know how the fit went.

    The bound is a thousandth of what the label alone pulls at the feature: only weights next to the optimum keep it.
    """
    table = select.optimality(rows, label, model.coefficients, model.intercept, model.strength)
    start = select.optimality(rows, label, dict.fromkeys(model.coefficients, 0.0), 0.0, model.strength)
    pull = start.agg(F.max(F.abs("slope")).alias("pull"))
    met = table.crossJoin(F.broadcast(pull))  # one row
    return met.select("feature", (F.col("violation") <= F.col("pull") * 1e-3).alias("optimal"), F.lit(model.converged).alias("converged"))


def features_sql(names) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, TRUE AS optimal, TRUE AS converged" for c in names)


@query("q_l1_optimal", features_sql(NUMERIC))
def _(spark, d):
    """Certificate of ``q_l1_select``."""
    rows = survey_curated(spark, d, "dropped")
    return certified(select.fit_l1(rows, "match", NUMERIC, [KEY]), rows, "match")


LINE_FEATURES = {
    "quantity": "l_quantity / 10", "price": "l_extendedprice / 10000", "discount": "l_discount * 20", "tax": "l_tax * 20",
    "line": "double(l_linenumber)", "days": "datediff(l_shipdate, date'1995-01-01') / 365.0", "part": "l_partkey / 10000.0",
}


@query("q_l1_lineitem", features_sql(LINE_FEATURES))
def _(spark, d):
    """The same on all line items: which lines cost more than their discount and tax let one expect."""
    lines = spread(spark.read.parquet(f"{d}/lineitem.parquet"))
    label = F.expr("int(l_extendedprice * (1 - l_discount) + 3000 * pmod(xxhash64(l_orderkey, l_partkey), 7) > 45000)")
    rows = lines.select(
        F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in lines.columns]).alias("line_key"),
        label.alias("dear"), *[F.expr(x).cast("double").alias(c) for c, x in LINE_FEATURES.items()],
    )
    return certified(select.fit_l1(rows, "dear", list(LINE_FEATURES), ["line_key"]), rows, "dear")


def flat(row):
    counts = "metrics.confusion_matrix"
    return row.select(*[c for c in row.columns if c != "metrics"], "metrics.*", f"{counts}.*").drop("confusion_matrix")


@query("q_train_metrics")
def _(spark, d):
    return flat(summary_row(spark, trained(spark, d, "imputed"), "imputed"))


@query("q_compare_models")
def _(spark, d):
    rows = {mode: summary_row(spark, trained(spark, d, mode), mode) for mode in ("dropped", "imputed")}
    return flat(profile.compare(rows))


@query("q_score")
def _(spark, d):
    scored, _rejected = score(survey_raw(spark, d), trained(spark, d, "imputed"), [KEY])
    return scored


@query(
    "q_score_rejected",
    f"WITH {clean_cte()} SELECT * FROM (SELECT {KEY}, {reasons_sql()} AS reasons FROM clean) t WHERE reasons <> ''",
)
def _(spark, d):
    _scored, rejected = score(survey_raw(spark, d), trained(spark, d, "imputed"), [KEY])
    return rejected.select(KEY, F.concat_ws("; ", "reasons").alias("reasons"))


def margin_sql(model) -> str:
    """The plane's value as one SQL expression over the named columns: a second evaluation of the stored parameters."""
    width = (2.0 / len(model.phases)) ** 0.5
    cosines = [
        f"{float(w) * width!r}D * cos({float(phase)!r}D + "
        + " + ".join(f"{float(x)!r}D * `{c}`" for x, c in zip(column, model.columns, strict=True))
        + ")"
        for w, phase, column in zip(model.weights, model.phases, model.directions.T, strict=True)
    ]
    # An array's elements are compiled apart; one sum of all of them would be too long a method.
    return f"{float(model.intercept)!r}D + aggregate(array({', '.join(cosines)}), 0.0D, (a, x) -> a + x)"


@query("q_score_keys", f"WITH {curated_cte()} SELECT {KEY}, TRUE AS sound FROM imputed")
def _(spark, d):
    """Certificate of ``q_score``: exactly the valid records, and each one's class and probability as a second
    evaluation gives them, by SQL arithmetic on the stored parameters; records with their columns reversed score alike."""
    bundle, raw = trained(spark, d, "imputed"), survey_raw(spark, d)
    scored, _rejected = score(raw, bundle, [KEY])
    turned, _rejected = score(raw.select(*[quoted(c) for c in reversed(raw.columns)]), bundle, [KEY])
    valid = validate.valid_rows(cleaned_records(raw, bundle, [KEY]), SURVEY_RULES)
    features = features_of(valid, bundle, [KEY])
    # The 256 cosines are one column, so that what follows does not write them out again.
    second = features.select(KEY, F.explode(F.array(F.expr(margin_sql(bundle.model)))).alias("margin"))
    slope, offset = F.lit(bundle.model.slope), F.lit(bundle.model.offset)
    expected = 1.0 / (1.0 + F.exp(-(F.col("margin") * slope + offset)))
    side = (F.abs("margin") < 1e-9) | (F.col("prediction") == (F.col("margin") > 0).cast("int"))
    same = (F.col("prediction") == F.col("turned")) & (F.col("probability") == F.col("turned_probability"))
    sound = side & same & (F.abs(F.col("probability") - expected) <= 1e-6)
    again = turned.select(KEY, F.col("prediction").alias("turned"), F.col("probability").alias("turned_probability"))
    return scored.join(second, KEY, "full").join(again, KEY, "full").select(KEY, F.coalesce(sound, F.lit(False)).alias("sound"))


@query(
    "q_train_totals",
    f"""WITH {curated_cte()}, sizes AS (
  SELECT "match" AS y, floor(0.3 * count(*) + 0.5) AS n FROM imputed WHERE "match" IS NOT NULL GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS test_rows, CAST(sum(CASE WHEN y = 1 THEN n END) AS BIGINT) AS test_positives, TRUE AS better_than_chance
FROM sizes""",
)
def _(spark, d):
    """Certificate of training: the test part's size and classes, and a model that has learned something."""
    m = trained(spark, d, "imputed").metrics
    negative, positive = m["true_negative"] + m["false_positive"], m["true_positive"] + m["false_negative"]
    row = [(negative + positive, positive, bool(m["auc"] > 0.8))]
    return spark.createDataFrame(row, "test_rows long, test_positives long, better_than_chance boolean")


# ---- imputation, certified on values that are known ---------------------------------------

# Columns that hang together: prices with and without what is taken off and put on, a weight made of two of them.
MEASURES = {
    "price": "l_extendedprice", "net": "l_extendedprice * (1 - l_discount)", "gross": "l_extendedprice * (1 - l_discount) * (1 + l_tax)",
    "quantity": "l_quantity", "load": "l_quantity * 2 + l_extendedprice / 5000 + l_discount * 10",
}
HOLES = {c: f"(l_orderkey * {a} + l_linenumber * 7) % 10 = 0" for c, a in zip(MEASURES, (3, 7, 9, 11, 13), strict=True)}


@query(
    "q_impute_certificate",
    " UNION ALL ".join(
        f"SELECT '{c}' AS measure, count(*) AS rows, count_if({hole}) AS gaps, 0::BIGINT AS changed, 0::BIGINT AS left_empty, "
        f"TRUE AS half_of_mean FROM lineitem"
        for c, hole in HOLES.items()
    ),
)
def _(spark, d):
    """Holes in known values of related columns: what was there stays, all holes are filled, and the error is
    at most half of what filling in the mean would leave."""
    lines = spread(spark.read.parquet(f"{d}/lineitem.parquet"))
    keys = ["l_orderkey", "l_linenumber"]
    known = lines.select(*keys, *[F.expr(x).cast("double").alias(c) for c, x in MEASURES.items()])
    truth = [F.col(c).alias(f"true_{c}") for c in MEASURES]
    holed = known.select(*keys, *truth, *[F.when(~F.expr(hole), F.col(c)).alias(c) for c, hole in HOLES.items()])
    both = impute.impute(holed, impute.fit_imputer(holed, list(MEASURES)))
    means = column_means(holed, list(MEASURES))
    parts = []
    for c, hole in HOLES.items():
        gap = F.expr(hole)
        error = F.avg(F.when(gap, F.abs(F.col(c) - F.col(f"true_{c}"))))
        by_mean = F.avg(F.when(gap, F.abs(F.lit(means[c]) - F.col(f"true_{c}"))))
        parts.append(
            F.struct(
                F.lit(c).alias("measure"), F.count(F.lit(1)).alias("rows"), F.count_if(gap).alias("gaps"),
                F.count_if(~gap & (F.col(c) != F.col(f"true_{c}"))).alias("changed"), F.count_if(F.col(c).isNull()).alias("left_empty"),
                (error <= by_mean * 0.5).alias("half_of_mean"),
            )
        )
    return both.agg(F.array(*parts).alias("parts")).select(F.explode("parts").alias("p")).select("p.*")


# ---- clusters of all line items, from given centroids --------------------------------------

SCALED = {"quantity": "l_quantity / 10", "price": "l_extendedprice / 10000", "discount": "l_discount * 50", "tax": "l_tax * 50"}
STARTS = {k: [dict.fromkeys(SCALED, float(2 * i + 1)) for i in range(k)] for k in (1, 2, 3)}
ROUNDS = 3


def _scaled(spark, d):
    return spark.read.parquet(f"{d}/lineitem.parquet").select(*[F.expr(e).cast("double").alias(c) for c, e in SCALED.items()])


def _nearest_sql(k: int, of: str) -> str:
    distance = [" + ".join(f"(x.{c} - c{i}.{c}) * (x.{c} - c{i}.{c})" for c in SCALED) for i in range(k)]
    best = "CASE " + " ".join(
        f"WHEN {' AND '.join(f'{distance[i]} <= {distance[j]}' for j in range(i + 1, k)) or 'TRUE'} THEN {i}" for i in range(k)
    )
    froms = ", ".join(f"(SELECT * FROM {of} WHERE cluster = {i}) c{i}" for i in range(k))
    return f"SELECT x.*, {best} END AS cluster, least({', '.join(distance)}) AS d FROM x, {froms}"


def _lloyd_sql(k: int, name: str) -> str:
    start = " UNION ALL ".join(
        f"SELECT {i} AS cluster, " + ", ".join(f"{v}::DOUBLE AS {c}" for c, v in s.items()) for i, s in enumerate(STARTS[k])
    )
    steps = [f"{name}0 AS ({start})"]
    for r in range(1, ROUNDS + 1):
        means = ", ".join(f"round(avg({c}), 6) AS {c}" for c in SCALED)
        steps.append(f"{name}{r} AS (SELECT cluster, {means} FROM ({_nearest_sql(k, f'{name}{r - 1}')}) GROUP BY 1)")
    return ", ".join(steps)


X_SQL = "x AS (SELECT " + ", ".join(f"({e})::DOUBLE AS {c}" for c, e in SCALED.items()) + " FROM lineitem)"


@query(
    "q_lloyd_profile",
    f"WITH {X_SQL}, {_lloyd_sql(3, 'm')} SELECT cluster, count(*) AS rows, "
    + ", ".join(f"round(avg({c}), 4) AS avg_{c}" for c in SCALED)
    + f" FROM ({_nearest_sql(3, f'm{ROUNDS}')}) GROUP BY 1",
)
def _(spark, d):
    rows = _scaled(spark, d)
    centroids = cluster.lloyd(rows, list(SCALED), STARTS[3], ROUNDS, digits=6)
    return cluster.cluster_profile(cluster.assign(rows, centroids), list(SCALED), digits=4)


@query(
    "q_lloyd_costs",
    f"WITH {X_SQL}, "
    + ", ".join(_lloyd_sql(k, f"m{k}_") for k in STARTS)
    + " "
    + " UNION ALL ".join(f"SELECT {k} AS k, round(sum(d), 2) AS wss FROM ({_nearest_sql(k, f'm{k}_{ROUNDS}')})" for k in STARTS),
)
def _(spark, d):
    rows = _scaled(spark, d)
    costs = [
        cluster.within_cost(rows, cluster.lloyd(rows, list(SCALED), s, ROUNDS, digits=6)).select(F.lit(k).alias("k"), F.round("wss", 2).alias("wss"))
        for k, s in STARTS.items()
    ]
    return costs[0].union(costs[1]).union(costs[2])


# ---- clustering ---------------------------------------------------------------------------

SHAPE = ["like", "funny_partner", "intelligence_partner", "sports", "museums"]
CENTROIDS = [dict.fromkeys(SHAPE, 3.0), dict.fromkeys(SHAPE, 7.0), {**dict.fromkeys(SHAPE, 5.0), "sports": 9.0}]


def assigned_sql() -> str:
    distances = [
        "+".join(f'("{c}" - {value}) * ("{c}" - {value})' for c, value in centroid.items()) for centroid in CENTROIDS
    ]
    return (
        f"{curated_cte()}, d AS (SELECT *, {', '.join(f'{x} AS d{i}' for i, x in enumerate(distances))} "
        'FROM dropped WHERE "match" = 1), assigned AS (SELECT *, '
        "CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS cluster FROM d)"
    )


@query("q_cluster_assign", f"WITH {assigned_sql()} SELECT {KEY}, cluster FROM assigned")
def _(spark, d):
    rows = cluster.positives(survey_curated(spark, d, "dropped"))
    return cluster.assign(rows, CENTROIDS).select(KEY, "cluster")


@query(
    "q_cluster_profile",
    f"WITH {assigned_sql()} SELECT cluster, count(*) AS rows, "
    + ", ".join(f'round(avg("{c}"), 6) AS "avg_{c}"' for c in SHAPE)
    + " FROM assigned GROUP BY 1",
)
def _(spark, d):
    rows = cluster.positives(survey_curated(spark, d, "dropped"))
    return cluster.cluster_profile(cluster.assign(rows, CENTROIDS), SHAPE)


@query("q_kmeans_profile")
def _(spark, d):
    rows = cluster.positives(survey_curated(spark, d, "dropped")).select(KEY, *SHAPE)
    return cluster.cluster_profile(cluster.with_clusters(rows, SHAPE, k=3), SHAPE)


@query(
    "q_kmeans_settled",
    " UNION ALL ".join(
        f"SELECT {k} AS k, count(*) AS rows, {k}::BIGINT AS clusters, TRUE AS settled, TRUE AS cheaper FROM lineitem" for k in (2, 3, 4)
    ),
)
def _(spark, d):
    """Certificate of k-means and of the elbow on all line items: every cluster has rows, another round moves no
    centroid, each further cluster lowers the cost, and that stays above zero."""
    rows, parts = _scaled(spark, d), []
    before = rows.agg(*[F.var_pop(c).alias(c) for c in SCALED], F.count(F.lit(1)).alias("n")).first()
    cost = before["n"] * sum(before[c] for c in SCALED)
    for k in (2, 3, 4):
        centroids, rests = cluster.settled_clusters(rows, list(SCALED), k)
        last, cost = cost, cluster.within_cost(rows, centroids).first()["wss"]
        again = cluster.lloyd(rows, list(SCALED), centroids, 1, digits=6) == centroids
        found = cluster.assign(rows, centroids).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("cluster").alias("clusters"))
        settled, cheaper = F.lit(rests and again).alias("settled"), F.lit(0 < cost < last).alias("cheaper")
        parts.append(found.select(F.lit(k).alias("k"), "rows", "clusters", settled, cheaper))
    return parts[0].union(parts[1]).union(parts[2])


@query("q_elbow")
def _(spark, d):
    rows = cluster.positives(survey_curated(spark, d, "dropped")).select(*SHAPE)
    return cluster.elbow(rows, SHAPE, ks=range(2, 8))


def axes_sql(columns: dict[str, str], rounds: int = 200) -> str:
    """Both first axes by power iteration on the correlations, the second after taking the first one's part away."""
    names = list(columns)
    cells = [(a, b) for a in names for b in names]
    corr = ", ".join(f"corr({a}, {b}) AS {a}_{b}" for a, b in cells)

    def power(matrix: str, walk: str) -> str:
        turned = {a: " + ".join(f"m.{a}_{b} * v.{b}" for b in names) for a in names}
        length = f"sqrt({' + '.join(f'({x}) * ({x})' for x in turned.values())})"
        start = ", ".join(f"{1 + 0.1 * i}::DOUBLE AS {c}" for i, c in enumerate(names))
        step = ", ".join(f"({x}) / {length} AS {c}" for c, x in turned.items())
        return f"{walk} AS (SELECT 0 AS n, {start} UNION ALL SELECT n + 1, {step} FROM {walk} v, {matrix} m WHERE n < {rounds})"

    def axis(walk: str, matrix: str, number: int) -> str:
        value = " + ".join(f"v.{a} * m.{a}_{b} * v.{b}" for a, b in cells)
        sign = " ".join(f"WHEN abs({c}) >= greatest({', '.join(f'abs({x})' for x in names)}) THEN sign({c})" for c in names)
        return f"SELECT {number} AS axis, {value} AS variance, v.*, CASE {sign} END AS s FROM (SELECT * FROM {walk} WHERE n = {rounds}) v, {matrix} m"

    less = ", ".join(f"m.{a}_{b} - a.variance * a.{a} * a.{b} AS {a}_{b}" for a, b in cells)
    lines = " UNION ALL ".join(
        f"SELECT axis, '{c}' AS feature, round(s * {c}, 4) + 0.0 AS part, round(variance, 4) AS variance FROM both_axes" for c in names
    )
    columns_sql = ", ".join(f"({x})::DOUBLE AS {c}" for c, x in columns.items())
    return (
        f"WITH RECURSIVE x AS (SELECT {columns_sql} FROM lineitem), m1 AS (SELECT {corr} FROM x), {power('m1', 'w1')}, "
        f"a1 AS ({axis('w1', 'm1', 1)}), m2 AS (SELECT {less} FROM m1 m, a1 a), {power('m2', 'w2')}, a2 AS ({axis('w2', 'm2', 2)}), "
        f"both_axes AS (SELECT * FROM a1 UNION ALL SELECT * FROM a2) {lines}"
    )


@query("q_pca_axes", axes_sql(MEASURES))
def _(spark, d):
    """Directions and variances of the first two components of all line items."""
    rows = spark.read.parquet(f"{d}/lineitem.parquet").select(*[F.expr(x).cast("double").alias(c) for c, x in MEASURES.items()])
    axes = cluster.principal_axes(rows, list(MEASURES))
    table = [
        (number, c, float(part), float(variance))
        for number, (direction, variance) in enumerate(zip(axes.directions, axes.variances, strict=True), 1)
        for c, part in zip(axes.columns, direction, strict=True)
    ]
    return spark.createDataFrame(table, "axis int, feature string, part double, variance double").select(
        "axis", "feature", (F.round("part", 4) + F.lit(0.0)).alias("part"), F.round("variance", 4).alias("variance")
    )


@query("q_pca")
def _(spark, d):
    rows = cluster.positives(survey_curated(spark, d, "dropped")).select(KEY, *NUMERIC)
    return cluster.project(rows, NUMERIC, [KEY], k=2)


__all__ = ["ORACLE", "QUERIES", "TEXT"]
