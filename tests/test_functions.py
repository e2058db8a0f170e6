"""Cells, names, rules and file names."""

import math
import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from surveyflow.functions.cells import binary_code, table_name, to_number
from surveyflow.functions.names import unique_names
from surveyflow.operators import clean
from surveyflow.rules import LOADER_TOKENS, MISSING_TOKENS, SURVEY_RULES


def column(df, name):
    return [row[name] for row in df.collect()]


def test_rule_tables():
    assert len(SURVEY_RULES.ranges) == 61
    assert len(set(SURVEY_RULES.columns)) == 61
    assert [SURVEY_RULES.columns[i] for i in (8, 13, 20, 25)] == [
        SURVEY_RULES.sums[0].columns[0], SURVEY_RULES.sums[0].columns[-1],
        SURVEY_RULES.sums[1].columns[0], SURVEY_RULES.sums[1].columns[-1],
    ]
    assert SURVEY_RULES.ranges[0].message == "age must be between 18 and 55"
    assert SURVEY_RULES.sums[0].message == "preference percentages must sum to 100"


def test_names():
    assert unique_names(["A b", "a_b", " a-b ", "%%", ""]) == ["a_b", "a_b_2", "a_b_3", "column", "column_2"]


@given(st.lists(st.text(alphabet=string.printable, max_size=8), max_size=12))
def test_names_are_unique_identifiers(names):
    result = unique_names(names)
    assert len(set(result)) == len(names)
    assert all(name and set(name) <= set(string.ascii_lowercase + string.digits + "_") for name in result)


def test_normalize_names_with_odd_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["A b", "a_b", "a.b", "a`b"])
    assert clean.normalize_names(df).columns == ["a_b", "a_b_2", "a_b_3", "a_b_4"]


def test_tokens_exact_and_trimmed(spark):
    values = [*MISSING_TOKENS, *[f" {t} " for t in MISSING_TOKENS], "word", " word "]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    exact = column(clean.null_tokens(df), "v")
    assert exact == [None] * 8 + values[8:]
    trimmed = column(clean.null_tokens(df, LOADER_TOKENS, trim=True), "v")
    expected = [None if v.strip() in LOADER_TOKENS else v.strip() for v in values]
    assert trimmed == expected
    assert trimmed.count("None") == 2


def test_tokens_leave_other_types_alone(spark):
    df = spark.sql("SELECT 1 AS i, double('nan') AS x, date'2020-01-01' AS d, true AS b, array('?') AS a")
    row = clean.null_tokens(df).first()
    assert (row.i, row.x, str(row.d), row.b, row.a) == (1, None, "2020-01-01", True, ["?"])


def test_to_numeric(spark):
    df = spark.createDataFrame([("21",), ("1.5",), ("x",), ("NaN",), (None,), (" 7 ",)], "v string")
    assert column(clean.to_numeric(df), "v") == [21.0, 1.5, None, None, None, 7.0]
    assert dict(clean.to_numeric(df, numeric_type="float").dtypes) == {"v": "float"}
    assert dict(clean.to_numeric(df, text_columns=["v"]).dtypes) == {"v": "string"}


def test_binary_code_is_idempotent(spark):
    df = spark.createDataFrame([(v,) for v in ["male", " Male ", "FEMALE", "?", None, "1", "0.0", "2"]], "g string")
    code = SURVEY_RULES.binary["gender"]
    once = df.select(binary_code(F.col("g"), code).alias("g"))
    twice = once.select(binary_code(F.col("g"), code).alias("g"))
    assert column(once, "g") == [1, 1, 0, None, None, 1, 0, None]
    assert column(twice, "g") == column(once, "g")
    floats = once.select(binary_code(F.col("g").cast("double"), code).alias("g"))
    assert column(floats, "g") == column(once, "g")


def test_table_name(spark):
    df = spark.createDataFrame([("Sub Dir",), ("__a-b.c__",), ("X1",)], "n string")
    assert column(df.select(table_name(F.col("n")).alias("n")), "n") == ["sub_dir", "a_b_c", "x1"]


def test_drop_sparse_and_align(spark):
    df = spark.sql("SELECT id AS k, if(id % 5 = 0, id, NULL) AS mostly_null, double(id) AS x FROM range(10)")
    assert clean.drop_sparse(df, 0.5).columns == ["k", "x"]
    assert clean.drop_sparse(df, 0.9).columns == df.columns
    aligned = clean.align(df, ["x", "gone", "k"])
    assert aligned.columns == ["x", "gone", "k"]
    assert column(clean.align(df, ["gone"], fill=0.0), "gone") == [0.0] * 10
    assert clean.drop_columns(df, "x", "not there").columns == ["k", "mostly_null"]


def test_labels_kinds_and_keys(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 1.0D, 'a'), (2, NULL, 'b'), (3, 0.0D, 'a') AS t(k, match, t)")
    assert column(clean.label_rows(df, "match"), "match") == [1, 0]
    assert clean.column_kinds(df, exclude=["k"]) == (["match"], ["t"])
    ids = column(clean.surrogate_key(df, ["k", "t"]), "id")
    assert len(set(ids)) == 3 and all(len(i) == 32 for i in ids)
    assert clean.preview(df, 2).count() == 2


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True)), min_size=1, max_size=20))
def test_numbers_never_become_nan(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = column(clean.null_tokens(df), "x")
    assert got == [None if v is None or math.isnan(v) else v for v in values]


def test_drop_unknown_mode(spark):
    from surveyflow.plans.curate import curate

    with pytest.raises(ValueError):
        curate(spark.range(1).toDF("age"), "other")


def test_odd_spellings_of_numbers(spark):
    cells = {"1.5": 1.5, " -2e1 ": -20.0, ".5": 0.5, "7.": 7.0, "10d": None, "10f": None, "Infinity": None, "-inf": None, "1e400": None, "NaN": None, "1,5": None, "": None, "0x1": None}
    df = spark.createDataFrame([(k,) for k in cells], "v string")
    assert {r.v: r.n for r in df.select("v", to_number(F.col("v")).alias("n")).collect()} == cells


def test_only_ruled_columns_are_cast(spark):
    df = spark.createDataFrame([("Ann", "30", "NA", "7"), ("?", "31", "x", "8")], "name string, age string, note string, extra string")
    rows = clean.clean_cells(df, SURVEY_RULES, keys=["note"], number_columns=["extra"]).collect()
    assert [tuple(r) for r in rows] == [("Ann", 30.0, "NA", 7.0), (None, 31.0, "x", 8.0)]
