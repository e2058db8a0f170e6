"""Cleaning projections. Each operator is one ``select``: narrow, no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyflow.functions.cells import binary_code, quoted, to_number, token_to_null
from surveyflow.functions.names import unique_names
from surveyflow.rules import LOADER_TOKENS, MISSING_TOKENS, RuleSet


#: Name of the struct that holds bound cells for the length of one operator.
BOUND = "__bound_cells"


def encode_binary(df: DataFrame, column: str, mapping: dict[str, int]) -> DataFrame:
    """Replace a two-valued text column by its integer codes, where it exists."""
    if column not in df.columns:
        return df
    return df.withColumn(column, binary_code(quoted(column), mapping))


def null_tokens(
    df: DataFrame,
    tokens: Sequence[str] = MISSING_TOKENS,
    trim: bool = False,
) -> DataFrame:
    """Turn missing-value spellings into NULL in every column, keeping its type."""
    return df.select(
        [token_to_null(quoted(f.name), f.dataType, tokens, trim).alias(f.name) for f in df.schema]
    )


def to_numeric(
    df: DataFrame, text_columns: Sequence[str] = (), numeric_type: str = "double"
) -> DataFrame:
    """Cast every text column to a number, except those named in ``text_columns``."""
    return df.select(
        [
            to_number(quoted(f.name), numeric_type).alias(f.name)
            if isinstance(f.dataType, T.StringType) and f.name not in text_columns
            else quoted(f.name)
            for f in df.schema
        ]
    )


def clean_cells(
    df: DataFrame,
    rules: RuleSet,
    text_columns: Sequence[str] = (),
    numeric_type: str = "double",
    keys: Sequence[str] = (),
    number_columns: Sequence[str] = (),
) -> DataFrame:
    """Codes, tokens, casts and sparse columns in a single projection.

    Text is cast where a rule or ``number_columns`` names the column and ``text_columns`` does
    not; other text only loses its missing tokens. Columns in ``keys`` pass untouched.
    """
    numbers = {*rules.columns, *number_columns, rules.label, *(name for group in rules.sums for name in group.columns)}

    def cell(field: T.StructField) -> Column:
        source = quoted(field.name)
        if field.name in keys:
            return source
        if field.name in rules.binary:
            return binary_code(source, rules.binary[field.name])
        value = token_to_null(source, field.dataType, rules.tokens)
        if isinstance(field.dataType, T.StringType) and field.name in numbers and field.name not in text_columns:
            # A token never parses to a number, apart from NaN, which to_number removes.
            return to_number(source, numeric_type)
        return value

    return df.select([cell(f).alias(f.name) for f in df.schema if f.name in keys or f.name not in rules.sparse_columns])


def bind(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows with ``columns`` computed once, whatever filters and projections follow.

    A filter above a plain projection is pushed below it with every expression written out again at
    each mention. These cells pass as one struct through a generator of one row, which filters
    do not cross. Other columns go around it, so that those nobody asks for are still not read.
    """
    if not columns:
        return df
    chosen, around = set(columns), [quoted(c) for c in df.columns if c not in set(columns)]
    cells = F.struct(*[quoted(c) for c in df.columns if c in chosen])
    held = df.select(*around, cells.alias(BOUND))
    return held.select(*around, F.inline(F.array(quoted(BOUND)))).select(*[quoted(c) for c in df.columns])


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Drop the columns that exist."""
    return df.drop(*[name for name in columns if name in df.columns])


def drop_sparse(df: DataFrame, max_missing: float, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns whose share of NULLs exceeds ``max_missing``: one aggregate over the table."""
    candidates = [name for name in df.columns if name not in keep]
    shares = df.agg(
        *[F.avg(quoted(name).isNull().cast("int")).alias(f"c{i}") for i, name in enumerate(candidates)]
    ).first()
    return df.drop(*[name for i, name in enumerate(candidates) if (shares[i] or 0.0) > max_missing])


def normalize_names(df: DataFrame) -> DataFrame:
    """Rename all columns, by position, to unique lower-case identifiers."""
    return df.toDF(*unique_names(df.columns))


def normalize_table(df: DataFrame) -> DataFrame:
    """What the relational loader does to a table: names, trimmed text, tokens, no duplicates."""
    return null_tokens(normalize_names(df), LOADER_TOKENS, trim=True).dropDuplicates()


def align(df: DataFrame, columns: Sequence[str], fill: float | None = None) -> DataFrame:
    """Exactly these columns in this order; absent ones hold ``fill``, others are dropped."""
    present = set(df.columns)
    return df.select(
        [
            quoted(name) if name in present else F.lit(fill).cast("double").alias(name)
            for name in columns
        ]
    )


def label_rows(df: DataFrame, label: str) -> DataFrame:
    """Rows with a usable label, the label as an integer."""
    return df.filter(quoted(label).isNotNull()).withColumn(label, quoted(label).cast("int"))


def column_kinds(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Names of the numeric and of the other columns, in table order."""
    fields = [f for f in df.schema if f.name not in exclude]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    return numeric, [f.name for f in fields if f.name not in numeric]


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first few rows, for looking at."""
    return df.limit(rows)


def surrogate_key(df: DataFrame, keys: Sequence[str], name: str = "id") -> DataFrame:
    """A stable technical key computed row by row from the key columns."""
    from surveyflow.functions.order import key_hash

    return df.withColumn(name, key_hash(keys))
