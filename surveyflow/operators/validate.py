"""Row validation: filters that drop, and reports that do not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyflow.functions.cells import quoted
from surveyflow.functions.checks import ranges_ok, reasons, sums_ok
from surveyflow.rules import RuleSet


class RowsRejected(ValueError):
    """Some rows break the rules. ``errors`` is the lazy report on all of them, ``total`` their number."""

    def __init__(self, message: str, errors: DataFrame, total: int) -> None:
        super().__init__(message)
        self.errors = errors
        self.total = total


class EmptyBatch(ValueError):
    """A batch without a single record."""


def filter_ranges(df: DataFrame, rules: RuleSet) -> DataFrame:
    return df.filter(ranges_ok(rules, df.columns))


def filter_sums(df: DataFrame, rules: RuleSet, missing: str = "pass") -> DataFrame:
    return df.filter(sums_ok(rules, df.columns, missing))


def complete_cases(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without NULL or NaN in ``columns``, or in any column."""
    return df.na.drop(subset=None if columns is None else list(columns))


def valid_rows(df: DataFrame, rules: RuleSet) -> DataFrame:
    return df.filter(ranges_ok(rules, df.columns) & sums_ok(rules, df.columns))


def with_reasons(df: DataFrame, rules: RuleSet, name: str = "reasons") -> DataFrame:
    """All rows, with the texts of the rules each one breaks."""
    return df.withColumn(name, reasons(rules, df.columns))


def invalid_rows(df: DataFrame, rules: RuleSet, keys: Sequence[str]) -> DataFrame:
    """Key and reasons of every row that breaks a rule."""
    bad = df.filter(~(ranges_ok(rules, df.columns) & sums_ok(rules, df.columns)))
    return bad.select(*[quoted(key) for key in keys], reasons(rules, df.columns).alias("reasons"))


def split_rows(df: DataFrame, rules: RuleSet, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Valid rows in full, and the report on the others. Together they cover the input."""
    return valid_rows(df, rules), invalid_rows(df, rules, keys)


def require_valid(df: DataFrame, rules: RuleSet, keys: Sequence[str]) -> DataFrame:
    """Return ``df`` unchanged, or raise when any row is invalid."""
    invalid = invalid_rows(df, rules, keys)
    total = invalid.count()
    if total:
        raise RowsRejected(f"{total} records break the rules", invalid, total)
    return df


def batch_counts(df: DataFrame, rules: RuleSet, by: Sequence[str] = ()) -> DataFrame:
    """Number of records and of valid ones, per batch or of all."""
    ok = ranges_ok(rules, df.columns) & sums_ok(rules, df.columns)
    rows = df.select(*[quoted(c) for c in by], ok.alias("ok"))
    return rows.groupBy(*[quoted(c) for c in by]).agg(F.count(F.lit(1)).alias("records"), F.count_if("ok").alias("valid"))


# Fixed value: the message of a batch without a valid record.
NOTHING_VALID = "no valid records available for prediction"


def refused_batches(df: DataFrame, rules: RuleSet, batch: Sequence[str]) -> DataFrame:
    """Batches in which no record is valid: their key, number of records and reason."""
    counts = batch_counts(df, rules, batch).filter(F.col("valid") == 0)
    return counts.select(*[quoted(c) for c in batch], "records", F.lit(NOTHING_VALID).alias("reason"))


def require_scorable(df: DataFrame, rules: RuleSet, keys: Sequence[str]) -> None:
    """Raise for an empty batch, or for one in which no row is valid."""
    found = batch_counts(df, rules).first()
    if found["records"] == 0:
        raise EmptyBatch("the batch holds no record")
    if found["valid"] == 0:
        raise RowsRejected(NOTHING_VALID, invalid_rows(df, rules, keys), found["records"])
