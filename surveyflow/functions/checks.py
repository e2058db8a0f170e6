"""Rule predicates compiled to Columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveyflow.functions.cells import quoted
from surveyflow.rules import RangeRule, RuleSet, SumRule


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True)) if conditions else F.lit(True)


def _between(rule: RangeRule) -> Column:
    return quoted(rule.column).between(rule.low, rule.high)


def in_range(rule: RangeRule) -> Column:
    """True for a missing value or one inside the range; never NULL."""
    return F.coalesce(_between(rule), F.lit(True))


def out_of_range(rule: RangeRule) -> Column:
    """True for a present value outside the range; NULL for a missing value."""
    return ~_between(rule)


def sum_ok(rule: SumRule, missing: str = "pass") -> Column:
    """``missing="pass"``: a group with a missing member passes; ``"zero"``: it counts as 0."""
    cells = [quoted(name).cast("double") for name in rule.columns]
    if missing == "zero":
        total = reduce(lambda a, b: a + b, [F.coalesce(cell, F.lit(0.0)) for cell in cells])
        return F.abs(total - rule.total) <= rule.tolerance
    total = reduce(lambda a, b: a + b, cells)
    return F.coalesce(F.abs(total - rule.total) <= rule.tolerance, F.lit(True))


def ranges_ok(rules: RuleSet, columns: list[str]) -> Column:
    return all_of([in_range(rule) for rule in rules.ranges_for(columns)])


def sums_ok(rules: RuleSet, columns: list[str], missing: str = "pass") -> Column:
    return all_of([sum_ok(rule, missing) for rule in rules.sums_for(columns)])


def reasons(rules: RuleSet, columns: list[str]) -> Column:
    """All broken rules of a row as texts, in rule order; empty when the row is valid."""
    found = [F.when(out_of_range(rule), F.lit(rule.message)) for rule in rules.ranges_for(columns)]
    found += [F.when(~sum_ok(rule), F.lit(rule.message)) for rule in rules.sums_for(columns)]
    if not found:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*found))
