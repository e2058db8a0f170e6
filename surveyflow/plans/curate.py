"""Raw survey to curated table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from surveyflow.operators.clean import bind, clean_cells, column_kinds
from surveyflow.operators.validate import complete_cases, valid_rows
from surveyflow.rules import SURVEY_RULES, RuleSet

MODES = ("dropped", "imputed")


def curate(
    df: DataFrame,
    mode: str = "imputed",
    rules: RuleSet = SURVEY_RULES,
    text_columns: Sequence[str] = (),
    numeric_type: str = "double",
    keys: Sequence[str] = (),
    number_columns: Sequence[str] = (),
) -> DataFrame:
    """Clean, then keep the rows that obey the rules.

    ``imputed`` keeps missing values for a later imputer; ``dropped`` keeps the rows whose
    numbers are all there. One narrow stage either way: no shuffle, no collect.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    cleaned = clean_cells(df, rules, text_columns, numeric_type, keys, number_columns)
    numbers, _other = column_kinds(cleaned, exclude=keys)
    kept = valid_rows(bind(cleaned, numbers), rules)
    return complete_cases(kept, numbers) if mode == "dropped" else kept
