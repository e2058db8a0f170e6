"""Declarative data rules: value ranges, sum-to-total groups and missing tokens."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Text spellings that stand for a missing value.
MISSING_TOKENS = ("", "NA", "NaN", "nan", "None", "NULL", "null", "?")
# The spellings the relational loader recognises (after trimming).
LOADER_TOKENS = ("", "NA", "NaN", "nan", "NULL", "null", "?")

# The survey's columns in order with their lowest and highest
# legal value (spellings are those of the data set).
SURVEY_RANGES = (
    ("age", 18, 55),
    ("wave", 1, 21),
    ("gender", 0, 1),
    ("age_o", 18, 55),
    ("d_age", 0, 37),
    ("samerace", 0, 1),
    ("importance_same_race", 0, 10),
    ("importance_same_religion", 0, 10),
    ("pref_o_attractive", 0, 100),
    ("pref_o_sincere", 0, 100),
    ("pref_o_intelligence", 0, 100),
    ("pref_o_funny", 0, 100),
    ("pref_o_ambitious", 0, 100),
    ("pref_o_shared_interests", 0, 100),
    ("attractive_o", 0, 10),
    ("sinsere_o", 0, 10),
    ("intelligence_o", 0, 10),
    ("funny_o", 0, 10),
    ("ambitous_o", 0, 10),
    ("shared_interests_o", 0, 10),
    ("attractive_important", 0, 100),
    ("sincere_important", 0, 100),
    ("intellicence_important", 0, 100),
    ("funny_important", 0, 100),
    ("ambtition_important", 0, 100),
    ("shared_interests_important", 0, 100),
    ("attractive", 0, 10),
    ("sincere", 0, 10),
    ("intelligence", 0, 10),
    ("funny", 0, 10),
    ("ambition", 0, 10),
    ("attractive_partner", 0, 10),
    ("sincere_partner", 0, 10),
    ("intelligence_partner", 0, 10),
    ("funny_partner", 0, 10),
    ("ambition_partner", 0, 10),
    ("shared_interests_partner", 0, 10),
    ("sports", 0, 10),
    ("tvsports", 0, 10),
    ("exercise", 0, 10),
    ("dining", 0, 10),
    ("museums", 0, 10),
    ("art", 0, 10),
    ("hiking", 0, 10),
    ("gaming", 0, 10),
    ("clubbing", 0, 10),
    ("reading", 0, 10),
    ("tv", 0, 10),
    ("theater", 0, 10),
    ("movies", 0, 10),
    ("concerts", 0, 10),
    ("music", 0, 10),
    ("shopping", 0, 10),
    ("yoga", 0, 10),
    ("interests_correlate", -1, 1),
    ("expected_happy_with_sd_people", 0, 10),
    ("expected_num_matches", 0, 20),
    ("like", 0, 10),
    ("guess_prob_liked", 0, 10),
    ("met", 0, 1),
    ("match", 0, 1),
)

# The two groups of percentages that have to add up to 100.
PREFERENCE_COLUMNS = (
    "pref_o_attractive",
    "pref_o_sincere",
    "pref_o_intelligence",
    "pref_o_funny",
    "pref_o_ambitious",
    "pref_o_shared_interests",
)
IMPORTANCE_COLUMNS = (
    "attractive_important",
    "sincere_important",
    "intellicence_important",
    "funny_important",
    "ambtition_important",
    "shared_interests_important",
)


@dataclass(frozen=True)
class RangeRule:
    """``low <= column <= high``; a missing value always passes."""

    column: str
    low: float
    high: float

    @property
    def message(self) -> str:
        return f"{self.column} must be between {self.low} and {self.high}"


@dataclass(frozen=True)
class SumRule:
    """The columns add up to ``total`` within ``tolerance``."""

    label: str
    columns: tuple[str, ...]
    total: float = 100
    tolerance: float = 0.01

    @property
    def message(self) -> str:
        return f"{self.label} must sum to {self.total:g}"


@dataclass(frozen=True)
class RuleSet:
    """Everything the cleaning and validation operators need to know about a table."""

    ranges: tuple[RangeRule, ...] = ()
    sums: tuple[SumRule, ...] = ()
    binary: dict[str, dict[str, int]] = field(default_factory=dict)
    tokens: tuple[str, ...] = MISSING_TOKENS
    sparse_columns: tuple[str, ...] = ()
    label: str = "match"

    @property
    def columns(self) -> list[str]:
        return [rule.column for rule in self.ranges]

    def ranges_for(self, columns: list[str]) -> list[RangeRule]:
        """Range rules whose column is present."""
        return [rule for rule in self.ranges if rule.column in columns]

    def sums_for(self, columns: list[str]) -> list[SumRule]:
        """Sum rules whose columns are all present."""
        return [rule for rule in self.sums if set(rule.columns) <= set(columns)]

    def with_tolerance(self, tolerance: float) -> RuleSet:
        return replace(self, sums=tuple(replace(rule, tolerance=tolerance) for rule in self.sums))


SURVEY_RULES = RuleSet(
    ranges=tuple(RangeRule(*row) for row in SURVEY_RANGES),
    sums=(
        SumRule("preference percentages", PREFERENCE_COLUMNS),
        SumRule("importance percentages", IMPORTANCE_COLUMNS),
    ),
    binary={"gender": {"male": 1, "female": 0}},
    sparse_columns=("expected_num_interested_in_me",),
)
