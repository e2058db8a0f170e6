"""Cell cleaning: every function maps one Column to one Column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """A column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def binary_code(cell: Column, mapping: dict[str, int]) -> Column:
    """Code a two-valued text; codes already present keep their value, the rest is NULL."""
    text = F.lower(F.trim(cell.cast("string")))
    spellings: dict[int, list[str]] = {}
    for name, code in mapping.items():
        spellings.setdefault(code, [str(code), f"{code}.0"]).append(name)
    coded = F.lit(None).cast("int")
    for code, names in spellings.items():
        coded = F.when(text.isin(names), F.lit(code)).otherwise(coded)
    return coded


def token_to_null(cell: Column, kind: T.DataType, tokens: Sequence[str], trim: bool = False) -> Column:
    """Missing tokens become NULL; NaN becomes NULL in floating columns; other types pass."""
    if isinstance(kind, T.StringType):
        text = F.trim(cell) if trim else cell
        return F.when(~text.isin(list(tokens)), text)
    if isinstance(kind, (T.DoubleType, T.FloatType)) and not trim:
        return F.nanvl(cell, F.lit(None).cast(kind))
    return cell


#: Digits with a point and an exponent: no type suffixes, and no words such as Infinity.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(cell: Column, numeric_type: str = "double") -> Column:
    """Text to number; what does not parse, or is too large for a finite number, is NULL.

    One or two digits, as most ratings are, need no pattern. For other cells it is tested once per cell; the operand named
    twice is the cheap cast.
    """
    value = cell.try_cast(numeric_type)
    finite = F.abs(value.cast("double")) < F.lit(float("inf"))
    digits = (F.octet_length(cell) <= 2) & cell.between("0", ":") & F.substring(cell, -1, 1).between("0", "9")
    whole = F.when(digits, cell.try_cast("bigint").try_cast(numeric_type))
    return F.coalesce(whole, F.when(cell.rlike(NUMBER) & finite, value))


def table_name(text: Column) -> Column:
    """A file or folder name as a relational table name."""
    return F.lower(F.regexp_replace(F.regexp_replace(text, "[^a-zA-Z0-9_]+", "_"), "^_+|_+$", ""))
