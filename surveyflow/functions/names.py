"""Column names fit for a relational database."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence

#: What a name keeps: runs of letters, digits and underscores.
RUNS = re.compile(r"[A-Za-z0-9_]+")


def clean_name(name: str) -> str:
    """The name's runs in lower case, tied by underscores, without any at the ends."""
    return "_".join(RUNS.findall(name)).lower().strip("_")


def unique_names(names: Sequence[str]) -> list[str]:
    """Cleaned names; an empty one is ``column``, repeats get ``_2``, ``_3`` and so on."""
    following: dict[str, int] = defaultdict(lambda: 2)  # number to try next, for each name met before
    given: dict[str, None] = {}
    for name in names:
        wanted = offered = clean_name(name) or "column"
        while offered in given:
            offered = f"{wanted}_{following[wanted]}"
            following[wanted] += 1
        given[offered] = None
    return list(given)
