"""Lookups in small constant tables."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Relative order volume per calendar month.
MONTH_WEIGHTS: dict[int, float] = {
    1: 1.4,
    2: 0.8,
    3: 0.9,
    4: 0.9,
    5: 1.0,
    6: 1.0,
    7: 1.1,
    8: 1.1,
    9: 1.0,
    10: 1.2,
    11: 1.5,
    12: 2.0,
}


def lookup_constant(key: Column, table: Mapping, default: float | None = None) -> Column:
    """Value of ``key`` in a constant table held in the plan; ``default`` when absent."""
    literals = F.create_map(*(F.lit(x) for x in chain.from_iterable(table.items())))
    value = F.try_element_at(literals, key)
    return value if default is None else F.coalesce(value, F.lit(default))
