"""Maps from landmark to cost as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def add_to_costs(costs: Column, more: Column) -> Column:
    """Every cost of the map raised by ``more``."""
    return F.transform_values(costs, lambda _, cost: cost + more)


def cheaper_costs(left: Column, right: Column) -> Column:
    """The cheaper cost for each landmark of either map; null counts as an empty map."""
    both = F.map_zip_with(left, right, lambda _, a, b: F.least(a, b))
    return F.coalesce(both, left, right)
