"""Array helpers for link lists: head element and de-duplicated tail."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def head(arr: Column) -> Column:
    """First element (null for an empty array)."""
    return F.get(arr, 0)


def tail_distinct(arr: Column) -> Column:
    """Elements after the first, duplicates removed, sorted for a stable
    order (a set has none)."""
    rest = F.slice(arr, 2, F.greatest(F.size(arr) - 1, F.lit(0)))
    return F.array_sort(F.array_distinct(rest))
