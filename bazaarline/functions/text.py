"""Text aggregates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ordered_distinct_list(value: Column, separator: str = ", ") -> Column:
    """Aggregate: the distinct non-null values in order, joined; ``''`` if there are none.

    The set is built map-side first, so a group holds its distinct values only.
    """
    return F.array_join(F.array_sort(F.collect_set(value)), separator)
