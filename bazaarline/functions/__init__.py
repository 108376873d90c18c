"""Column expressions shared by the plans."""

from bazaarline.functions.keys import hashed_key, surrogate_key
from bazaarline.functions.labels import classify_tier
from bazaarline.functions.numeric import exact_mean, safe_divide, to_money, to_whole
from bazaarline.functions.temporal import (
    as_of_date,
    days_between,
    hours_between,
    to_timestamp_ntz,
)
from bazaarline.functions.text import ordered_distinct_list

__all__ = [
    "as_of_date",
    "classify_tier",
    "days_between",
    "exact_mean",
    "hashed_key",
    "hours_between",
    "ordered_distinct_list",
    "safe_divide",
    "surrogate_key",
    "to_money",
    "to_timestamp_ntz",
    "to_whole",
]
