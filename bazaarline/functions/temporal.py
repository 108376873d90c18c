"""Date and time expressions. None depends on the session time zone."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F


def to_timestamp_ntz(value: Column, strict: bool = True) -> Column:
    """Timestamp without zone. ``strict=False`` turns unreadable input into null."""
    return value.cast("timestamp_ntz") if strict else value.try_cast("timestamp_ntz")


def days_between(start: Column, end: Column) -> Column:
    """Midnights passed from ``start`` to ``end`` (23:00 to 01:00 is one day)."""
    return F.datediff(end, start)


def hours_between(start: Column, end: Column) -> Column:
    """Full hours on the clock passed from ``start`` to ``end`` (10:59 to 11:01 is one hour)."""
    return days_between(start, end) * 24 + F.hour(end) - F.hour(start)


def as_of_date(as_of: date | None) -> Column:
    """The run date as a column; the current date if none is fixed."""
    return F.current_date() if as_of is None else F.lit(as_of)
