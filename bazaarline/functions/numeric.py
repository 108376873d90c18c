"""Numeric expressions with warehouse semantics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(12,2)"


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Ratio as double; null, never an error, for a zero or null denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def to_money(value: Column, strict: bool = True) -> Column:
    """Fixed-point amount with two digits. ``strict=False`` turns bad input into null."""
    return value.cast(MONEY) if strict else value.try_cast(MONEY)


def to_whole(value: Column) -> Column:
    """Integer cast that rounds fractions half away from zero instead of cutting them.

    Going through a decimal keeps text such as ``'4.6'`` castable under ANSI mode.
    """
    return F.round(value.cast("decimal(20,6)")).cast("int")


def exact_mean(total: Column, count: Column, digits: int = 6) -> Column:
    """``total / count`` as a decimal with ``digits`` digits, null for an empty group.

    ``total`` is an exact sum (integer or decimal), so the mean does not depend on how
    rows were spread over partitions, which an average of doubles would. A warehouse mean
    has six digits for whole numbers and six more than its input, at most twelve, otherwise.
    """
    # These precisions leave twenty digits to the quotient before it is rounded.
    quotient = total.cast("decimal(24,6)") / F.nullif(count, F.lit(0)).cast("decimal(14,0)")
    return F.round(quotient, digits).cast(f"decimal({12 + digits},{digits})")
