"""Label expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from bazaarline.config import UNCLASSIFIED, Tier


def classify_tier(value: Column, tiers: Iterable[Tier], default: str = UNCLASSIFIED) -> Column:
    """Label of the first tier whose minimum the value reaches, in list order.

    Null and values below every minimum get ``default``.
    """
    label = F.lit(default)
    for tier in reversed(list(tiers)):
        label = F.when(value >= F.lit(tier.min_value), F.lit(tier.label)).otherwise(label)
    return label
