"""Parameters of the marts. Everything a business user may tune lives here."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from typing import NamedTuple


class Tier(NamedTuple):
    min_value: float
    label: str


# Default seller tiers by gross merchandise value, highest first.
SELLER_TIERS = (
    Tier(50000, "platinum"),
    Tier(10000, "gold"),
    Tier(1000, "silver"),
    Tier(0, "bronze"),
)

# Label of a value that reaches no tier.
UNCLASSIFIED = "unclassified"

# The accepted order statuses.
ORDER_STATUSES = (
    "created", "approved", "invoiced", "processing",
    "shipped", "delivered", "unavailable", "canceled",
)

# The accepted review scores.
REVIEW_SCORES = (1, 2, 3, 4, 5)

# The accepted customer segments.
CUSTOMER_SEGMENTS = ("champion", "loyal", "at_risk", "new", "one_and_done")

# Statuses left out of reported revenue.
NOT_REPORTED_STATUSES = ("canceled", "unavailable")

# English label of a product without a translated category.
UNCATEGORIZED = "uncategorized"

# Calendar of the customer activity grid, end exclusive.
CALENDAR_START = date(2016, 9, 1)
CALENDAR_END = date(2018, 11, 1)


@dataclass(frozen=True)
class SegmentRules:
    """Frequency and recency limits of the customer segments."""

    champion_orders: int = 3
    repeat_orders: int = 2
    recent_days: int = 90
    loyal_days: int = 180


@dataclass(frozen=True)
class MartConfig:
    """Run parameters. ``as_of`` is the run date; ``None`` means the current date."""

    as_of: date | None = None
    seller_tiers: tuple[Tier, ...] = SELLER_TIERS
    segments: SegmentRules = field(default_factory=SegmentRules)
    freight_flag: float = 0.30
