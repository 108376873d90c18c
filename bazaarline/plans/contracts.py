"""What must hold for every relation, as data, and the checks made from it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from bazaarline.config import CUSTOMER_SEGMENTS, ORDER_STATUSES, REVIEW_SCORES, SELLER_TIERS
from bazaarline.operators import quality as q
from bazaarline.plans.relations import Relations

TIER_LABELS = tuple(tier.label for tier in SELLER_TIERS)


@dataclass(frozen=True)
class Contract:
    """Column tests of one relation."""

    relation: str
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    accepted: dict[str, tuple] = field(default_factory=dict)

    def joined(self, other: Contract) -> Contract:
        """The tests of both, on this relation, each once."""
        return Contract(
            self.relation,
            tuple(dict.fromkeys(self.unique + other.unique)),
            tuple(dict.fromkeys(self.not_null + other.not_null)),
            {**other.accepted, **self.accepted},
        )


# The column tests, source tables first.
CONTRACTS = (
    Contract("raw_orders", ("order_id",), ("order_id",)),
    Contract("raw_order_items", (), ("order_id", "order_item_id")),
    Contract("raw_order_payments", (), ("order_id",)),
    Contract("raw_order_reviews", (), ("review_id",)),
    Contract("raw_customers", ("customer_id",), ("customer_id",)),
    Contract("raw_products", ("product_id",), ("product_id",)),
    Contract("raw_sellers", ("seller_id",), ("seller_id",)),
    Contract(
        "stg_orders", ("order_id",), ("order_id", "customer_id"), {"order_status": ORDER_STATUSES}
    ),
    Contract("stg_order_items", (), ("order_id",)),
    Contract("stg_order_payments", (), ("order_id",)),
    Contract("stg_customers", ("customer_id",), ("customer_id", "customer_unique_id")),
    Contract("stg_order_reviews", ("review_id",), ("review_id",), {"review_score": REVIEW_SCORES}),
    Contract("stg_sellers", ("seller_id",), ("seller_id",)),
    Contract("stg_products", ("product_id",), ("product_id",)),
    Contract("stg_translations", ("product_category_name_pt",), ("product_category_name_pt",)),
    Contract("order_revenue", ("order_id",), ("order_id", "order_status")),
    Contract("dim_products", ("product_id",), ("product_id", "product_category_name_en")),
    Contract(
        "fct_order_items",
        ("order_item_sk",),
        ("order_item_sk", "order_id", "item_price", "is_delivered"),
    ),
    Contract(
        "seller_performance",
        ("seller_id",),
        ("seller_id", "total_gmv", "seller_tier"),
        {"seller_tier": TIER_LABELS},
    ),
    Contract(
        "customer_segmentation",
        ("customer_unique_id",),
        ("customer_unique_id", "is_repeat_buyer"),
        {"customer_segment": CUSTOMER_SEGMENTS},
    ),
)

CONTRACT_OF = {contract.relation: contract for contract in CONTRACTS}


def relation(relations: Relations, name: str) -> DataFrame:
    if name.startswith("raw_"):
        return getattr(relations.raw, name.removeprefix("raw_"))
    return getattr(relations, name)


# Views over a single raw table that keep its rows, so the raw table's tests run on the view
# together with its own, in one pass. Reviews are not among them: staging drops repeats.
ROW_WISE = {
    "stg_orders": "raw_orders",
    "stg_order_items": "raw_order_items",
    "stg_order_payments": "raw_order_payments",
    "stg_customers": "raw_customers",
    "stg_sellers": "raw_sellers",
    "stg_products": "raw_products",
}


def _with_raw(contract: Contract) -> Contract | None:
    """The contract of the raw table that a view keeps the rows of."""
    return CONTRACT_OF.get(ROW_WISE.get(contract.relation, ""))


def _alone() -> list[Contract]:
    return [c for c in CONTRACTS if c.relation not in ROW_WISE.values()]


def unique_checks(relations: Relations) -> DataFrame:
    """One grouping per key; a raw table and the view with its rows share it."""
    checks = []
    for contract in _alone():
        raw = _with_raw(contract)
        columns = dict.fromkeys((*contract.unique, *(raw.unique if raw else ())))
        for column in columns:
            names = [c.relation for c in (contract, raw) if c and column in c.unique]
            checks.append(q.check_unique(relation(relations, contract.relation), names[0], column, names[1:]))
    return q.all_of(checks)


def not_null_checks(relations: Relations) -> DataFrame:
    """One pass per relation; a raw table is tested in that of the view with its rows."""
    checks = []
    for contract in _alone():
        raw = _with_raw(contract)
        rules = [q.not_null(name) for name in contract.not_null]
        rules += [q.not_null(name).of(raw.relation) for name in (raw.not_null if raw else ())]
        if rules:
            checks.append(q.check_rows(relation(relations, contract.relation), contract.relation, rules))
    return q.all_of(checks)


def accepted_values_checks(relations: Relations) -> DataFrame:
    return q.all_of(
        q.check_rows(relation(relations, c.relation), c.relation, [q.accepted_values(name, values)])
        for c in CONTRACTS
        for name, values in c.accepted.items()
    )


def contract_checks(df: DataFrame, contract: Contract) -> DataFrame:
    """All column tests of one relation: one pass for the row rules, one per unique key."""
    rules = [q.not_null(name) for name in contract.not_null]
    rules += [q.accepted_values(name, values) for name, values in contract.accepted.items()]
    checks = [q.check_unique(df, contract.relation, name) for name in contract.unique]
    if rules:
        checks.insert(0, q.check_rows(df, contract.relation, rules))
    return q.all_of(checks)


# Acceptance criteria of the marts


@dataclass(frozen=True)
class Fact:
    """The item fact for a check: as it is, or rolled up with its number of rows.

    Checks over columns of the order alone may take the fact summed by order, which spares
    a lazily joined fact the shuffle of single lines.
    """

    df: DataFrame
    rows: str | None = None

    @property
    def row_count(self) -> Column:
        return F.coalesce(F.sum(self.rows), F.lit(0)) if self.rows else F.count(F.lit(1))


def _fact(relations: Relations, fact: Fact | None) -> Fact:
    return fact or Fact(relations.fct_order_items)


def range_rules(name: str) -> list[q.RowRule]:
    col = F.col
    return {
        "fct_order_items": [
            q.holds("at_least_0", "days_to_deliver", col("days_to_deliver") >= 0),
        ],
        "order_revenue": [
            q.holds("at_least_0", "total_item_revenue", col("total_item_revenue") >= 0),
        ],
        "dim_products": [
            q.holds("above_0", "product_volume_cm3", col("product_volume_cm3") > 0),
        ],
        "seller_performance": [
            q.holds("at_least_0", "total_gmv", col("total_gmv") >= 0),
            q.holds("from_0_to_1", "on_time_delivery_rate", col("on_time_delivery_rate").between(0, 1)),
        ],
        "customer_segmentation": [
            q.holds("at_least_1", "lifetime_orders", col("lifetime_orders") >= 1),
            q.holds("above_0", "lifetime_gmv", col("lifetime_gmv") > 0),
        ],
    }[name]


def nullness_rules(name: str) -> list[q.RowRule]:
    col = F.col
    sides = ("product_length_cm", "product_height_cm", "product_width_cm")
    any_side_null = col(sides[0]).isNull() | col(sides[1]).isNull() | col(sides[2]).isNull()
    return {
        "fct_order_items": [
            q.null_where("is_on_time", ~col("is_delivered"), "null_unless_delivered"),
            q.null_where("days_to_deliver", ~col("is_delivered"), "null_unless_delivered"),
        ],
        "dim_products": [
            q.null_only_where("product_volume_cm3", any_side_null, "null_iff_a_side_is_null"),
            q.not_null("product_category_name_en"),
        ],
        "seller_performance": [
            q.not_null("seller_tier"),
            q.null_only_where(
                "on_time_delivery_rate", col("total_delivered_orders") == 0, "null_iff_none_delivered"
            ),
        ],
        "customer_segmentation": [
            q.holds(
                "iff_above_1", "is_repeat_buyer", col("is_repeat_buyer") == (col("lifetime_orders") > 1)
            ),
        ],
    }[name]


RANGED = ("fct_order_items", "order_revenue", "dim_products", "seller_performance", "customer_segmentation")
NULLNESS = ("fct_order_items", "dim_products", "seller_performance", "customer_segmentation")


def range_checks(relations: Relations, fact: Fact | None = None) -> DataFrame:
    return _rule_checks(relations, RANGED, range_rules, fact)


def nullness_checks(relations: Relations, fact: Fact | None = None) -> DataFrame:
    return _rule_checks(relations, NULLNESS, nullness_rules, fact)


def _rule_checks(
    relations: Relations,
    names: tuple[str, ...],
    rules: Callable[[str], list[q.RowRule]],
    fact: Fact | None,
) -> DataFrame:
    lines = _fact(relations, fact)
    checks = []
    for name in names:
        checked = lines if name == "fct_order_items" else Fact(relation(relations, name))
        checks.append(q.check_rows(checked.df, name, rules(name), checked.rows))
    return q.all_of(checks)


def orphan_checks(
    relations: Relations, fact: Fact | None = None, history: DataFrame | None = None
) -> DataFrame:
    """``fact`` may be rolled up to any keys that keep order and product."""
    r = relations
    lines = _fact(relations, fact)
    of_orders = [
        q.Child("stg_order_items", r.stg_order_items, "order_id"),
        q.Child("stg_order_payments", r.stg_order_payments, "order_id"),
        q.Child("stg_order_reviews", r.stg_order_reviews, "order_id"),
        q.Child("fct_order_items", lines.df, "order_id", lines.rows),
    ]
    checks = [
        q.check_children(of_orders, r.stg_orders, "order_id"),
        q.check_orphans(r.stg_orders, r.stg_customers, "stg_orders", "customer_id"),
        q.check_orphans(lines.df, r.dim_products, "fct_order_items", "product_id", lines.rows),
    ]
    if history is not None:
        # Every order of the source has a version.
        checks.append(q.check_orphans(r.raw.orders, history, "raw_orders", "order_id"))
    return q.all_of(checks)


def row_count_checks(
    relations: Relations, history: DataFrame | None = None, fact: Fact | None = None
) -> DataFrame:
    r = relations
    rows = F.count(F.lit(1))
    lines = _fact(relations, fact)
    delivered_people = (
        r.stg_orders.where(F.col("order_status") == "delivered")
        .select("customer_id")
        .join(r.stg_customers, "customer_id")
    )

    def distinct(column: str) -> dict[str, Column]:
        return {column: F.countDistinct(column)}

    measured = {
        "fct_order_items": (lines.df, {"rows": lines.row_count}),
        "raw_order_items": (r.raw.order_items, {"rows": rows, **distinct("seller_id")}),
        "order_revenue": (r.order_revenue, {"rows": rows}),
        "raw_orders": (r.raw.orders, distinct("order_id")),
        "dim_products": (r.dim_products, {"rows": rows}),
        "raw_products": (r.raw.products, distinct("product_id")),
        "seller_performance": (r.seller_performance, {"rows": rows}),
        "customer_segmentation": (r.customer_segmentation, {"rows": rows}),
        "delivered_people": (delivered_people, distinct("customer_unique_id")),
    }
    pairs = [
        ("fct_order_items", ("raw_order_items", "rows")),
        ("order_revenue", ("raw_orders", "order_id")),
        ("dim_products", ("raw_products", "product_id")),
        ("seller_performance", ("raw_order_items", "seller_id")),
        ("customer_segmentation", ("delivered_people", "customer_unique_id")),
    ]
    rules = [q.Equal(name, "row_count", (name, "rows"), expected) for name, expected in pairs]
    if history is not None:
        measured["status_history"] = (history, {"rows": rows})
        rules.append(
            q.Equal("status_history", "row_count", ("status_history", "rows"), ("raw_orders", "order_id"), True)
        )
    return q.check_measures(measured, rules)


def reconciliation_checks(relations: Relations) -> DataFrame:
    r = relations
    measured = {
        "fct_order_items": (
            r.fct_order_items,
            {"revenue": F.sum("item_price"), "freight": F.sum("freight_value")},
        ),
        "order_revenue": (
            r.order_revenue,
            {
                "revenue": F.sum("total_item_revenue"),
                "freight": F.sum("total_freight"),
                "payments": F.sum("total_payment"),
            },
        ),
        "raw_order_payments": (
            r.raw.order_payments,
            {"payments": F.sum(F.col("payment_value").cast("decimal(12,2)"))},
        ),
        "seller_performance": (r.seller_performance, {"gmv": F.sum("total_gmv")}),
        "seller_performance_reconciled": (r.sellers_by("per_order"), {"gmv": F.sum("total_gmv")}),
    }
    revenue = ("order_revenue", "revenue")
    return q.check_measures(
        measured,
        [
            q.Equal("fct_order_items", "revenue", ("fct_order_items", "revenue"), revenue),
            q.Equal("fct_order_items", "freight", ("fct_order_items", "freight"), ("order_revenue", "freight")),
            q.Equal("order_revenue", "payments", ("order_revenue", "payments"), ("raw_order_payments", "payments")),
            q.Equal("seller_performance", "gmv", ("seller_performance", "gmv"), revenue),
            q.Equal(
                "seller_performance_reconciled", "gmv", ("seller_performance_reconciled", "gmv"), revenue
            ),
        ],
    )


def history_checks(history: DataFrame, name: str = "status_history") -> DataFrame:
    """Versions have an accepted status, in any case of its letters, as the source has it."""
    status = F.lower("order_status")
    return q.check_rows(
        history, name, [q.RowRule("accepted_values", "order_status", ~status.isin(list(ORDER_STATUSES)))]
    )


def freshness_checks(relations: Relations, now: datetime) -> DataFrame:
    """Newest rows of the marts against their limits."""
    r = relations
    return q.all_of(
        [
            q.check_freshness(r.order_revenue, "order_revenue", "order_purchase_at", now, 36),
            q.check_freshness(r.seller_performance, "seller_performance", "last_sale_at", now, 36),
            q.check_freshness(r.customer_segmentation, "customer_segmentation", "last_order_at", now, 48),
        ]
    )


def share_checks(relations: Relations) -> DataFrame:
    r = relations
    delivered = r.order_revenue.where(F.col("order_status") == "delivered")
    tier = F.col("seller_tier")
    return q.all_of(
        [
            q.check_share(
                delivered, "order_revenue", "delta_is_0", F.col("revenue_freight_delta") == 0, 0.95
            ),
            q.check_share(
                r.seller_performance, "seller_performance", "platinum", tier == "platinum", 0.05, above=False
            ),
            q.check_share(r.seller_performance, "seller_performance", "bronze", tier == "bronze", 0.40),
        ]
    )

