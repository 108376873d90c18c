"""Core marts: product dimension, item fact, order revenue, seller performance."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from bazaarline.config import SELLER_TIERS, UNCATEGORIZED, Tier
from bazaarline.functions import (
    classify_tier,
    days_between,
    exact_mean,
    hashed_key,
    safe_divide,
    surrogate_key,
)
from bazaarline.operators.deltas import TotalSpec

DELIVERED = "delivered"


def is_delivered() -> Column:
    return F.col("order_status") == DELIVERED


def is_on_time() -> Column:
    """Null unless delivered and both dates are known; arriving on the day counts."""
    return F.when(is_delivered(), F.col("delivered_at") <= F.col("estimated_delivery_at"))


def days_to_deliver() -> Column:
    return F.when(is_delivered(), days_between(F.col("ordered_at"), F.col("delivered_at")))


def product_volume() -> Column:
    """Null if any side is null. Wide, as the product of three sides can leave the 32-bit range."""
    return F.col("product_length_cm").cast("bigint") * F.col("product_height_cm") * F.col("product_width_cm")


def dim_products(products: DataFrame, translations: DataFrame) -> DataFrame:
    """One row per product; a null or unknown category becomes ``uncategorized``.

    The translation is left to the optimizer's size check: a seed is broadcast, a large
    translation table is not.
    """
    known = F.col("product_category_name") == F.col("product_category_name_pt")
    return products.join(translations, known, "left").select(
        "product_id",
        "product_category_name",
        F.coalesce("product_category_name_en", F.lit(UNCATEGORIZED)).alias("product_category_name_en"),
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        product_volume().alias("product_volume_cm3"),
        "product_photos_qty",
        "product_name_length",
        "product_description_length",
    )


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(hashed_key(F.col("seller_id")).alias("seller_sk"), "*")


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select(hashed_key(F.col("customer_id")).alias("customer_sk"), "*")


def fct_order_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order line whose order exists.

    A single sort-merge join on the order: a hot order is split by the adaptive skew join,
    because nothing after the join needs its partitioning.
    """
    return items.join(orders, "order_id").select(
        surrogate_key(F.col("order_id"), F.col("order_item_id")).alias("order_item_sk"),
        "order_id",
        "order_item_id",
        "seller_id",
        "product_id",
        "customer_id",
        "order_status",
        "ordered_at",
        "approved_at",
        "shipped_at",
        "delivered_at",
        "estimated_delivery_at",
        "item_price",
        "freight_value",
        is_delivered().alias("is_delivered"),
        is_on_time().alias("is_on_time"),
        days_to_deliver().alias("days_to_deliver"),
    )


def fct_by_order(order_lines: DataFrame, orders: DataFrame) -> DataFrame:
    """The item fact summed to one row per order; ``lines`` says how many rows it stands for.

    For measures over whole orders when the fact is not stored: lines are summed before
    they meet the orders, so a hot order joins as one row and the join needs no exchange
    beyond that of the sums.
    """
    return order_lines.join(orders, "order_id").select(
        "order_id",
        "customer_id",
        "order_status",
        "ordered_at",
        "lines",
        "item_price",
        "freight_value",
        is_delivered().alias("is_delivered"),
        is_on_time().alias("is_on_time"),
        days_to_deliver().alias("days_to_deliver"),
    )


def fct_order_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per payment whose order exists."""
    return payments.join(orders.select("order_id", "customer_id", "ordered_at"), "order_id").select(
        surrogate_key(F.col("order_id"), F.col("payment_sequential")).alias("payment_sk"),
        "order_id",
        "payment_sequential",
        "customer_id",
        "ordered_at",
        "payment_type",
        "payment_installments",
        "payment_value",
    )


def fct_order_reviews(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per review whose order exists."""
    return reviews.join(orders.select("order_id", "customer_id", "ordered_at"), "order_id").select(
        "review_id",
        "order_id",
        "customer_id",
        "ordered_at",
        "review_score",
        "reviewed_at",
        "review_answered_at",
    )


def order_revenue(summary: DataFrame) -> DataFrame:
    """One row per order; orders without items or payments count 0."""

    def or_zero(name: str) -> Column:
        return F.coalesce(name, F.lit(0))

    revenue = or_zero("total_item_revenue")
    freight = or_zero("total_freight")
    payment = or_zero("total_payment")
    return summary.select(
        "order_id",
        "customer_id",
        "order_status",
        F.col("ordered_at").alias("order_purchase_at"),
        F.col("delivered_at").alias("order_delivered_at"),
        or_zero("total_items").alias("total_items"),
        revenue.alias("total_item_revenue"),
        freight.alias("total_freight"),
        payment.alias("total_payment"),
        "payment_types",
        "payment_installments_max",
        (payment - (revenue + freight)).alias("revenue_freight_delta"),
    )


def seller_order_detail(seller_orders: DataFrame, summary: DataFrame) -> DataFrame:
    """One row per seller and order with the order's dates and review roll-up.

    ``detail_rows`` is how many rows a join with the single reviews would give, so that a
    consumer can weigh by it; the pairs of sellers and reviews are never built.
    """
    return seller_orders.join(summary, "order_id").select(
        "seller_id",
        "order_id",
        "items_in_order",
        "order_revenue",
        "order_freight",
        "order_status",
        "ordered_at",
        "delivered_at",
        "estimated_delivery_at",
        F.greatest(F.coalesce("review_rows", F.lit(0)), F.lit(1)).alias("detail_rows"),
        F.coalesce("scored_reviews", F.lit(0)).alias("scored_reviews"),
        "review_score_sum",
        "avg_review_score",
    )


def seller_performance(
    detail: DataFrame,
    sellers: DataFrame,
    tiers: Iterable[Tier] = SELLER_TIERS,
    reviews: str = "as_is",
) -> DataFrame:
    """One row per seller with at least one order.

    ``reviews="as_is"`` counts an order once per review of it, as the mart is defined, so
    orders with two reviews count twice. ``reviews="per_order"`` counts every order once,
    with its mean score; its totals reconcile with the item fact.
    """
    if reviews == "as_is":
        weight = F.col("detail_rows")
        score_sum, score_count = F.sum("review_score_sum"), F.sum("scored_reviews")
    elif reviews == "per_order":
        weight = F.lit(1).cast("bigint")
        score_sum, score_count = F.sum("avg_review_score"), F.count("avg_review_score")
    else:
        raise ValueError(f"reviews must be 'as_is' or 'per_order', not {reviews!r}")

    def weighted(name: str) -> Column:
        return F.sum(F.col(name) * weight.cast("decimal(10,0)"))

    def weight_where(condition: Column) -> Column:
        return F.sum(F.when(condition, weight).otherwise(0))

    days = days_to_deliver()
    totals = detail.groupBy("seller_id").agg(
        F.sum(weight).alias("total_orders"),
        weight_where(is_delivered()).alias("total_delivered_orders"),
        F.sum(F.col("items_in_order") * weight).alias("total_items_sold"),
        weighted("order_revenue").alias("total_gmv"),
        weighted("order_freight").alias("total_freight_charged"),
        exact_mean(score_sum, score_count).alias("__score"),
        weight_where(is_on_time()).alias("on_time_orders"),
        exact_mean(F.sum(days * weight), weight_where(days.isNotNull())).alias("__days"),
        F.min("ordered_at").alias("first_sale_at"),
        F.max("ordered_at").alias("last_sale_at"),
    )
    return seller_report(totals, sellers, tiers)


def seller_report(totals: DataFrame, sellers: DataFrame, tiers: Iterable[Tier] = SELLER_TIERS) -> DataFrame:
    """The mart's rows from the totals of sellers."""
    on_time_rate = safe_divide(F.col("on_time_orders"), F.col("total_delivered_orders"))
    return sellers.join(totals, "seller_id").select(
        "seller_id",
        "seller_city",
        "seller_state",
        "total_orders",
        "total_delivered_orders",
        "total_items_sold",
        "total_gmv",
        "total_freight_charged",
        F.round("__score", 2).alias("avg_review_score"),
        "on_time_orders",
        F.round(on_time_rate, 4).alias("on_time_delivery_rate"),
        F.round("__days", 1).alias("avg_days_to_deliver"),
        "first_sale_at",
        "last_sale_at",
        classify_tier(F.col("total_gmv"), tiers).alias("seller_tier"),
    )


# A seller's totals kept up by changed orders: what an order gives a seller, and how it adds up.
SELLER_TOTALS = TotalSpec(
    part="order_id",
    group="seller_id",
    sums=("orders", "delivered", "items", "gmv", "freight", "score_sum", "scored", "on_time", "days", "timed"),
    least=("first_sale_at",),
    greatest=("last_sale_at",),
)


def seller_contributions(detail: DataFrame) -> DataFrame:
    """What each order adds to the totals of its sellers, an order once per review of it."""
    weight = F.col("detail_rows")
    money = weight.cast("decimal(10,0)")

    def where(condition: Column) -> Column:
        return F.when(condition, weight).otherwise(0)

    return detail.select(
        "order_id",
        "seller_id",
        weight.alias("orders"),
        where(is_delivered()).alias("delivered"),
        (F.col("items_in_order") * weight).alias("items"),
        (F.col("order_revenue") * money).alias("gmv"),
        (F.col("order_freight") * money).alias("freight"),
        F.col("review_score_sum").alias("score_sum"),
        F.col("scored_reviews").alias("scored"),
        where(is_on_time()).alias("on_time"),
        (days_to_deliver() * weight).alias("days"),
        where(days_to_deliver().isNotNull()).alias("timed"),
        F.col("ordered_at").alias("first_sale_at"),
        F.col("ordered_at").alias("last_sale_at"),
    )


def seller_performance_from(
    totals: DataFrame, sellers: DataFrame, tiers: Iterable[Tier] = SELLER_TIERS
) -> DataFrame:
    """The mart from totals kept up by :mod:`bazaarline.operators.deltas`."""
    named = totals.select(
        "seller_id",
        F.col("orders").alias("total_orders"),
        F.col("delivered").alias("total_delivered_orders"),
        F.col("items").alias("total_items_sold"),
        F.col("gmv").alias("total_gmv"),
        F.col("freight").alias("total_freight_charged"),
        exact_mean(F.col("score_sum"), F.col("scored")).alias("__score"),
        F.col("on_time").alias("on_time_orders"),
        exact_mean(F.col("days"), F.col("timed")).alias("__days"),
        "first_sale_at",
        "last_sale_at",
    )
    return seller_report(named, sellers, tiers)
