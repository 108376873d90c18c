"""Aggregations to a join grain, shared by several marts.

Each is computed before any join on its key. Partial aggregation shrinks a hot key on the
map side, so the joins that follow see one row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bazaarline.functions import exact_mean, ordered_distinct_list


def order_items_agg(items: DataFrame) -> DataFrame:
    """One row per order. ``total_items`` counts distinct products, not lines."""
    return items.groupBy("order_id").agg(
        F.countDistinct("product_id").alias("total_items"),
        F.sum("item_price").alias("total_item_revenue"),
        F.sum("freight_value").alias("total_freight"),
    )


def order_lines(items: DataFrame) -> DataFrame:
    """One row per order: its lines and their amounts, under the names of a single line."""
    return _summed(items, "order_id")


def order_product_lines(items: DataFrame) -> DataFrame:
    """One row per order and product, like :func:`order_lines`."""
    return _summed(items, "order_id", "product_id")


def _summed(items: DataFrame, *keys: str) -> DataFrame:
    return items.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("item_price").alias("item_price"),
        F.sum("freight_value").alias("freight_value"),
    )


def order_payments_agg(payments: DataFrame) -> DataFrame:
    """One row per order with the payment types used, in order."""
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("total_payment"),
        ordered_distinct_list(F.col("payment_type")).alias("payment_types"),
        F.max("payment_installments").alias("payment_installments_max"),
    )


def seller_order_items(items: DataFrame) -> DataFrame:
    """One row per seller and order. ``items_in_order`` counts lines."""
    return items.groupBy("seller_id", "order_id").agg(
        F.count(F.lit(1)).alias("items_in_order"),
        F.sum("item_price").alias("order_revenue"),
        F.sum("freight_value").alias("order_freight"),
    )


def order_reviews_agg(reviews: DataFrame) -> DataFrame:
    """One row per order: how many reviews, how many scores, their sum and mean."""
    total = F.sum("review_score")
    scored = F.count("review_score")
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("review_rows"),
        scored.alias("scored_reviews"),
        total.alias("review_score_sum"),
        exact_mean(total, scored).alias("avg_review_score"),
    )


def order_summary(
    orders: DataFrame, items_agg: DataFrame, payments_agg: DataFrame, reviews_agg: DataFrame
) -> DataFrame:
    """One row per order with its item, payment and review roll-ups; null where it has none.

    The order-grain table under the marts: all joins on the order happen here, partitioned
    by the order once. Each roll-up is unique by order, so a plan that uses no column of one
    drops its join altogether.
    """
    return (
        orders.join(items_agg, "order_id", "left")
        .join(payments_agg, "order_id", "left")
        .join(reviews_agg, "order_id", "left")
    )
