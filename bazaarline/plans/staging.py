"""Typed, renamed raw tables. No joins, no business rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bazaarline.functions import to_money, to_timestamp_ntz, to_whole
from bazaarline.operators.latest import latest_per_key


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "customer_id",
        F.lower("order_status").alias("order_status"),
        to_timestamp_ntz(F.col("order_purchase_timestamp")).alias("ordered_at"),
        to_timestamp_ntz(F.col("order_approved_at")).alias("approved_at"),
        to_timestamp_ntz(F.col("order_delivered_carrier_date")).alias("shipped_at"),
        to_timestamp_ntz(F.col("order_delivered_customer_date")).alias("delivered_at"),
        to_timestamp_ntz(F.col("order_estimated_delivery_date")).alias("estimated_delivery_at"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        to_timestamp_ntz(F.col("shipping_limit_date")).alias("shipping_limit_at"),
        to_money(F.col("price")).alias("item_price"),
        to_money(F.col("freight_value")).alias("freight_value"),
    )


def stg_order_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "payment_sequential",
        F.lower("payment_type").alias("payment_type"),
        "payment_installments",
        to_money(F.col("payment_value")).alias("payment_value"),
    )


def stg_order_reviews(raw: DataFrame) -> DataFrame:
    """One row per review: the one answered last.

    Ties go to the later creation, then the larger order and score. The texts stay out of
    the tiebreak, so plans that do not output them do not read or shuffle them.
    """
    typed = raw.select(
        "review_id",
        "order_id",
        to_whole(F.col("review_score")).alias("review_score"),
        "review_comment_title",
        "review_comment_message",
        to_timestamp_ntz(F.col("review_creation_date")).alias("reviewed_at"),
        to_timestamp_ntz(F.col("review_answer_timestamp")).alias("review_answered_at"),
    )
    return latest_per_key(
        typed,
        keys=["review_id"],
        order_by="review_answered_at",
        tiebreak=["reviewed_at", "order_id", "review_score"],
    )


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        F.lower("customer_city").alias("customer_city"),
        F.upper("customer_state").alias("customer_state"),
    )


def stg_sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "seller_id",
        "seller_zip_code_prefix",
        F.lower("seller_city").alias("seller_city"),
        F.upper("seller_state").alias("seller_state"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        "product_id",
        "product_category_name",
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def stg_translations(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(
        {
            "product_category_name": "product_category_name_pt",
            "product_category_name_english": "product_category_name_en",
        }
    )


def order_versions(raw: DataFrame) -> DataFrame:
    """Input of the status history: raw orders renamed, the status as the source spells it."""
    return raw.select(
        "order_id",
        "customer_id",
        "order_status",
        F.col("order_purchase_timestamp").alias("ordered_at"),
        F.col("order_approved_at").alias("approved_at"),
        F.col("order_delivered_carrier_date").alias("shipped_at"),
        F.col("order_delivered_customer_date").alias("delivered_at"),
        F.col("order_estimated_delivery_date").alias("estimated_delivery_at"),
    )
