"""Explicit raw schemas, so that no reader infers types.

Fixed values: the raw column names, including the two misspelled ``lenght`` columns of
the product table, which staging renames.
"""

from __future__ import annotations

RAW_SCHEMAS = {
    "orders": """
        order_id string, customer_id string, order_status string,
        order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,
        order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz,
        order_estimated_delivery_date timestamp_ntz
    """,
    "order_items": """
        order_id string, order_item_id int, product_id string, seller_id string,
        shipping_limit_date timestamp_ntz, price decimal(12,2), freight_value decimal(12,2)
    """,
    "order_payments": """
        order_id string, payment_sequential int, payment_type string,
        payment_installments int, payment_value decimal(12,2)
    """,
    "order_reviews": """
        review_id string, order_id string, review_score int, review_comment_title string,
        review_comment_message string, review_creation_date timestamp_ntz,
        review_answer_timestamp timestamp_ntz
    """,
    "customers": """
        customer_id string, customer_unique_id string, customer_zip_code_prefix string,
        customer_city string, customer_state string
    """,
    "sellers": """
        seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string
    """,
    "products": """
        product_id string, product_category_name string, product_name_lenght int,
        product_description_lenght int, product_photos_qty int, product_weight_g int,
        product_length_cm int, product_height_cm int, product_width_cm int
    """,
    "translations": "product_category_name string, product_category_name_english string",
}
