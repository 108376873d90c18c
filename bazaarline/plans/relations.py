"""The relations and what they are made of."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property
from types import SimpleNamespace

from pyspark.sql import DataFrame

from bazaarline.config import MartConfig
from bazaarline.plans import core, marketing, rollups, staging
from bazaarline.sources.readers import RawTables
from bazaarline.sources.schemas import RAW_SCHEMAS


class Relations:
    """All relations over one set of raw tables, each a lazy plan made on first use.

    ``stored`` holds relations already written as tables; plans then read those instead of
    computing them again.
    """

    def __init__(
        self,
        raw: RawTables,
        config: MartConfig = MartConfig(),
        stored: Mapping[str, DataFrame] | None = None,
    ) -> None:
        self.raw = raw
        self.config = config
        # A cached property looks here first, so a stored relation takes its place.
        self.__dict__.update(stored or {})
        # The stored fact has the lines of known orders, typed; sellers are summed from it.
        self._lines_of_sellers = (stored or {}).get("fct_order_items")

    # Staging

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw.orders)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw.order_items)

    @cached_property
    def stg_order_payments(self) -> DataFrame:
        return staging.stg_order_payments(self.raw.order_payments)

    @cached_property
    def stg_order_reviews(self) -> DataFrame:
        return staging.stg_order_reviews(self.raw.order_reviews)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw.customers)

    @cached_property
    def stg_sellers(self) -> DataFrame:
        return staging.stg_sellers(self.raw.sellers)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw.products)

    @cached_property
    def stg_translations(self) -> DataFrame:
        return staging.stg_translations(self.raw.translations)

    # Roll-ups

    @cached_property
    def order_items_agg(self) -> DataFrame:
        return rollups.order_items_agg(self.stg_order_items)

    @cached_property
    def order_payments_agg(self) -> DataFrame:
        return rollups.order_payments_agg(self.stg_order_payments)

    @cached_property
    def order_reviews_agg(self) -> DataFrame:
        return rollups.order_reviews_agg(self.stg_order_reviews)

    @cached_property
    def seller_order_items(self) -> DataFrame:
        """From the stored fact if there is one; seller details need known orders in any case."""
        lines = self.stg_order_items if self._lines_of_sellers is None else self._lines_of_sellers
        return rollups.seller_order_items(lines)

    @cached_property
    def order_summary(self) -> DataFrame:
        return rollups.order_summary(
            self.stg_orders, self.order_items_agg, self.order_payments_agg, self.order_reviews_agg
        )

    @cached_property
    def seller_order_detail(self) -> DataFrame:
        return core.seller_order_detail(self.seller_order_items, self.order_summary)

    # Marts

    @cached_property
    def dim_products(self) -> DataFrame:
        return core.dim_products(self.stg_products, self.stg_translations)

    @cached_property
    def fct_order_items(self) -> DataFrame:
        return core.fct_order_items(self.stg_order_items, self.stg_orders)

    @cached_property
    def fct_by_order(self) -> DataFrame:
        return core.fct_by_order(rollups.order_lines(self.stg_order_items), self.stg_orders)

    @cached_property
    def fct_by_order_product(self) -> DataFrame:
        """The item fact summed to one row per order and product, with the days to deliver."""
        lines = rollups.order_product_lines(self.stg_order_items)
        orders = self.stg_orders.select("order_id", core.days_to_deliver().alias("days_to_deliver"))
        return lines.join(orders, "order_id")

    @cached_property
    def dim_sellers(self) -> DataFrame:
        return core.dim_sellers(self.stg_sellers)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return core.dim_customers(self.stg_customers)

    @cached_property
    def fct_order_payments(self) -> DataFrame:
        return core.fct_order_payments(self.stg_order_payments, self.stg_orders)

    @cached_property
    def fct_order_reviews(self) -> DataFrame:
        return core.fct_order_reviews(self.stg_order_reviews, self.stg_orders)

    @cached_property
    def order_revenue(self) -> DataFrame:
        return core.order_revenue(self.order_summary)

    @cached_property
    def seller_performance(self) -> DataFrame:
        return self.sellers_by(reviews="as_is")

    @cached_property
    def customer_metrics(self) -> DataFrame:
        return marketing.customer_metrics(self.order_summary, self.stg_customers)

    @cached_property
    def customer_segmentation(self) -> DataFrame:
        return marketing.customer_segmentation(
            self.customer_metrics, self.config.as_of, self.config.segments
        )

    def sellers_by(self, reviews: str) -> DataFrame:
        return core.seller_performance(
            self.seller_order_detail, self.stg_sellers, self.config.seller_tiers, reviews
        )

    def with_known_lines(self) -> Relations:
        """The relations over the lines of known orders only.

        Lines are dealt by order for that, and so they stay when they are rolled up by seller and
        order and meet the orders: one shuffle of the lines in place of two.
        """
        known = self.raw.orders.select("order_id")
        lines = self.raw.order_items.join(known, "order_id", "left_semi")
        raw = SimpleNamespace(**{role: getattr(self.raw, role) for role in RAW_SCHEMAS} | {"order_items": lines})
        return Relations(raw, self.config)

    def of_orders(self, changed: DataFrame) -> Relations:
        """The relations over the rows of some orders, read by their keys in ``changed``.

        Reviews are read by review: the one that counts may be another order's.
        """
        keys = changed.select("order_id").distinct()

        def rows(table: DataFrame) -> DataFrame:
            return table.join(keys, "order_id", "left_semi")

        raw = self.raw
        reviews = raw.order_reviews
        theirs = reviews.join(rows(reviews).select("review_id").distinct(), "review_id", "left_semi")
        few = SimpleNamespace(
            orders=rows(raw.orders),
            order_items=rows(raw.order_items),
            order_payments=rows(raw.order_payments),
            order_reviews=theirs,
            customers=raw.customers,
            sellers=raw.sellers,
            products=raw.products,
            translations=raw.translations,
        )
        return Relations(few, self.config)
