"""Marketing marts: customer segments and the customer activity calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from bazaarline.config import CALENDAR_END, CALENDAR_START, SegmentRules
from bazaarline.functions import as_of_date, days_between, exact_mean
from bazaarline.operators.calendar import densify_calendar
from bazaarline.plans.core import is_delivered


def customer_metrics(summary: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per person over the delivered orders of all their customer ids.

    Orders are first rolled up per customer id, then joined with the customers, so the join
    meets one row per customer id however many orders one of them holds. This relies on
    ``order_id`` and ``customer_id`` being unique in their tables, which the contracts check.
    """
    per_customer = (
        summary.where(is_delivered())
        .groupBy("customer_id")
        .agg(
            F.min("ordered_at").alias("first_order_at"),
            F.max("ordered_at").alias("last_order_at"),
            F.count("order_id").alias("orders"),
            F.sum("total_item_revenue").alias("gmv"),
            F.sum("total_freight").alias("freight"),
            F.sum("avg_review_score").alias("score_sum"),
            F.count("avg_review_score").alias("scored_orders"),
        )
    )
    score = exact_mean(F.sum("score_sum"), F.sum("scored_orders"), digits=12)
    return (
        customers.join(per_customer, "customer_id")
        .groupBy("customer_unique_id")
        .agg(
            F.max("customer_city").alias("customer_city"),
            F.max("customer_state").alias("customer_state"),
            F.min("first_order_at").alias("first_order_at"),
            F.max("last_order_at").alias("last_order_at"),
            F.sum("orders").alias("lifetime_orders"),
            F.coalesce(F.sum("gmv"), F.lit(0)).alias("lifetime_gmv"),
            F.coalesce(F.sum("freight"), F.lit(0)).alias("lifetime_freight"),
            F.round(score, 1).alias("avg_review_score"),
        )
    )


def segment_of(orders: Column, days: Column, rules: SegmentRules = SegmentRules()) -> Column:
    """Segment by frequency and recency; the first rule that holds wins."""
    recent = days <= rules.recent_days
    return (
        F.when((orders >= rules.champion_orders) & recent, "champion")
        .when((orders >= rules.repeat_orders) & (days <= rules.loyal_days), "loyal")
        .when((orders >= rules.repeat_orders) & (days > rules.loyal_days), "at_risk")
        .when((orders == 1) & recent, "new")
        .otherwise("one_and_done")
    )


def customer_segmentation(
    metrics: DataFrame, as_of: date | None = None, rules: SegmentRules = SegmentRules()
) -> DataFrame:
    """:func:`customer_metrics` with recency, the repeat flag and the segment."""
    recency = days_between(F.col("last_order_at"), as_of_date(as_of))
    return metrics.withColumns(
        {
            "days_since_last_order": recency,
            "is_repeat_buyer": F.coalesce(F.col("lifetime_orders") > 1, F.lit(False)),
            "customer_segment": segment_of(F.col("lifetime_orders"), recency, rules),
        }
    )


def daily_orders(fact: DataFrame, entity: str) -> DataFrame:
    """One row per entity and order day: distinct orders and item revenue."""
    return fact.groupBy(entity, F.to_date("ordered_at").alias("order_date")).agg(
        F.countDistinct("order_id").alias("orders_placed"),
        F.sum("item_price").alias("gmv"),
    )


def customer_order_dates(
    fact: DataFrame,
    start: date = CALENDAR_START,
    end: date = CALENDAR_END,
    partitions: int | None = None,
) -> DataFrame:
    """Every customer on every calendar day, idle days included.

    ``partitions`` is the number of tasks that make the days; the output has as many rows as
    customers times days, so it follows the output rather than the input.
    """
    return densify_calendar(
        daily_orders(fact, "customer_id"),
        entity="customer_id",
        day="order_date",
        measures=["orders_placed", "gmv"],
        start=start,
        end=end,
        partitions=partitions,
    )
