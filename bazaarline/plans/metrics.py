"""Business metrics over the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bazaarline.config import NOT_REPORTED_STATUSES, UNCATEGORIZED
from bazaarline.functions import days_between, exact_mean, safe_divide
from bazaarline.plans.core import days_to_deliver, is_delivered, is_on_time
from bazaarline.plans.rollups import order_product_lines

ALL = "(all)"


def is_reported() -> Column:
    return ~F.col("order_status").isin(list(NOT_REPORTED_STATUSES))


# Order revenue


def gmv(revenue: DataFrame) -> DataFrame:
    """Item revenue of all orders but canceled and unavailable ones."""
    return revenue.where(is_reported()).agg(F.sum("total_item_revenue").alias("gmv"))


def average_order_value(revenue: DataFrame) -> DataFrame:
    totals = revenue.where(is_delivered()).agg(
        F.sum("total_item_revenue").alias("delivered_gmv"),
        F.count("order_id").alias("delivered_orders"),
    )
    return totals.withColumn("aov", safe_divide(F.col("delivered_gmv"), F.col("delivered_orders")))


def freight_ratio(revenue: DataFrame, flag_above: float) -> DataFrame:
    ratio = safe_divide(F.sum("total_freight"), F.sum("total_item_revenue"))
    return revenue.agg(ratio.alias("freight_ratio")).withColumn(
        "is_flagged", F.col("freight_ratio") > flag_above
    )


# Item fact, as it is or summed by order; ``lines`` is then how many lines a row stands for.


def fact_totals(fact: DataFrame) -> DataFrame:
    return fact.agg(F.sum("item_price").alias("gmv"), F.sum("freight_value").alias("total_freight"))


def on_time_rate(fact: DataFrame, lines: str | None = None) -> DataFrame:
    """Lines on time by lines delivered."""
    return fact.agg(
        safe_divide(
            F.sum(F.col("is_on_time").cast("int") * _lines(lines)),
            F.sum(F.col("is_delivered").cast("int") * _lines(lines)),
        ).alias("on_time_rate")
    )


def average_days_to_deliver(fact: DataFrame, lines: str | None = None) -> DataFrame:
    """Mean over delivered lines with a known delivery date."""
    days = F.col("days_to_deliver")
    known = F.sum(F.when(days.isNotNull(), _lines(lines)).otherwise(0))
    return fact.where("is_delivered").agg(
        exact_mean(F.sum(days * _lines(lines)), known).alias("avg_days_to_deliver")
    )


def _lines(column: str | None) -> Column:
    return F.col(column) if column else F.lit(1)


def items_per_order(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines per order that has lines and exists.

    Equal to counting the fact by order, but lines are counted before they meet the orders.
    """
    counts = items.groupBy("order_id").agg(F.count("order_item_id").alias("items"))
    return counts.join(orders.select("order_id"), "order_id")


# Item fact by product category. The fact is rolled up per product before it meets the
# dimension, so a product with a third of all lines joins as one row.


def category_totals(
    fact: DataFrame, products: DataFrame, lines: str | None = None, overall: bool = False
) -> DataFrame:
    """One row per category: lines, revenue, freight, weight of the lines.

    ``overall`` adds one row for all of them, told apart by ``is_overall``.

    Lines without a product in the dimension are left out, as by an inner join.
    """
    per_product = fact.groupBy("product_id").agg(
        F.sum(_lines(lines)).alias("lines"),
        F.sum("item_price").alias("price"),
        F.sum("freight_value").alias("freight"),
    )
    weight = F.col("product_weight_g")
    category = "product_category_name_en"
    joined = per_product.join(products.select("product_id", category, "product_weight_g"), "product_id")
    grouped = joined.rollup(category) if overall else joined.groupBy(category)
    return (
        grouped.agg(
            F.sum("lines").alias("items"),
            F.sum("price").alias("gmv"),
            F.sum("freight").alias("total_freight"),
            exact_mean(
                F.sum(weight * F.col("lines")), F.sum(F.when(weight.isNotNull(), F.col("lines")))
            ).alias("avg_weight_g"),
            *([(F.grouping(category) == 1).alias("is_overall")] if overall else []),
        )
    )


def category_gmv(totals: DataFrame) -> DataFrame:
    return totals.select("product_category_name_en", "gmv")


def category_avg_weight(totals: DataFrame) -> DataFrame:
    """Of totals with the overall row, which is labelled as such."""
    category = F.when(F.col("is_overall"), F.lit(ALL)).otherwise(F.col("product_category_name_en"))
    return totals.select(category.alias("product_category_name_en"), "avg_weight_g")


def category_freight_ratio(totals: DataFrame) -> DataFrame:
    return totals.select(
        "product_category_name_en",
        safe_divide(F.col("total_freight"), F.col("gmv")).alias("freight_ratio"),
    )


def weight_delivery_corr(fact: DataFrame, products: DataFrame, lines: str | None = None) -> DataFrame:
    """Correlation of weight and of volume with the days to deliver, over delivered lines.

    The moments are exact integers built from per-product sums, so the result does not
    depend on the order of the rows.
    """
    days = F.col("days_to_deliver").cast("bigint")
    per_product = (
        fact.where(days.isNotNull())
        .groupBy("product_id")
        .agg(
            F.sum(_lines(lines)).alias("n"),
            F.sum(days * _lines(lines)).alias("y"),
            F.sum(days * days * _lines(lines)).alias("yy"),
        )
    )
    joined = per_product.join(
        products.select("product_id", "product_weight_g", "product_volume_cm3"), "product_id"
    )

    def correlation(attribute: str) -> Column:
        known = F.col(attribute).isNotNull()
        # Wide decimals: squares times counts of a hot product do not fit a long.
        x = F.col(attribute).cast("decimal(12,0)")

        def total(value: Column) -> Column:
            return F.sum(F.when(known, value)).cast("decimal(38,0)")

        n, sx, sy = total(F.col("n")), total(x * F.col("n")), total(F.col("y"))
        sxx, syy, sxy = total(x * x * F.col("n")), total(F.col("yy")), total(x * F.col("y"))
        spread_x = (n * sxx - sx * sx).cast("double")
        spread_y = (n * syy - sy * sy).cast("double")
        return safe_divide((n * sxy - sx * sy), F.sqrt(spread_x) * F.sqrt(spread_y))

    return joined.agg(
        F.round(correlation("product_weight_g"), 6).alias("weight_days_corr"),
        F.round(correlation("product_volume_cm3"), 6).alias("volume_days_corr"),
    )


# Sellers


def seller_rollup(reported_sellers: DataFrame) -> DataFrame:
    """Revenue of all sellers and the mean of their mean delivery days.

    The sellers come from details without canceled and unavailable orders.
    """
    return reported_sellers.agg(
        F.sum("total_gmv").alias("seller_gmv"),
        exact_mean(F.sum("avg_days_to_deliver"), F.count("avg_days_to_deliver")).alias(
            "mean_days_to_deliver"
        ),
    )


def tier_distribution(sellers: DataFrame) -> DataFrame:
    """Sellers per tier and their share. The list holds one entry per tier label."""
    counts = sellers.groupBy("seller_tier").agg(F.count(F.lit(1)).alias("sellers"))
    listed = counts.agg(
        F.sum("sellers").alias("total"),
        F.collect_list(F.struct("seller_tier", "sellers")).alias("tiers"),
    )
    return listed.select("total", F.inline("tiers")).select(
        "seller_tier", "sellers", safe_divide(F.col("sellers"), F.col("total")).alias("share")
    )


def underperforming_sellers(sellers: DataFrame, tier: str = "bronze", score: float = 3.0) -> DataFrame:
    return sellers.where((F.col("seller_tier") == tier) & (F.col("avg_review_score") < score)).select(
        "seller_id", "seller_tier", "avg_review_score", "total_gmv"
    )


def seller_stuck_rate(detail: DataFrame, status: str = "processing") -> DataFrame:
    """Share of every seller's orders that are in ``status``."""
    return (
        detail.groupBy("seller_id")
        .agg(
            F.count("order_id").alias("orders"),
            F.count_if(F.col("order_status") == status).alias("stuck_orders"),
        )
        .withColumn("stuck_rate", safe_divide(F.col("stuck_orders"), F.col("orders")))
    )


# Customers


def customer_rfm(segments: DataFrame) -> DataFrame:
    return segments.select(
        "customer_unique_id",
        F.col("days_since_last_order").alias("recency"),
        F.col("lifetime_orders").alias("frequency"),
        F.col("lifetime_gmv").alias("monetary"),
        "customer_segment",
    )


# Status history


def avg_time_per_status(durations: DataFrame) -> DataFrame:
    return durations.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("versions"),
        exact_mean(F.sum("hours_in_status"), F.count("hours_in_status")).alias("avg_hours"),
    )


# Announced marts, in their smallest form


def product_performance(items: DataFrame, summary: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, on-time rate and review score per category, over the lines of existing orders.

    Lines are rolled up per order and product, and again per product, so each join meets
    one row per key on both sides; ``lines`` carries how many rows a sum must count.
    """
    lines = F.col("lines")
    score = F.col("avg_review_score")

    def lines_where(condition: Column) -> Column:
        return F.sum(F.when(condition, lines).otherwise(0))

    per_product = (
        order_product_lines(items)
        .join(summary, "order_id")
        .groupBy("product_id")
        .agg(
            F.sum("lines").alias("lines"),
            F.sum("item_price").alias("price"),
            lines_where(is_delivered()).alias("delivered"),
            lines_where(is_on_time()).alias("on_time"),
            F.sum(score * lines.cast("decimal(10,0)")).alias("score_sum"),
            lines_where(score.isNotNull()).alias("scored"),
        )
    )
    category = F.coalesce("product_category_name_en", F.lit(UNCATEGORIZED))
    return (
        per_product.join(products, "product_id", "left")
        .groupBy(category.alias("product_category_name_en"))
        .agg(
            F.sum("lines").alias("items"),
            F.sum("price").alias("gmv"),
            F.round(safe_divide(F.sum("on_time"), F.sum("delivered")), 4).alias("on_time_delivery_rate"),
            F.round(exact_mean(F.sum("score_sum"), F.sum("scored")), 2).alias("avg_review_score"),
        )
    )


def seller_fulfillment(seller_orders: DataFrame, orders: DataFrame) -> DataFrame:
    """Mean days from order to carrier and from order to customer, per seller."""
    to_carrier = days_between(F.col("ordered_at"), F.col("shipped_at"))
    to_customer = days_to_deliver()
    return (
        seller_orders.join(orders, "order_id")
        .groupBy("seller_id")
        .agg(
            F.count("order_id").alias("orders"),
            exact_mean(F.sum(to_carrier), F.count(to_carrier)).alias("avg_days_to_ship"),
            exact_mean(F.sum(to_customer), F.count(to_customer)).alias("avg_days_to_deliver"),
        )
    )


def dim_dates(spine: DataFrame) -> DataFrame:
    day = F.col("date_day")
    return spine.select(
        "date_day",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
    )
