"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from bazaarline.plans import core, metrics, rollups
from parity import SAMPLE
from parity.queries import REGISTRY


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_pairwise_join_no_python_no_unpartitioned_window(spark, name):
    plan = plan_of(REGISTRY[name](spark, SAMPLE))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas", "MapInArrow"):
        assert operator not in plan
    # Functions, partition keys, order: a window without keys prints only two lists.
    windows = [line for line in plan.splitlines() if re.search(r"\bWindow \[", line)]
    assert all(re.search(r"\], \[[^\[\]]+\], \[[^\[\]]+\]$", line) for line in windows)


def test_the_window_test_sees_a_window_without_keys(spark):
    from pyspark.sql import Window

    plan = plan_of(spark.range(3).select(F.row_number().over(Window.orderBy("id"))))
    line = next(line for line in plan.splitlines() if re.search(r"\bWindow \[", line))
    assert not re.search(r"\], \[[^\[\]]+\], \[[^\[\]]+\]$", line)


def test_scan_reads_only_the_columns_of_the_query(spark):
    plan = plan_of(REGISTRY["order_items_agg"](spark, SAMPLE))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    names = {part.split(":")[0] for part in schema.split(",")}
    assert names == {"l_orderkey", "l_partkey", "l_extendedprice", "l_tax"}


def test_review_texts_are_not_read_for_scores(spark):
    plan = plan_of(REGISTRY["seller_performance"](spark, SAMPLE))
    assert "event_id" in plan and "props" not in plan and "event_type" not in plan


@pytest.mark.parametrize(
    ("name", "unused"),
    [
        ("order_revenue", "event_id"),
        ("seller_performance", "l_returnflag"),
        ("customer_segmentation", "l_returnflag"),
        ("customer_segmentation", "l_partkey"),
    ],
)
def test_joins_with_unused_rollups_are_dropped(spark, name, unused):
    assert unused not in plan_of(REGISTRY[name](spark, SAMPLE))


def test_filters_reach_the_scan(spark, tmp_path):
    fact = str(tmp_path / "fact")
    REGISTRY["fct_order_items"](spark, SAMPLE).write.parquet(fact)
    plan = plan_of(metrics.average_days_to_deliver(spark.read.parquet(fact)))
    assert "EqualTo(is_delivered,true)" in plan


def test_seed_is_broadcast_by_its_size(spark):
    plan = plan_of(REGISTRY["dim_products"](spark, SAMPLE))
    assert "BroadcastHashJoin" in plan and "FileScan csv" in plan or "Scan csv" in plan


def test_categories_are_grouped_without_a_total(spark):
    for name in ("category_gmv", "category_freight_ratio"):
        assert "Expand" not in plan_of(REGISTRY[name](spark, SAMPLE))


# A third of all lines belong to one order, one seller and one product.


@pytest.fixture(scope="module")
def hot(spark):
    def hot_or(spread: int):
        return F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % spread)

    items = spark.range(60_000, numPartitions=8).select(
        hot_or(5_003).alias("order_id"),
        F.col("id").alias("order_item_id"),
        hot_or(701).alias("product_id"),
        hot_or(101).alias("seller_id"),
        F.lit("1.25").cast("decimal(12,2)").alias("item_price"),
        F.lit("0.50").cast("decimal(12,2)").alias("freight_value"),
        F.md5(F.col("id").cast("string")).alias("filler"),
    )
    orders = spark.range(5_003, numPartitions=4).select(
        F.col("id").alias("order_id"),
        (F.col("id") % 97).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        *[
            F.lit("2018-01-0" + day).cast("timestamp_ntz").alias(name)
            for name, day in (
                ("ordered_at", "1"), ("approved_at", "1"), ("shipped_at", "2"),
                ("delivered_at", "3"), ("estimated_delivery_at", "4"),
            )
        ],
    )
    return items, orders


@pytest.fixture
def small_skew_limits(settings):
    settings(
        spark__sql__shuffle__partitions="48",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="16k",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16k",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="4k",
    )


def executed(df) -> str:
    # An action on the frame itself, so that its adaptive plan becomes final.
    df.collect()
    return plan_of(df)


def test_hot_order_is_split_in_the_fact_join(hot, small_skew_limits):
    items, orders = hot
    fact = core.fct_order_items(items, orders)
    assert "skew=true" in executed(fact)
    assert fact.count() == 60_000


def test_hot_order_is_split_even_if_a_grouping_on_it_follows(hot, small_skew_limits):
    items, orders = hot
    counts = core.fct_order_items(items, orders).groupBy("order_id").agg(F.max("order_item_sk"))
    assert "skew=true" in executed(counts)
    assert counts.count() == 5_003


def test_hot_keys_are_rolled_up_before_they_are_shuffled(hot, small_skew_limits):
    items, orders = hot
    for rollup in (rollups.order_items_agg(items), rollups.seller_order_items(items)):
        below = plan_of(rollup).split("Exchange hashpartitioning")[-1]
        assert "partial_sum" in below
    per_order = metrics.items_per_order(items, orders)
    assert "skew=true" not in executed(per_order)
    assert per_order.agg(F.sum("items")).first()[0] == 60_000
    assert per_order.where("order_id = 0").first().items >= 20_000


def test_distinct_count_spreads_a_hot_order(hot):
    items, _ = hot
    plan = plan_of(rollups.order_items_agg(items))
    assert re.search(r"Exchange hashpartitioning\(order_id#\d+L?, product_id#\d+L?", plan)
    hot_order = rollups.order_items_agg(items).where("order_id = 0").first()
    assert hot_order.total_items == items.where("order_id = 0").select("product_id").distinct().count()


def test_reviews_are_not_multiplied_with_sellers(spark, hot):
    """One order with a third of the lines and of the reviews stays one row per seller."""
    items, orders = hot
    reviews = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5_003).alias("order_id"),
        F.lit(4).alias("review_score"),
    )
    seller_orders = rollups.seller_order_items(items)
    summary = orders.join(rollups.order_reviews_agg(reviews), "order_id", "left")
    detail = core.seller_order_detail(seller_orders, summary)
    assert detail.count() == seller_orders.count()
    pairs = seller_orders.join(orders, "order_id").join(reviews, "order_id", "left").count()
    assert detail.agg(F.sum("detail_rows")).first()[0] == pairs


def scans(plan: str, column: str) -> int:
    return sum(1 for line in plan.splitlines() if "Scan parquet" in line and column in line)


def test_checks_compute_each_relation_once(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(REGISTRY["dq_not_null"](spark, SAMPLE))
    # Items, payments, and the three marts that sum items: no raw table is scanned by itself.
    single = plan_of(REGISTRY["dq_unique"](spark, SAMPLE))
    assert scans(single, "c_custkey") <= 2 and scans(plan, "p_partkey") <= 2
    totals = plan_of(REGISTRY["dq_reconcile"](spark, SAMPLE))
    # One aggregate per relation: five of them and the one that compares.
    assert len(re.findall(r"Union", totals)) >= 1 and "CartesianProduct" not in totals


def test_large_volumes(spark):
    sides = spark.createDataFrame([(2000, 2000, 2000)], "product_length_cm int, product_height_cm int, product_width_cm int")
    assert sides.select(core.product_volume()).first()[0] == 8_000_000_000
