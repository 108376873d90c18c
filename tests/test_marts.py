"""Hand-made marketplace: few rows, every special case."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from bazaarline.config import MartConfig
from bazaarline.plans import marketing, metrics, rollups
from bazaarline.plans.relations import Relations
from bazaarline.sources.schemas import RAW_SCHEMAS

AS_OF = date(2018, 7, 1)


def day(month: int, number: int, hour: int = 0) -> datetime:
    return datetime(2018, month, number, hour)


ORDERS = [
    # id, customer, status, purchase, approved, shipped, delivered, estimated
    ("o1", "c1", "DELIVERED", day(6, 1, 23), day(6, 2), day(6, 3), day(6, 5, 1), day(6, 5, 1)),
    ("o2", "c2", "delivered", day(6, 2), day(6, 2), day(6, 3), day(6, 20), day(6, 10)),
    ("o3", "c1", "delivered", day(6, 3), day(6, 3), None, None, day(6, 10)),
    ("o4", "c3", "canceled", day(6, 4), None, None, None, day(6, 10)),
    ("o5", "c3", "processing", day(6, 5), None, None, None, day(6, 10)),
    ("o6", "c4", "delivered", day(1, 1), day(1, 1), day(1, 2), day(1, 3), day(1, 9)),
]
ITEMS = [
    ("o1", 1, "p1", "s1", "10.00", "1.00"),
    ("o1", 2, "p1", "s1", "10.00", "1.00"),
    ("o1", 3, "p2", "s2", "5.50", "0.50"),
    ("o2", 1, "p2", "s1", "60000.00", "2.00"),
    ("o3", 1, "p3", "s1", "20.00", "3.00"),
    ("o4", 1, "p1", "s3", "999.00", "4.00"),
    ("lost", 1, "p1", "s1", "7.00", "1.00"),
]
PAYMENTS = [
    ("o1", 1, "Voucher", 1, "20.00"),
    ("o1", 2, "CREDIT_CARD", 8, "8.00"),
    ("o1", 3, "voucher", 2, "0.00"),
    ("o5", 1, "boleto", 1, "12.00"),
]
REVIEWS = [
    ("r1", "o1", 5, day(6, 6), day(6, 7)),
    ("r2", "o1", 2, day(6, 6), day(6, 8)),
    ("r3", "o2", 1, day(6, 21), day(6, 22)),
    ("r3", "o2", 3, day(6, 21), day(6, 23)),
]
CUSTOMERS = [
    ("c1", "u1", "1", "Recife", "pe"),
    ("c2", "u1", "2", "Natal", "rn"),
    ("c3", "u2", "3", "Manaus", "am"),
    ("c4", "u3", "4", "Belem", "pa"),
]
SELLERS = [("s1", "1", "Recife", "pe"), ("s2", "1", "Natal", "rn"), ("s3", "1", "X", "am"), ("s4", "1", "Y", "pa")]
PRODUCTS = [
    ("p1", "moveis", 10, 100, 1, 200, 2, 3, 4),
    ("p2", "MOVEIS", 10, 100, 1, 300, None, 3, 4),
    ("p3", None, 10, 100, 1, None, 2, 3, None),
]
TRANSLATIONS = [("moveis", "furniture")]


@pytest.fixture(scope="module")
def relations(spark):
    def table(name, data):
        return spark.createDataFrame(data, RAW_SCHEMAS[name])

    raw = SimpleNamespace(
        orders=table("orders", ORDERS),
        order_items=table(
            "order_items",
            [(o, n, p, s, day(6, 1), Decimal(a), Decimal(f)) for o, n, p, s, a, f in ITEMS],
        ),
        order_payments=table("order_payments", [(*p[:4], Decimal(p[4])) for p in PAYMENTS]),
        order_reviews=table("order_reviews", [(r, o, s, "t", "m", c, a) for r, o, s, c, a in REVIEWS]),
        customers=table("customers", CUSTOMERS),
        sellers=table("sellers", SELLERS),
        products=table("products", PRODUCTS),
        translations=table("translations", TRANSLATIONS),
    )
    return Relations(raw, MartConfig(as_of=AS_OF))


def rows_of(df):
    return sorted(tuple(row) for row in df.collect())


def by_key(df, key):
    return {row[key]: row for row in df.collect()}


def test_fact_drops_items_without_an_order(relations):
    fact = by_key(relations.fct_order_items, "order_item_sk")
    assert sorted(fact) == ["o1-1", "o1-2", "o1-3", "o2-1", "o3-1", "o4-1"]
    assert (fact["o1-1"].is_delivered, fact["o1-1"].is_on_time, fact["o1-1"].days_to_deliver) == (True, True, 4)
    assert (fact["o2-1"].is_on_time, fact["o2-1"].days_to_deliver) == (False, 18)
    assert (fact["o3-1"].is_delivered, fact["o3-1"].is_on_time, fact["o3-1"].days_to_deliver) == (True, None, None)
    assert (fact["o4-1"].is_delivered, fact["o4-1"].is_on_time, fact["o4-1"].days_to_deliver) == (False, None, None)


def test_dim_products(relations):
    dim = by_key(relations.dim_products, "product_id")
    assert [dim[p].product_category_name_en for p in ("p1", "p2", "p3")] == [
        "furniture", "uncategorized", "uncategorized",
    ]
    assert [dim[p].product_volume_cm3 for p in ("p1", "p2", "p3")] == [24, None, None]


def test_order_revenue(relations):
    revenue = by_key(relations.order_revenue, "order_id")
    assert len(revenue) == len(ORDERS)
    o1 = revenue["o1"]
    assert (o1.total_items, o1.total_item_revenue, o1.total_freight) == (2, Decimal("25.50"), Decimal("2.50"))
    assert (o1.payment_types, o1.payment_installments_max) == ("credit_card, voucher", 8)
    assert o1.revenue_freight_delta == 0
    paid_only = revenue["o5"]
    assert (paid_only.total_items, paid_only.total_item_revenue) == (0, 0)
    assert paid_only.revenue_freight_delta == Decimal("12.00")
    bare = revenue["o6"]
    assert (bare.total_payment, bare.payment_types, bare.payment_installments_max) == (0, None, None)


def test_seller_performance_counts_an_order_once_per_review(relations):
    sellers = by_key(relations.seller_performance, "seller_id")
    assert sorted(sellers) == ["s1", "s2", "s3"]
    s1 = sellers["s1"]
    assert (s1.total_orders, s1.total_delivered_orders, s1.total_items_sold) == (4, 4, 6)
    assert s1.total_gmv == Decimal("60060.00")
    assert s1.avg_review_score == Decimal("3.33")
    assert (s1.on_time_orders, s1.on_time_delivery_rate) == (2, 0.5)
    assert s1.avg_days_to_deliver == Decimal("8.7")
    assert (s1.first_sale_at, s1.last_sale_at) == (day(6, 1, 23), day(6, 3))
    assert [sellers[s].seller_tier for s in ("s1", "s2", "s3")] == ["platinum", "bronze", "bronze"]
    s3 = sellers["s3"]
    assert (s3.total_delivered_orders, s3.on_time_delivery_rate, s3.avg_days_to_deliver) == (0, None, None)
    assert s3.avg_review_score is None


def test_seller_performance_per_order_reconciles_with_the_fact(relations):
    sellers = relations.sellers_by("per_order")
    s1 = by_key(sellers, "seller_id")["s1"]
    assert (s1.total_orders, s1.total_items_sold, s1.total_gmv) == (3, 4, Decimal("60040.00"))
    assert s1.avg_review_score == Decimal("3.25")
    total = sellers.agg(F.sum("total_gmv")).first()[0]
    assert total == relations.fct_order_items.agg(F.sum("item_price")).first()[0]
    with pytest.raises(ValueError, match="reviews"):
        relations.sellers_by("each")


def test_segments_merge_the_customer_ids_of_a_person(relations):
    people = by_key(relations.customer_segmentation, "customer_unique_id")
    assert sorted(people) == ["u1", "u3"]
    u1 = people["u1"]
    assert (u1.lifetime_orders, u1.lifetime_gmv, u1.lifetime_freight) == (
        3, Decimal("60045.50"), Decimal("7.50"),
    )
    assert (u1.customer_city, u1.customer_state) == ("recife", "RN")
    assert u1.avg_review_score == Decimal("3.3")
    assert (u1.first_order_at, u1.last_order_at, u1.days_since_last_order) == (day(6, 1, 23), day(6, 3), 28)
    assert (u1.is_repeat_buyer, u1.customer_segment) == (True, "champion")
    u3 = people["u3"]
    assert (u3.lifetime_orders, u3.lifetime_gmv, u3.avg_review_score) == (1, 0, None)
    assert (u3.is_repeat_buyer, u3.customer_segment) == (False, "one_and_done")


@pytest.mark.parametrize(
    ("orders", "days", "segment"),
    [
        (1, 90, "new"), (1, 91, "one_and_done"), (2, 90, "loyal"), (2, 180, "loyal"),
        (2, 181, "at_risk"), (3, 90, "champion"), (3, 91, "loyal"), (3, 181, "at_risk"),
        (1, None, "one_and_done"), (5, None, "one_and_done"),
    ],
)
def test_segment_limits(spark, orders, days, segment):
    df = spark.createDataFrame([(orders, days)], "f bigint, r int")
    assert df.select(marketing.segment_of(F.col("f"), F.col("r"))).first()[0] == segment


def test_mean_of_means_keeps_the_digits_of_the_inner_means(spark):
    """Orders score 3.333333, 3.333333 and 3.083333: their mean stays below 3.25."""
    scores = [("a", s) for s in (3, 3, 4)] + [("b", s) for s in (3, 3, 4)] + [("c", 3)] * 11 + [("c", 4)]
    reviews = spark.createDataFrame(scores, "order_id string, review_score int")
    orders = spark.createDataFrame(
        [(o, "c1", "delivered", day(6, 1), None, None) for o in "abc"],
        """order_id string, customer_id string, order_status string, ordered_at timestamp_ntz,
        total_item_revenue decimal(22,2), total_freight decimal(22,2)""",
    )
    customers = spark.createDataFrame(
        [("c1", "u1", "x", "y")],
        "customer_id string, customer_unique_id string, customer_city string, customer_state string",
    )
    summary = orders.join(rollups.order_reviews_agg(reviews), "order_id", "left")
    assert marketing.customer_metrics(summary, customers).first().avg_review_score == Decimal("3.2")


def test_rollups_read_the_fact_as_well(relations, rows):
    from_fact = rollups.order_items_agg(relations.fct_order_items)
    from_items = relations.order_items_agg.where("order_id <> 'lost'")
    assert rows(from_fact) == rows(from_items)


def test_metrics(relations):
    r = relations
    assert metrics.gmv(r.order_revenue).first()[0] == Decimal("60045.50")
    aov = metrics.average_order_value(r.order_revenue).first()
    assert (aov.delivered_orders, aov.aov) == (4, 60045.5 / 4)
    ratio = metrics.freight_ratio(r.order_revenue, 0.3).first()
    assert (round(ratio.freight_ratio, 6), ratio.is_flagged) == (round(11.5 / 61044.5, 6), False)
    assert metrics.on_time_rate(r.fct_order_items).first()[0] == 3 / 5
    assert metrics.average_days_to_deliver(r.fct_order_items).first()[0] == Decimal("7.500000")
    by_order = r.fct_by_order
    assert rows_of(metrics.fact_totals(by_order)) == rows_of(metrics.fact_totals(r.fct_order_items))
    assert metrics.on_time_rate(by_order, "lines").first()[0] == 3 / 5
    assert metrics.average_days_to_deliver(by_order, "lines").first()[0] == Decimal("7.500000")
    assert rows_of(metrics.weight_delivery_corr(r.fct_by_order_product, r.dim_products, "lines")) == rows_of(
        metrics.weight_delivery_corr(r.fct_order_items, r.dim_products)
    )
    assert rows_of(marketing.daily_orders(by_order, "customer_id")) == rows_of(
        marketing.daily_orders(r.fct_order_items, "customer_id")
    )
    items = dict(metrics.items_per_order(r.stg_order_items, r.stg_orders).collect())
    assert items == {"o1": 3, "o2": 1, "o3": 1, "o4": 1}
    totals = by_key(
        metrics.category_totals(r.fct_order_items, r.dim_products, overall=True), "product_category_name_en"
    )
    assert set(totals) == {None, "furniture", "uncategorized"} and totals[None].is_overall
    alone = by_key(metrics.category_totals(r.fct_order_items, r.dim_products), "product_category_name_en")
    assert sorted(alone) == ["furniture", "uncategorized"]
    assert (totals["furniture"].items, totals["furniture"].avg_weight_g) == (3, 200)
    assert totals["uncategorized"].avg_weight_g == 300
    assert totals[None].avg_weight_g == 240
    tiers = by_key(metrics.tier_distribution(r.seller_performance), "seller_tier")
    assert (tiers["bronze"].sellers, tiers["bronze"].share) == (2, 2 / 3)
    assert metrics.underperforming_sellers(r.seller_performance).count() == 0
    stuck = by_key(metrics.seller_stuck_rate(r.seller_order_detail, "canceled"), "seller_id")
    assert [stuck[s].stuck_rate for s in ("s1", "s2", "s3")] == [0.0, 0.0, 1.0]
    speed = by_key(metrics.seller_fulfillment(r.seller_order_items, r.stg_orders), "seller_id")
    assert (speed["s1"].avg_days_to_ship, speed["s1"].avg_days_to_deliver) == (Decimal("1.500000"), 11)


def test_product_performance(relations):
    r = relations
    found = by_key(
        metrics.product_performance(r.stg_order_items, r.order_summary, r.dim_products),
        "product_category_name_en",
    )
    furniture, rest = found["furniture"], found["uncategorized"]
    assert (furniture.items, furniture.on_time_delivery_rate, furniture.avg_review_score) == (3, 1.0, 3.5)
    assert (rest.items, rest.on_time_delivery_rate) == (3, round(1 / 3, 4))
    assert rest.avg_review_score == Decimal("3.25")


def test_correlation_of_large_values(spark):
    schema = "product_id int, days_to_deliver int"
    days = [(1, 1), (2, 2), (3, 4), (3, 3), (4, 9), (5, None)]
    sizes = [(1, 10, 2_000_000_000), (2, 20, 1_900_000_000), (3, 35, 1_000_000_000), (4, None, 5), (5, 9, 9)]
    fact = spark.createDataFrame(days, schema)
    products = spark.createDataFrame(sizes, "product_id int, product_weight_g int, product_volume_cm3 int")
    found = metrics.weight_delivery_corr(fact, products).first()
    lines = fact.join(products, "product_id").where("days_to_deliver is not null")
    assert found.weight_days_corr == pytest.approx(
        lines.where("product_weight_g is not null")
        .select(F.corr("product_weight_g", "days_to_deliver"))
        .first()[0],
        abs=1e-6,
    )
    assert found.volume_days_corr == pytest.approx(
        lines.select(F.corr("product_volume_cm3", "days_to_deliver")).first()[0], abs=1e-6
    )
