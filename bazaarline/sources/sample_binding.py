"""The sample tables in the roles of the raw marketplace tables.

Every expression is row-local arithmetic on keys: no shuffle, no window, and both the
filter and the column list of a plan reach the parquet scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from bazaarline.plans.staging import order_versions
from bazaarline.sources.readers import SEED_DIR, load_seed, load_source
from bazaarline.sources.schemas import RAW_SCHEMAS

SAMPLE_SCHEMAS = {
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "customer": """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
}

SAMPLE_SEED = SEED_DIR / "sample_category_translation.csv"


def sample_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_source(spark, f"{sf_dir}/{name}.parquet", SAMPLE_SCHEMAS[name])


def _plus(days: str = "0", hours: str = "0") -> str:
    return f"o_orderdate + make_dt_interval(cast({days} as int), cast({hours} as int))"


# Unique within an order at every scale: price in cents, then the line number.
LINE_CODE = "cast(floor(l_extendedprice * 100 + 0.5) as int) * 10 + l_linenumber"


class SampleTables:
    """The raw tables read from the sample directory, each made on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark = spark
        self._sf_dir = sf_dir

    def _table(self, name: str) -> DataFrame:
        return sample_table(self._spark, self._sf_dir, name)

    @cached_property
    def _lines(self) -> DataFrame:
        return self._table("lineitem")

    @cached_property
    def _places(self) -> DataFrame:
        return self._table("nation").join(
            self._table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self._table("orders").selectExpr(
            "o_orderkey as order_id",
            "o_custkey as customer_id",
            """case o_orderstatus when 'F' then 'Delivered' when 'O' then 'SHIPPED'
               else 'processing' end as order_status""",
            f"{_plus(hours='o_orderkey * 37 % 24')} as order_purchase_timestamp",
            f"{_plus(hours='o_orderkey * 37 % 24 + 1 + o_orderkey % 5')} as order_approved_at",
            f"""case when o_orderstatus in ('F', 'O') then {_plus(days='1')} end
               as order_delivered_carrier_date""",
            f"""case when o_orderstatus = 'F' and o_orderkey % 97 <> 0
               then {_plus(days='1 + o_orderkey % 40', hours='o_orderkey * 11 % 24')} end
               as order_delivered_customer_date""",
            f"{_plus(days='20 + o_orderkey % 7')} as order_estimated_delivery_date",
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return self._lines.selectExpr(
            "l_orderkey as order_id",
            f"{LINE_CODE} as order_item_id",
            "l_partkey as product_id",
            "l_suppkey as seller_id",
            "l_shipdate as shipping_limit_date",
            "l_extendedprice as price",
            """cast(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2))
               as decimal(12,2)) as freight_value""",
        )

    @cached_property
    def order_payments(self) -> DataFrame:
        return self._lines.selectExpr(
            "l_orderkey as order_id",
            f"{LINE_CODE} as payment_sequential",
            """case l_returnflag when 'R' then 'Credit_Card' when 'A' then 'BOLETO'
               else 'voucher' end as payment_type""",
            "1 + cast(l_quantity as int) % 12 as payment_installments",
            "l_extendedprice as payment_value",
        )

    @cached_property
    def order_reviews(self) -> DataFrame:
        return self._table("events").selectExpr(
            "event_id - if(event_id % 13 = 12, 1, 0) as review_id",
            "event_id - if(event_id % 8 = 7, 1, 0) as order_id",
            "1 + event_id * 7 % 5 as review_score",
            "event_type as review_comment_title",
            "props as review_comment_message",
            "ts as review_creation_date",
            "if(event_id % 50 = 0, null, ts) as review_answer_timestamp",
        )

    @cached_property
    def customers(self) -> DataFrame:
        located = self._table("customer").join(
            self._places, F.col("c_nationkey") == F.col("n_nationkey"), "left"
        )
        return located.selectExpr(
            "c_custkey as customer_id",
            "c_custkey - if(c_custkey % 10 = 9, 1, 0) as customer_unique_id",
            "c_nationkey as customer_zip_code_prefix",
            "n_name as customer_city",
            "lower(r_name) as customer_state",
        )

    @cached_property
    def sellers(self) -> DataFrame:
        located = self._table("supplier").join(
            self._places, F.col("s_nationkey") == F.col("n_nationkey"), "left"
        )
        return located.selectExpr(
            "s_suppkey as seller_id",
            "s_nationkey as seller_zip_code_prefix",
            "n_name as seller_city",
            "lower(r_name) as seller_state",
        )

    @cached_property
    def products(self) -> DataFrame:
        return self._table("part").selectExpr(
            "p_partkey as product_id",
            "if(p_partkey % 50 = 0, null, lower(p_type)) as product_category_name",
            "length(p_name) as product_name_lenght",
            "p_size as product_description_lenght",
            "p_size % 6 as product_photos_qty",
            "p_size * 10 as product_weight_g",
            "if(p_partkey % 61 = 0, null, p_size) as product_length_cm",
            "cast(1 + p_partkey % 7 as int) as product_height_cm",
            "if(p_partkey % 67 = 0, null, cast(2 + p_partkey % 5 as int)) as product_width_cm",
        )

    @cached_property
    def translations(self) -> DataFrame:
        return load_seed(self._spark, SAMPLE_SEED, RAW_SCHEMAS["translations"])


# Two states of the order source for the status history. The first ends before the newest
# orders were placed; the second no longer delivers the oldest ones.
RUN_1_ENDS = "2001-01-01"
RUN_2_STARTS = "1995-07-01"


def status_run_1(orders: DataFrame) -> DataFrame:
    """The source at the first run: recent orders absent, some statuses early or unknown."""
    early = F.expr(
        "case when order_id % 25 = 0 then null when order_id % 4 = 0 then 'created' else order_status end"
    )
    known = F.col("order_purchase_timestamp") < F.lit(RUN_1_ENDS).cast("timestamp_ntz")
    return order_versions(orders.where(known).withColumn("order_status", early))


def status_run_2(orders: DataFrame) -> DataFrame:
    """The source at the second run: all statuses final, the oldest orders gone."""
    kept = F.col("order_purchase_timestamp") >= F.lit(RUN_2_STARTS).cast("timestamp_ntz")
    return order_versions(orders.where(kept))
