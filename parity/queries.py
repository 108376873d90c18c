"""Every operator and relation as a query over the whole sample tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from operator import attrgetter
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DecimalType

from bazaarline.config import ORDER_STATUSES, SELLER_TIERS, MartConfig, Tier
from bazaarline.functions import (
    as_of_date,
    classify_tier,
    days_between,
    exact_mean,
    hashed_key,
    safe_divide,
    surrogate_key,
    to_money,
    to_timestamp_ntz,
    to_whole,
)
from bazaarline.operators import actives, changelog, deltas, history as h, quality as q, reconcile
from bazaarline.operators.asof import asof_join
from bazaarline.operators.calendar import date_spine, densify_calendar
from bazaarline.operators.latest import latest_per_key
from bazaarline.plans import contracts, core, marketing, metrics, rollups
from bazaarline.plans.relations import Relations
from bazaarline.plans.staging import order_versions
from bazaarline.session import prepare
from bazaarline.sources.quarantine import Sorted, load_sorted
from bazaarline.sources.sample_binding import (
    RUN_1_ENDS,
    RUN_2_STARTS,
    SAMPLE_SCHEMAS,
    SampleTables,
    sample_table,
    status_run_1,
    status_run_2,
)
from bazaarline.sources.schemas import RAW_SCHEMAS
from bazaarline.sources.writers import fresh_path, materialize_table, materialize_view
from bazaarline.streaming.change_feed import changes_in_time, follow_log, write_changes

Query = Callable[[SparkSession, str], DataFrame]

# The day after the last sample order.
AS_OF = date(2001, 8, 2)
RUN_1 = datetime(2001, 8, 2)
RUN_2 = datetime(2001, 8, 3, 6, 30)
NOW = datetime(2001, 8, 5, 1, 15)

# Sample sellers sell about 31.8 million each, so the tiers are drawn around that.
SAMPLE_TIERS = (
    Tier(33_000_000, "platinum"),
    Tier(32_000_000, "gold"),
    Tier(31_000_000, "silver"),
    Tier(0, "bronze"),
)
CONFIG = MartConfig(as_of=AS_OF, seller_tiers=SAMPLE_TIERS)

# All days with orders.
FULL_CALENDAR = (date(1995, 1, 1), AS_OF)


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as midnights, so that engines compare by value."""
    columns = []
    for item in df.schema:
        column = F.col(item.name)
        if isinstance(item.dataType, DecimalType):
            column = column.cast("double").alias(item.name)
        elif isinstance(item.dataType, DateType):
            column = column.cast("timestamp_ntz").alias(item.name)
        columns.append(column)
    return df.select(*columns)


def relations(spark: SparkSession, sf_dir: str) -> Relations:
    return Relations(SampleTables(prepare(spark), sf_dir), CONFIG)


REGISTRY: dict[str, Query] = {}


def query(name: str) -> Callable:
    """Register a function of the relations."""

    def register(build: Callable[[Relations], DataFrame]) -> Callable[[Relations], DataFrame]:
        REGISTRY[name] = lambda spark, sf_dir: comparable(build(relations(spark, sf_dir)))
        return build

    return register


def table_query(name: str) -> Callable:
    """Register a function of the session and the sample directory."""

    def register(build: Query) -> Query:
        REGISTRY[name] = lambda spark, sf_dir: comparable(build(spark, sf_dir))
        return build

    return register


def _register_relations() -> None:
    """The relations that are queries as they are."""
    names = (
        "stg_orders", "stg_order_items", "stg_order_payments", "stg_order_reviews",
        "stg_customers", "stg_sellers", "stg_products",
        "order_items_agg", "order_payments_agg", "seller_order_items", "seller_order_detail",
        "dim_products", "dim_sellers", "dim_customers", "fct_order_items", "fct_order_payments",
        "fct_order_reviews", "order_revenue", "seller_performance", "customer_segmentation",
    )
    for name in names:
        query(name)(attrgetter(name))


_register_relations()


@query("order_items_agg_from_fact")
def order_items_agg_from_fact(r: Relations) -> DataFrame:
    """The order roll-up over the item fact, so without lines of unknown orders."""
    return rollups.order_items_agg(r.fct_order_items)


@query("seller_order_items_from_fact")
def seller_order_items_from_fact(r: Relations) -> DataFrame:
    """The roll-up by seller and order over the item fact, without lines of unknown orders."""
    return rollups.seller_order_items(r.fct_order_items)


# The seed is a fixed small table, so its queries meet it with the product table.


@query("stg_translations")
def stg_translations(r: Relations) -> DataFrame:
    """Every product with the translation row of its category, if there is one."""
    known = F.col("product_category_name") == F.col("product_category_name_pt")
    return r.stg_products.join(r.stg_translations, known, "left").select(
        "product_id", "product_category_name_pt", "product_category_name_en"
    )


@query("seed_scan")
def seed_scan(r: Relations) -> DataFrame:
    """Products per seed row."""
    counts = r.raw.products.groupBy("product_category_name").agg(F.count(F.lit(1)).alias("n"))
    return r.raw.translations.join(counts, "product_category_name", "left").select(
        "product_category_name",
        "product_category_name_english",
        F.coalesce("n", F.lit(0)).alias("products"),
    )


# Sources and sinks


@table_query("scan_source")
def scan_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_table(spark, sf_dir, "orders")


@table_query("scan_csv_source")
def scan_csv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with free text, through CSV and back."""
    notes = ["null", "''", r"'\\N'", "'say \"hi\", ok'", r"concat('line 1\n', 'line 2, ', c_name)", "concat(' ', c_name, ' ')"]
    cases = " ".join(f"when {k} then {note}" for k, note in enumerate(notes))
    noted = sample_table(spark, sf_dir, "customer").withColumn("note", F.expr(f"case c_custkey % 6 {cases} end"))
    return materialize_table(noted, fresh_path(spark, "customer-csv"), "csv")


@table_query("materialize_table")
def materialize_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize_table(
        relations(spark, sf_dir).order_items_agg, fresh_path(spark, "order_items_agg")
    )


@table_query("materialize_view")
def materialize_view_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = materialize_view(relations(spark, sf_dir).order_payments_agg, "order_payments_agg")
    return view.select("order_id", "total_payment", "payment_types")


# Expressions


@table_query("cast_timestamp_ntz")
def cast_timestamp_ntz(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = sample_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("string").alias("placed")
    )
    return text.select(
        F.col("o_orderkey").alias("order_id"), to_timestamp_ntz(F.col("placed")).alias("ordered_at")
    )


@table_query("cast_decimal")
def cast_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        to_money(F.col("l_extendedprice")).alias("price"),
        to_money(F.col("l_tax")).alias("tax"),
    )


@table_query("cast_integer")
def cast_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), to_whole(F.col("o_totalprice")).alias("whole_price")
    )


@table_query("safe_divide")
def safe_divide_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        safe_divide(F.col("l_extendedprice"), F.col("l_linenumber") - 1).alias("ratio"),
    )


@query("classify_tier")
def classify_tier_query(r: Relations) -> DataFrame:
    delta = F.col("revenue_freight_delta")
    return r.order_revenue.select(
        "order_id",
        classify_tier(F.col("total_item_revenue"), SELLER_TIERS).alias("revenue_tier"),
        classify_tier(delta, SELLER_TIERS).alias("delta_tier"),
    )


@query("delivery_flags")
def delivery_flags(r: Relations) -> DataFrame:
    return r.fct_order_items.select("order_item_sk", "is_delivered", "is_on_time", "days_to_deliver")


@query("product_volume")
def product_volume(r: Relations) -> DataFrame:
    return r.stg_products.select("product_id", core.product_volume().alias("product_volume_cm3"))


@query("surrogate_key")
def surrogate_key_query(r: Relations) -> DataFrame:
    return r.stg_order_items.select(
        surrogate_key(F.col("order_id"), F.col("order_item_id")).alias("order_item_sk")
    )


@query("surrogate_key_md5")
def surrogate_key_md5(r: Relations) -> DataFrame:
    return r.stg_order_items.select(
        hashed_key(F.col("order_id"), F.col("order_item_id")).alias("order_item_hash")
    )


@query("days_between")
def days_between_query(r: Relations) -> DataFrame:
    return r.stg_orders.select(
        "order_id",
        days_between(F.col("ordered_at"), F.col("delivered_at")).alias("days_to_deliver"),
        days_between(F.col("delivered_at"), F.col("ordered_at")).alias("days_back"),
    )


@query("recency_days")
def recency_days(r: Relations) -> DataFrame:
    return r.stg_orders.select(
        "order_id", days_between(F.col("ordered_at"), as_of_date(AS_OF)).alias("days_since_order")
    )


@query("revenue_delta")
def revenue_delta(r: Relations) -> DataFrame:
    return r.order_revenue.select("order_id", "revenue_freight_delta")


@query("is_repeat_buyer")
def is_repeat_buyer(r: Relations) -> DataFrame:
    return r.customer_segmentation.select("customer_unique_id", "lifetime_orders", "is_repeat_buyer")


# Filters and joins


@query("filter_delivered")
def filter_delivered(r: Relations) -> DataFrame:
    return r.stg_orders.where(core.is_delivered()).select("order_id", "customer_id", "delivered_at")


@query("join_inner_items_orders")
def join_inner_items_orders(r: Relations) -> DataFrame:
    return r.stg_order_items.join(r.stg_orders, "order_id").select(
        "order_id", "order_item_id", "customer_id", "order_status"
    )


@table_query("dedup_latest")
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = sample_table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return latest_per_key(events, keys=["user_id"], order_by="ts", tiebreak=["event_id"])


# Aggregates


@query("review_score_by_order")
def review_score_by_order(r: Relations) -> DataFrame:
    return r.order_reviews_agg.select("order_id", "review_rows", "avg_review_score")


@query("agg_conditional_count")
def agg_conditional_count(r: Relations) -> DataFrame:
    return r.stg_orders.groupBy("customer_id").agg(
        F.count("order_id").alias("orders"),
        F.count_if(core.is_delivered()).alias("delivered_orders"),
        F.count_if(core.is_on_time()).alias("on_time_orders"),
    )


@query("avg_of_order_avgs")
def avg_of_order_avgs(r: Relations) -> DataFrame:
    scored = r.stg_orders.join(r.order_reviews_agg, "order_id")
    mean = exact_mean(F.sum("avg_review_score"), F.count("avg_review_score"))
    return scored.groupBy("customer_id").agg(mean.alias("avg_review_score"))


@query("first_last_activity")
def first_last_activity(r: Relations) -> DataFrame:
    return r.stg_orders.groupBy("customer_id").agg(
        F.min("ordered_at").alias("first_order_at"), F.max("ordered_at").alias("last_order_at")
    )


@query("customer_representative_location")
def customer_representative_location(r: Relations) -> DataFrame:
    return r.stg_customers.groupBy("customer_unique_id").agg(
        F.max("customer_city").alias("customer_city"), F.max("customer_state").alias("customer_state")
    )


@query("distinct_customers")
def distinct_customers(r: Relations) -> DataFrame:
    return r.fct_by_order.select("customer_id").distinct()


@query("daily_orders_by_customer")
def daily_orders_by_customer(r: Relations) -> DataFrame:
    return marketing.daily_orders(r.fct_by_order, "customer_id")


@query("seller_performance_reconciled")
def seller_performance_reconciled(r: Relations) -> DataFrame:
    return r.sellers_by("per_order")


# Calendars


@query("date_spine")
def date_spine_query(r: Relations) -> DataFrame:
    """Every calendar day with its orders."""
    spine = date_spine(r.raw.orders.sparkSession, *FULL_CALENDAR)
    placed = r.stg_orders.groupBy(F.to_date("ordered_at").alias("date_day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return spine.join(placed, "date_day", "left").select(
        "date_day", F.coalesce("n", F.lit(0)).alias("orders")
    )


@query("dim_dates")
def dim_dates(r: Relations) -> DataFrame:
    """The date dimension with the revenue ordered on each date."""
    dates = metrics.dim_dates(date_spine(r.raw.orders.sparkSession, *FULL_CALENDAR))
    revenue = r.order_revenue.groupBy(F.to_date("order_purchase_at").alias("date_day")).agg(
        F.sum("total_item_revenue").alias("gmv")
    )
    return dates.join(revenue, "date_day", "left")


@query("densify_calendar")
def densify_calendar_query(r: Relations) -> DataFrame:
    daily = marketing.daily_orders(r.fct_order_items, "seller_id")
    return densify_calendar(
        daily, "seller_id", "order_date", ["orders_placed", "gmv"], *FULL_CALENDAR, flag="had_order"
    )


@query("customer_order_dates")
def customer_order_dates(r: Relations) -> DataFrame:
    return marketing.customer_order_dates(r.fct_by_order, *FULL_CALENDAR)


# Status history


def _initial(r: Relations) -> DataFrame:
    return h.open_versions(status_run_1(r.raw.orders), h.ORDER_STATUS, RUN_1)


def _second(r: Relations) -> DataFrame:
    return h.scd2_apply(_initial(r), status_run_2(r.raw.orders), h.ORDER_STATUS, RUN_2)


@query("scd2_initial")
def scd2_initial(r: Relations) -> DataFrame:
    """Every order as an open version, as after a first run over the whole source."""
    return h.open_versions(order_versions(r.raw.orders), h.ORDER_STATUS, RUN_1)


@query("scd2_second_run")
def scd2_second_run(r: Relations) -> DataFrame:
    return _second(r)


@query("scd2_current")
def scd2_current(r: Relations) -> DataFrame:
    return h.current_versions(_second(r))


@query("scd2_timestamp")
def scd2_timestamp(r: Relations) -> DataFrame:
    """Versions dated by a column: delivered orders change a day after they were placed."""
    spec = h.HistorySpec(key="order_id", updated_at="changed_at")
    first = r.raw.orders.select(
        "order_id", "order_status", F.col("order_purchase_timestamp").alias("changed_at")
    )
    bumped = F.when(
        F.col("order_status") == "Delivered", F.expr("changed_at + interval 1 day")
    ).otherwise(F.col("changed_at"))
    second = first.withColumn("changed_at", bumped)
    return h.scd2_apply(h.open_versions(first, spec, RUN_1), second, spec, RUN_2)


@query("orders_status_snapshot")
def orders_status_snapshot(r: Relations) -> DataFrame:
    """The stored history after three runs, the last of which changes nothing."""
    root = fresh_path(r.raw.orders.sparkSession, "orders_status_snapshot")
    h.snapshot(status_run_1(r.raw.orders), root, h.ORDER_STATUS, RUN_1)
    h.snapshot(status_run_2(r.raw.orders), root, h.ORDER_STATUS, RUN_2)
    return h.snapshot(status_run_2(r.raw.orders), root, h.ORDER_STATUS, NOW)


# Every user's events as a change log: many changes of a key in one run.

EVENT_LOG = changelog.LogSpec(key="user_id", at="ts", state=("event_type",))
FEED_DELAY = "6 hours"


def _event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_table(prepare(spark), sf_dir, "events").select("user_id", "ts", "event_type")


def _event_feed(spark: SparkSession, sf_dir: str, files: int) -> tuple[DataFrame, str]:
    """The log as files of a stream, its rows dealt without regard to their instants."""
    folder = fresh_path(spark, "feed")
    log = _event_log(spark, sf_dir)
    log.repartition(files, F.xxhash64("user_id", "ts", "event_type")).write.parquet(f"{folder}/rows")
    return spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/rows"), folder


@table_query("change_log_versions")
def change_log_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.versions_of(_event_log(spark, sf_dir), EVENT_LOG)


@table_query("late_rows_spliced")
def late_rows_spliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs that hold all rows between them, the latest third of each day first: every run but
    the first cuts stored pieces. A base is written after the second."""
    log, root = _event_log(spark, sf_dir), fresh_path(spark, "spliced")
    third = F.floor(F.hour("ts") / 8)
    for run, part in enumerate((2, 0, 1)):
        changelog.apply_rows(spark, log.where(F.coalesce(third, F.lit(0)) == part), root, EVENT_LOG, run=f"{run:03d}")
        if run == 1:
            changelog.compact(spark, root, EVENT_LOG)
    return changelog.read_versions(spark, root, EVENT_LOG)


@table_query("feed_versions")
def feed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history that a stream of unordered files leaves, a micro-batch per file."""
    feed, folder = _event_feed(prepare(spark), sf_dir, files=3)
    follow_log(feed, f"{folder}/log", f"{folder}/checkpoint", EVENT_LOG, compact_every=2).awaitTermination()
    return changelog.read_versions(spark, f"{folder}/log", EVENT_LOG)


@table_query("feed_changes")
def feed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes given out by the stateful stream, up to its watermark."""
    feed, folder = _event_feed(prepare(spark), sf_dir, files=1)
    changes = changes_in_time(feed, EVENT_LOG, FEED_DELAY)
    write_changes(changes, f"{folder}/changes", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(changes.schema).parquet(f"{folder}/changes")


@query("time_in_status")
def time_in_status(r: Relations) -> DataFrame:
    return h.time_in_status(_second(r), NOW)


@query("status_transitions")
def status_transitions(r: Relations) -> DataFrame:
    return h.status_transitions(_second(r))


@query("avg_time_per_status")
def avg_time_per_status(r: Relations) -> DataFrame:
    return metrics.avg_time_per_status(h.time_in_status(_second(r), NOW))


# Changes, instants and running counts


def _orders_before(r: Relations) -> DataFrame:
    """The raw orders at a first run: the newest absent, some statuses early or unknown."""
    early = "case when order_id % 25 = 0 then null when order_id % 4 = 0 then 'created' else order_status end"
    known = F.col("order_purchase_timestamp") < F.lit(RUN_1_ENDS).cast("timestamp_ntz")
    return r.raw.orders.where(known).withColumn("order_status", F.expr(early))


def _orders_after(r: Relations) -> DataFrame:
    """Those of a second run: statuses final, the oldest orders gone."""
    return r.raw.orders.where(F.col("order_purchase_timestamp") >= F.lit(RUN_2_STARTS).cast("timestamp_ntz"))


@query("seller_performance_by_changes")
def seller_performance_by_changes(r: Relations) -> DataFrame:
    """Sellers after two runs: all orders first, then only those that changed."""
    spark, spec = r.raw.orders.sparkSession, core.SELLER_TOTALS
    root = fresh_path(spark, "seller-totals")
    roles = {role: getattr(r.raw, role) for role in RAW_SCHEMAS}
    before, after = (
        Relations(SimpleNamespace(**roles | {"orders": orders}), CONFIG)
        for orders in (_orders_before(r), _orders_after(r))
    )
    all_keys = before.raw.orders.select("order_id")
    first = core.seller_contributions(before.with_known_lines().seller_order_detail)
    deltas.apply_changes(spark, root, spec, all_keys, first, "1")
    found = deltas.changed_keys(before.raw.orders, after.raw.orders, "order_id")
    changed = materialize_table(found, fresh_path(spark, "changed-orders"))
    now = core.seller_contributions(after.of_orders(changed).seller_order_detail)
    deltas.apply_changes(spark, root, spec, changed, now, "2")
    return core.seller_performance_from(deltas.stored_totals(spark, root, spec), r.stg_sellers, SAMPLE_TIERS)


@table_query("events_as_of_state")
def events_as_of_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event that is not a click with the page state of its user's last click or view then."""
    events = sample_table(prepare(spark), sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    seen = F.col("event_type").isin("click", "view")
    states = events.where(seen).select("user_id", "ts", F.col("event_type").alias("last_seen"), F.col("event_id").alias("last_id"))
    others = events.where(~seen | F.col("event_type").isNull())
    return asof_join(others, states, "user_id", "ts", ["last_seen", "last_id"])


@query("distinct_customers_by_period")
def distinct_customers_by_period(r: Relations) -> DataFrame:
    """Customers with an order, by week and month, from one daily table of bitmaps."""
    daily = actives.daily_bitmaps(r.stg_orders, F.col("ordered_at"), F.col("customer_id"))
    daily = materialize_table(daily, fresh_path(r.raw.orders.sparkSession, "daily-customers"))
    found = [
        actives.distinct_by(daily, F.to_date(F.date_trunc(unit, "day"))).select(F.lit(unit).alias("unit"), "period", "distinct_count")
        for unit in ("week", "month")
    ]
    return found[0].unionByName(found[1])


@query("active_customers_30d")
def active_customers_30d(r: Relations) -> DataFrame:
    """Customers with an order in the last 30 days, for every day of the calendar."""
    return actives.active_entities(r.stg_orders, "customer_id", F.col("ordered_at"), 30, *FULL_CALENDAR)


# Data quality


@query("dq_unique")
def dq_unique(r: Relations) -> DataFrame:
    extra = [q.check_unique(r.raw.order_reviews, "raw_order_reviews", "review_id")]
    return q.all_of([contracts.unique_checks(r), *extra])


@query("dq_not_null")
def dq_not_null(r: Relations) -> DataFrame:
    extra = q.check_rows(
        r.stg_orders, "stg_orders", [q.not_null("shipped_at"), q.not_null("delivered_at")]
    )
    return q.all_of([contracts.not_null_checks(r), extra])


@query("dq_accepted_values")
def dq_accepted_values(r: Relations) -> DataFrame:
    history = q.check_rows(
        _second(r), "status_history", [q.accepted_values("order_status", ORDER_STATUSES)]
    )
    return q.all_of([contracts.accepted_values_checks(r), history])


@query("dq_range")
def dq_range(r: Relations) -> DataFrame:
    return contracts.range_checks(r, contracts.Fact(r.fct_by_order, "lines"))


@query("dq_conditional_null")
def dq_conditional_null(r: Relations) -> DataFrame:
    return contracts.nullness_checks(r, contracts.Fact(r.fct_by_order, "lines"))


@query("dq_orphans")
def dq_orphans(r: Relations) -> DataFrame:
    fact = contracts.Fact(r.fct_by_order_product, "lines")
    return contracts.orphan_checks(r, fact, history=_second(r))


@query("dq_row_count_match")
def dq_row_count_match(r: Relations) -> DataFrame:
    return contracts.row_count_checks(r, _second(r), contracts.Fact(r.fct_by_order, "lines"))


@query("dq_reconcile")
def dq_reconcile(r: Relations) -> DataFrame:
    return contracts.reconciliation_checks(r)


@query("dq_share_threshold")
def dq_share_threshold(r: Relations) -> DataFrame:
    return contracts.share_checks(r)


@query("dq_scd2_intervals")
def dq_scd2_intervals(r: Relations) -> DataFrame:
    return q.check_intervals(_second(r), "status_history", "order_id")


@query("dq_freshness")
def dq_freshness(r: Relations) -> DataFrame:
    return contracts.freshness_checks(r, NOW)


def _where_different(spark: SparkSession, left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The keys on which two relations differ, found by their checksum trees."""
    left, right = (reconcile.store(df, fresh_path(spark, "tree"), [key], 12) for df in (left, right))
    found = reconcile.differences(spark, left, right)
    return found.withColumn("differing", F.array_join("differing", ","))


@query("dq_reconcile_sellers")
def dq_reconcile_sellers(r: Relations) -> DataFrame:
    """The sellers whose figures differ if an order counts once per review or once in all."""
    columns = ["seller_id", "total_orders", "total_items_sold", "total_gmv", "total_freight_charged", "seller_tier"]
    left, right = r.seller_performance.select(*columns), r.sellers_by("per_order").select(*columns)
    return _where_different(r.raw.orders.sparkSession, left, right, "seller_id")


@query("dq_reconcile_runs")
def dq_reconcile_runs(r: Relations) -> DataFrame:
    """The orders that differ between two states of the source, and in what."""
    columns = ["order_id", "customer_id", "order_status", "ordered_at", "approved_at"]
    left, right = (run(r.raw.orders).select(*columns) for run in (status_run_1, status_run_2))
    return _where_different(r.raw.orders.sparkSession, left, right, "order_id")


# Lines with faults: a price and a day that are none, a missing customer, a value too many.
FAULTY_LINES = """concat_ws(',', o_orderkey, if(o_orderkey % 29 = 0, '', cast(o_custkey as string)), o_orderstatus,
    if(o_orderkey % 17 = 0, 'n/a', cast(o_totalprice as string)),
    if(o_orderkey % 23 = 0, '1996-13-45', cast(o_orderdate as string)), o_orderpriority,
    if(o_orderkey % 31 = 0, 'surplus', null))"""


def _faulty_orders(spark: SparkSession, sf_dir: str) -> Sorted:
    path = fresh_path(spark, "lines")
    sample_table(prepare(spark), sf_dir, "orders").selectExpr(f"{FAULTY_LINES} as line").write.text(path)
    return load_sorted(
        spark, path, SAMPLE_SCHEMAS["orders"], fresh_path(spark, "sorted"), required=["o_custkey"], max_share=0.25, header=False
    )


@table_query("quarantine_good")
def quarantine_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read from text of which some lines are faulty: the good ones, typed."""
    return _faulty_orders(spark, sf_dir).good


@table_query("quarantine_rejected")
def quarantine_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faulty lines of the same text with their reasons."""
    rejected = _faulty_orders(spark, sf_dir).rejected
    return rejected.select(F.col("o_orderkey").cast("bigint"), F.array_join("reasons", "; ").alias("reasons"))


# Metrics


@query("metric_gmv")
def metric_gmv(r: Relations) -> DataFrame:
    return metrics.gmv(r.order_revenue)


@query("metric_aov")
def metric_aov(r: Relations) -> DataFrame:
    return metrics.average_order_value(r.order_revenue)


@query("metric_freight_ratio")
def metric_freight_ratio(r: Relations) -> DataFrame:
    return metrics.freight_ratio(r.order_revenue, CONFIG.freight_flag)


@query("metric_fact_totals")
def metric_fact_totals(r: Relations) -> DataFrame:
    return metrics.fact_totals(r.fct_by_order)


@query("metric_on_time_rate")
def metric_on_time_rate(r: Relations) -> DataFrame:
    return metrics.on_time_rate(r.fct_by_order, lines="lines")


@query("metric_avg_days")
def metric_avg_days(r: Relations) -> DataFrame:
    return metrics.average_days_to_deliver(r.fct_by_order, lines="lines")


@query("items_per_order")
def items_per_order(r: Relations) -> DataFrame:
    return metrics.items_per_order(r.stg_order_items, r.stg_orders)


def _category_totals(r: Relations) -> DataFrame:
    return metrics.category_totals(r.fct_order_items, r.dim_products)


@query("category_gmv")
def category_gmv(r: Relations) -> DataFrame:
    return metrics.category_gmv(_category_totals(r))


@query("category_avg_weight")
def category_avg_weight(r: Relations) -> DataFrame:
    totals = metrics.category_totals(r.fct_by_order_product, r.dim_products, lines="lines", overall=True)
    return metrics.category_avg_weight(totals)


@query("category_freight_ratio")
def category_freight_ratio(r: Relations) -> DataFrame:
    return metrics.category_freight_ratio(_category_totals(r))


@query("weight_delivery_corr")
def weight_delivery_corr(r: Relations) -> DataFrame:
    return metrics.weight_delivery_corr(r.fct_by_order_product, r.dim_products, lines="lines")


@query("metric_seller_rollup")
def metric_seller_rollup(r: Relations) -> DataFrame:
    reported = core.seller_performance(
        r.seller_order_detail.where(metrics.is_reported()), r.stg_sellers, CONFIG.seller_tiers
    )
    return metrics.seller_rollup(reported)


@query("tier_distribution")
def tier_distribution(r: Relations) -> DataFrame:
    return metrics.tier_distribution(r.seller_performance)


@query("underperforming_sellers")
def underperforming_sellers(r: Relations) -> DataFrame:
    return metrics.underperforming_sellers(r.seller_performance)


@query("seller_stuck_rate")
def seller_stuck_rate(r: Relations) -> DataFrame:
    return metrics.seller_stuck_rate(r.seller_order_detail)


@query("customer_rfm")
def customer_rfm(r: Relations) -> DataFrame:
    return metrics.customer_rfm(r.customer_segmentation)


@query("product_performance")
def product_performance(r: Relations) -> DataFrame:
    return metrics.product_performance(r.stg_order_items, r.order_summary, r.dim_products)


@query("seller_fulfillment")
def seller_fulfillment(r: Relations) -> DataFrame:
    return metrics.seller_fulfillment(r.seller_order_items, r.stg_orders)
