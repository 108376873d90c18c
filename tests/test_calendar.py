from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from bazaarline.operators.calendar import date_spine, densify_calendar
from bazaarline.plans.marketing import customer_order_dates, daily_orders

START, END = date(2024, 2, 27), date(2024, 3, 2)
DAYS = [date(2024, 2, 27), date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]


def test_date_spine_ends_before_end(spark, rows):
    assert rows(date_spine(spark, START, END)) == [(day,) for day in DAYS]
    assert rows(date_spine(spark, START, date(2024, 2, 28))) == [(START,)]
    assert rows(date_spine(spark, START, START)) == []
    assert rows(date_spine(spark, END, START)) == []


def dense(daily, **options):
    return densify_calendar(daily, "who", "day", ["n", "amount"], START, END, **options)


def daily(spark, data):
    return spark.createDataFrame(
        [(who, day, n, None if amount is None else Decimal(amount)) for who, day, n, amount in data],
        "who string, day date, n bigint, amount decimal(12,2)",
    )


def test_every_entity_has_every_day(spark):
    df = daily(
        spark,
        [
            ("first", DAYS[0], 1, "1.00"),
            ("last", DAYS[3], 2, "2.00"),
            ("both", DAYS[1], 3, "3.00"),
            ("both", DAYS[2], 4, None),
            ("early", date(2024, 1, 1), 5, "5.00"),
            ("early", date(2024, 1, 2), 5, "5.00"),
            ("edges", date(2024, 2, 26), 6, "6.00"),
            ("edges", DAYS[2], 7, "7.00"),
            ("edges", END, 8, "8.00"),
            ("unknown", None, 9, "9.00"),
        ],
    )
    found = {}
    for row in dense(df).collect():
        found.setdefault(row.who, []).append((row.date_day, row.n, row.amount, row.had_order))
    assert all([day for day, *_ in values] == DAYS for values in found.values())
    active = {
        who: [(DAYS.index(d), n, amount) for d, n, amount, had in values if had]
        for who, values in found.items()
    }
    assert active == {
        "first": [(0, 1, Decimal("1.00"))],
        "last": [(3, 2, Decimal("2.00"))],
        "both": [(1, 3, Decimal("3.00")), (2, 4, Decimal("0.00"))],
        "early": [],
        "edges": [(2, 7, Decimal("7.00"))],
        "unknown": [],
    }
    idle = [v for values in found.values() for v in values if not v[3]]
    assert all((n, amount) == (0, Decimal("0.00")) for _, n, amount, _ in idle)


def test_null_entity_stays_with_idle_days(spark, rows):
    result = rows(dense(daily(spark, [(None, DAYS[1], 3, "3.00")])))
    assert [row[1:3] for row in result] == [(day, 0) for day in DAYS]
    assert not any(row[4] for row in result)


def test_empty_input_and_empty_calendar(spark):
    assert dense(daily(spark, [])).count() == 0
    one = daily(spark, [("a", DAYS[0], 1, "1.00")])
    assert densify_calendar(one, "who", "day", ["n", "amount"], START, START).count() == 0


def test_schema_keeps_measure_types(spark):
    schema = dense(daily(spark, [])).schema
    assert [f.dataType.simpleString() for f in schema] == [
        "string", "date", "bigint", "decimal(12,2)", "boolean",
    ]


def test_result_is_ordered_without_sorting_the_grid(spark):
    df = spark.range(500).selectExpr(
        "cast(id % 97 as string) as who", "date_add(date'2024-02-20', cast(id % 16 as int)) as day"
    )
    df = df.distinct().withColumns({"n": F.lit(1).cast("bigint"), "amount": F.lit(1).cast("decimal(12,2)")})
    result = dense(df, partitions=5)
    keys = [(row.who, row.date_day) for row in result.collect()]
    assert keys == sorted(keys) and len(keys) == 97 * len(DAYS)
    # Only daily rows are exchanged: no exchange and no sort above the generator.
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan
    above = plan[plan.index("Initial Plan") if "Initial Plan" in plan else 0 :].split("Generate")[0]
    assert "Exchange" not in above and "Sort" not in above


def test_customer_order_dates_against_a_grid_join(spark, rows):
    fact = spark.createDataFrame(
        [
            ("a", "o1", datetime(2024, 2, 28, 23), Decimal("1.10")),
            ("a", "o1", datetime(2024, 2, 28, 23), Decimal("2.20")),
            ("a", "o2", datetime(2024, 2, 28, 1), Decimal("3.30")),
            ("b", "o3", datetime(2023, 2, 28, 1), Decimal("4.40")),
        ],
        "customer_id string, order_id string, ordered_at timestamp_ntz, item_price decimal(12,2)",
    )
    daily_rows = daily_orders(fact, "customer_id").withColumnRenamed("order_date", "date_day")
    grid = (
        fact.select("customer_id")
        .distinct()
        .join(date_spine(spark, START, END), F.lit(True))
        .join(daily_rows, ["customer_id", "date_day"], "left")
        .select(
            "customer_id",
            "date_day",
            F.coalesce("orders_placed", F.lit(0)),
            F.coalesce("gmv", F.lit(0)),
            F.col("orders_placed").isNotNull(),
        )
    )
    assert rows(customer_order_dates(fact, START, END)) == rows(grid)
