from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bazaarline.config import SELLER_TIERS, Tier
from bazaarline.functions import (
    as_of_date,
    classify_tier,
    days_between,
    exact_mean,
    hashed_key,
    hours_between,
    ordered_distinct_list,
    safe_divide,
    surrogate_key,
    to_money,
    to_timestamp_ntz,
    to_whole,
)


def values(df, expression):
    return [row[0] for row in df.select(expression).collect()]


def test_safe_divide(spark):
    df = spark.createDataFrame(
        [(1, 2), (1, 0), (1, None), (None, 2), (3, -2), (None, 0)], "n int, d int"
    )
    assert values(df, safe_divide(F.col("n"), F.col("d"))) == [0.5, None, None, None, -1.5, None]


def test_safe_divide_casts_the_whole_numerator(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert values(df, safe_divide(F.col("a") + F.col("b"), F.lit(2))) == [1.5]


def test_classify_tier_edges(spark):
    amounts = ["50000", "49999.99", "10000", "9999.99", "1000", "999.99", "0", "-0.01", None]
    df = spark.createDataFrame(
        [(None if a is None else Decimal(a),) for a in amounts], "v decimal(12,2)"
    )
    assert values(df, classify_tier(F.col("v"), SELLER_TIERS)) == [
        "platinum", "gold", "gold", "silver", "silver", "bronze", "bronze",
        "unclassified", "unclassified",
    ]


def test_classify_tier_takes_the_first_match(spark):
    df = spark.createDataFrame([(100,)], "v int")
    wrong_order = [Tier(1, "low"), Tier(50, "high")]
    assert values(df, classify_tier(F.col("v"), wrong_order)) == ["low"]
    assert values(df, classify_tier(F.col("v"), [], default="none")) == ["none"]


def test_days_between_counts_midnights(spark):
    df = spark.createDataFrame(
        [
            (datetime(2024, 2, 28, 23), datetime(2024, 2, 29, 1)),
            (datetime(2024, 2, 28, 0), datetime(2024, 2, 28, 23)),
            (datetime(2024, 3, 1), datetime(2024, 2, 28)),
            (None, datetime(2024, 3, 1)),
        ],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert values(df, days_between(F.col("a"), F.col("b"))) == [1, 0, -2, None]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
def test_time_functions_ignore_the_session_zone(spark, settings, zone):
    settings(spark__sql__session__timeZone=zone)
    # The clocks of Sao Paulo jumped over midnight on 2018-11-04.
    df = spark.createDataFrame(
        [
            (datetime(2018, 11, 3, 10, 59), datetime(2018, 11, 3, 11, 1)),
            (datetime(2018, 11, 3, 22, 0), datetime(2018, 11, 4, 2, 30)),
        ],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert values(df, hours_between(F.col("a"), F.col("b"))) == [1, 4]
    assert values(df, days_between(F.col("a"), F.col("b"))) == [0, 1]


def test_casts(spark):
    df = spark.createDataFrame([("2.5", "2018-01-02 03:04:05"), ("-2.5", None)], "n string, t string")
    assert values(df, to_whole(F.col("n"))) == [3, -3]
    assert values(df, to_money(F.col("n"))) == [Decimal("2.50"), Decimal("-2.50")]
    assert values(df, to_timestamp_ntz(F.col("t"))) == [datetime(2018, 1, 2, 3, 4, 5), None]
    assert values(df, to_money(F.col("t"), strict=False)) == [None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(df, to_timestamp_ntz(F.col("n")))
    assert values(df, to_timestamp_ntz(F.col("n"), strict=False)) == [None, None]


def test_exact_mean(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", None)], "k string, v int")
    means = df.groupBy("k").agg(exact_mean(F.sum("v"), F.count("v")).alias("m"))
    assert dict(means.collect()) == {"a": Decimal("1.666667"), "b": None}


def test_keys_are_null_if_a_part_is(spark):
    df = spark.createDataFrame([("o1", 2), ("o1", None), (None, 1)], "a string, b int")
    assert values(df, surrogate_key(F.col("a"), F.col("b"))) == ["o1-2", None, None]
    assert values(df, hashed_key(F.col("a"), F.col("b")))[1:] == [None, None]


def test_ordered_distinct_list(spark):
    df = spark.createDataFrame(
        [("a", "voucher"), ("a", "boleto"), ("a", "voucher"), ("a", None), ("b", None)],
        "k string, v string",
    )
    lists = df.groupBy("k").agg(ordered_distinct_list(F.col("v")).alias("l"))
    assert dict(lists.collect()) == {"a": "boleto, voucher", "b": ""}


def test_as_of_date(spark):
    df = spark.range(1)
    assert values(df, as_of_date(date(2020, 1, 2))) == [date(2020, 1, 2)]
    assert values(df, as_of_date(None) == F.current_date()) == [True]
