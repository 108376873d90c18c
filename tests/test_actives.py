"""Distinct counts from bitmaps and running counts beside brute force."""

from __future__ import annotations

import random
import re
from datetime import date, timedelta

from pyspark.sql import functions as F

from bazaarline.operators import actives as a
from bazaarline.sources.writers import fresh_path

START = date(2024, 1, 1)


def rows_of(seed: int) -> list:
    draw = random.Random(seed)
    # Numbers of several buckets, a hot one, and nulls.
    number = lambda: draw.choice([7, 7, 7, None, -5, 40_000, 70_001, draw.randint(-100_000, 100_000)])
    return [(number(), draw.choice([None, *(START + timedelta(days=n) for n in range(90))])) for _ in range(400)]


def test_distinct_counts_of_periods_from_daily_bitmaps(spark):
    rows = rows_of(1)
    df = spark.createDataFrame(rows, "id bigint, day date")
    daily = a.daily_bitmaps(df, F.col("day"), F.col("id"))
    got = {r["period"]: r["distinct_count"] for r in a.distinct_by(daily, F.trunc("day", "month")).collect()}
    want: dict = {}
    for number, day in rows:
        if number is not None and day is not None:
            want.setdefault(day.replace(day=1), set()).add(number)
    assert got == {month: len(found) for month, found in want.items()}


def test_texts_get_numbers(spark):
    rows = spark.createDataFrame([("x", START), ("y", START), ("x", START + timedelta(days=1)), (None, START)], "id string, day date")
    keys = a.numbered(rows, "id", fresh_path(spark, "numbers"))
    daily = a.daily_bitmaps(rows.join(keys, "id", "left"), F.col("day"), F.col("number"))
    assert [r["distinct_count"] for r in a.distinct_by(daily, F.lit("all")).collect()] == [2]


def test_active_entities_of_the_last_days(spark):
    for seed, days in ((2, 1), (3, 30)):
        rows = rows_of(seed)
        end = START + timedelta(days=100)
        first = START + timedelta(days=20)
        df = spark.createDataFrame(rows, "id bigint, day date")
        got = {r["date_day"]: r["active"] for r in a.active_entities(df, "id", F.col("day"), days, first, end).collect()}
        for n in range((end - first).days):
            day = first + timedelta(days=n)
            seen = {i for i, d in rows if i is not None and d is not None and day - timedelta(days=days) < d <= day}
            assert got.pop(day) == len(seen)
        assert not got


def test_no_rows(spark):
    empty = spark.createDataFrame([], "id bigint, day date")
    assert a.daily_bitmaps(empty, F.col("day"), F.col("id")).count() == 0
    got = a.active_entities(empty, "id", F.col("day"), 30, START, START + timedelta(days=2)).collect()
    assert [r["active"] for r in got] == [0, 0]


def test_sums_over_blocks_with_gaps(spark):
    days = [0, 1, 2, 7, 8, 30, 31, 32, 33, 64, 100, 1000]
    rows = spark.createDataFrame([(n, n % 5 - 1) for n in days], "at int, v int").repartition(3)
    got = a.prefix_sums(rows, "at", "v", F.expr("at div 4"))
    assert {r["at"]: r["v"] for r in got.collect()} == {n: sum(m % 5 - 1 for m in days if m <= n) for n in days}
    windows = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Window [" in line]
    # Functions, partition keys, order: a window without keys prints only two lists.
    assert windows and all(re.search(r"\], \[[^\[\]]+\], \[[^\[\]]+\]$", line) for line in windows)
