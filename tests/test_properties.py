"""Operators against plain Python models on seeded random data.

All cases of a test run as one data set, told apart by a case number in the key.
"""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

from bazaarline.operators import history as h
from bazaarline.operators.calendar import densify_calendar
from bazaarline.operators.latest import latest_per_key

T0 = datetime(2024, 1, 1)
STATUSES = ["created", "shipped", "delivered", None]


def test_history_of_random_runs(spark, tmp_path):
    """Six runs; every key appears, changes, stays and vanishes at random."""
    random.seed(7)
    root, keys, runs = str(tmp_path / "history"), [f"k{i}" for i in range(200)], 6
    expected: dict[str, list[list]] = {}
    for run in range(runs):
        now = T0 + timedelta(days=run)
        present = [(key, random.choice(STATUSES)) for key in keys if random.random() < 0.6]
        for key, status in present:
            versions = expected.setdefault(key, [])
            if not versions or versions[-1][0] != status:
                if versions:
                    versions[-1][2] = now
                versions.append([status, now, None])
        rows = spark.createDataFrame(present, "order_id string, order_status string")
        found = h.snapshot(rows, root, h.ORDER_STATUS, now)
    stored: dict[str, list[list]] = {}
    for row in sorted(found.collect(), key=lambda r: r.valid_from):
        stored.setdefault(row.order_id, []).append([row.order_status, row.valid_from, row.valid_to])
    assert stored == expected


def test_calendar_of_random_entities(spark):
    random.seed(11)
    start, end = date(2024, 2, 20), date(2024, 3, 5)
    days = [start + timedelta(days=i) for i in range((end - start).days)]
    around = [start + timedelta(days=i) for i in range(-5, len(days) + 5)] + [None]
    daily = {
        (who, day): random.randint(1, 9)
        for who in range(150)
        for day in random.sample(around, random.randint(1, len(around)))
    }
    df = spark.createDataFrame(
        [(who, day, n) for (who, day), n in daily.items()], "who int, day date, n int"
    )
    found = densify_calendar(df, "who", "day", ["n"], start, end).collect()
    assert [tuple(row) for row in found] == [
        (who, day, daily.get((who, day), 0), (who, day) in daily)
        for who in range(150)
        for day in days
    ]


def test_latest_of_random_groups(spark):
    random.seed(13)
    rows = [
        (random.randint(0, 60), random.choice([None, 1, 2, 3]), i) for i in range(2_000)
    ]
    random.shuffle(rows)
    best: dict[int, tuple] = {}
    for key, at, tie in rows:
        rank = (at is not None, at or 0, tie)
        best[key] = max(best.get(key, rank), rank)
    df = spark.createDataFrame(rows, "k int, at int, tie int").repartition(7)
    found = {row.k: row.tie for row in latest_per_key(df, ["k"], "at", tiebreak=["tie"]).collect()}
    assert found == {key: rank[2] for key, rank in best.items()}
