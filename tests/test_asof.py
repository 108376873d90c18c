"""As-of joins beside brute force."""

from __future__ import annotations

import random

import pytest

from bazaarline.operators.asof import asof_join

LEFT, RIGHT = "id int, k string, at int, v string", "k string, at int, v string"


def brute(left, right) -> list:
    found = []
    for number, key, at, _ in left:
        seen = [
            (t, v is not None, v or "") for k, t, v in right if None not in (key, at, k, t) and k == key and t <= at
        ]
        found.append((number, key, at, max(seen)[2] if seen and max(seen)[1] else None))
    return sorted(map(repr, found))


def told(df) -> list:
    return sorted(repr((r["id"], r["k"], r["at"], r["v"])) for r in df.collect())


@pytest.mark.parametrize("tasks", [1, 3, 16])
def test_hot_keys_ties_and_nulls(spark, tasks):
    draw = random.Random(tasks)
    # A third of all rows have one key; few instants, so many tie.
    key = lambda: draw.choice(["hot", "hot", None, *"abcd"])
    at = lambda: draw.choice([None, *range(40)])
    left = [(n // 2, key(), at(), "own") for n in range(300)]
    right = [(key(), at(), draw.choice(["x", "y", "", None])) for _ in range(90)]
    got = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "k", "at", ["v"], partitions=tasks)
    assert told(got) == brute(left, right)


def test_a_value_is_carried_over_many_ranges(spark):
    left = [(n, "k", n, None) for n in range(1, 200)] + [(999, "l", 5, None)]
    right = [("k", 0, "first"), ("k", 150, "second")]
    got = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "k", "at", ["v"], partitions=12)
    assert told(got) == brute(left, right)


def test_empty_sides_and_other_names(spark):
    left, right = spark.createDataFrame([(1, "k", 1, "own")], LEFT), spark.createDataFrame([("k", 0, "x")], RIGHT)
    assert asof_join(left.limit(0), right, "k", "at", ["v"]).count() == 0
    assert told(asof_join(left, right.limit(0), "k", "at", ["v"])) == [repr((1, "k", 1, None))]
    odd = left.withColumnsRenamed({"id": "__row", "v": "a.b"})
    got = asof_join(odd, right.withColumnRenamed("at", "from"), "k", "at", ["v"], right_at="from").first()
    assert got.asDict() == {"__row": 1, "k": "k", "at": 1, "a.b": "own", "v": "x"}


def test_only_one_row_per_range_is_broadcast(spark):
    rows = spark.range(1000).selectExpr("cast(id as int) id", "'k' as k", "cast(id as int) at", "'v' v")
    plan = asof_join(rows, rows, "k", "at", ["v"], partitions=4)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
