"""Checksum trees beside brute force."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime

import pytest

from bazaarline.operators import reconcile
from bazaarline.sources.writers import fresh_path

SCHEMA = "k string, a int, `b.c` string, at timestamp_ntz"


def stored(spark, rows, bits=8, schema=SCHEMA, keys=("k",)):
    return reconcile.store(spark.createDataFrame(rows, schema), fresh_path(spark, "tree"), keys, bits)


def brute(left, right) -> list:
    found = []
    for key in {r[0] for r in left + right}:
        mine, other = (Counter(r for r in side if r[0] == key) for side in (left, right))
        if mine != other:
            per_column = [
                name
                for i, name in ((1, "a"), (2, "b.c"), (3, "at"))
                if mine and other and Counter(r[i] for r in mine.elements()) != Counter(r[i] for r in other.elements())
            ]
            found.append((key, mine.total(), other.total(), per_column))
    return sorted(found, key=repr)


def told(df) -> list:
    return sorted(((r["k"], r["left_rows"], r["right_rows"], r["differing"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_hot_null_and_repeated_keys(spark, seed):
    draw = random.Random(seed)
    days = [None, datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 1)]
    key = lambda: draw.choice(["hot", None, "", f"k{draw.randrange(80)}"])
    left = [(key(), draw.choice([None, 0, 1]), draw.choice([None, "", "x"]), draw.choice(days)) for _ in range(300)]
    right = [r for r in left if draw.random() > 0.05]
    right = [(*r[:2], "other", r[3]) if draw.random() < 0.05 else r for r in right] + [("new", 1, None, None)]
    got = reconcile.differences(spark, stored(spark, left), stored(spark, right))
    assert told(got) == brute(left, right)


def test_a_null_differs_wherever_it_is(spark):
    left, right = [("k", None, "1", None)], [("k", 1, None, None)]
    got = reconcile.differences(spark, stored(spark, left), stored(spark, right))
    assert told(got) == [("k", 1, 1, ["a", "b.c"])]


def test_swapped_values_of_repeated_rows(spark):
    left, right = [("k", 1, "x", None), ("k", 2, "y", None)], [("k", 1, "y", None), ("k", 2, "x", None)]
    got = reconcile.differences(spark, stored(spark, left), stored(spark, right))
    assert told(got) == [("k", 2, 2, [])]


def test_equal_and_empty(spark):
    rows = [(f"k{n}", n, None, None) for n in range(50)]
    whole, none = stored(spark, rows), stored(spark, [])
    again = stored(spark, rows[::-1])
    assert reconcile.differing_buckets(spark, whole, again) == []
    assert reconcile.differences(spark, whole, again).count() == 0
    assert reconcile.differences(spark, none, none).count() == 0
    assert told(reconcile.differences(spark, none, whole)) == brute([], rows)


def test_rows_are_read_only_of_differing_buckets(spark):
    rows = [(f"k{n}", n, "x" * 20, None) for n in range(4000)]
    left, right = stored(spark, rows, 10), stored(spark, [*rows[:-1], ("k3999", 0, "x" * 20, None)], 10)
    assert len(reconcile.differing_buckets(spark, left, right)) == 1
    got = reconcile.differences(spark, left, right)
    plan = got._jdf.queryExecution().toString()
    assert told(got) == [("k3999", 1, 1, ["a"])]
    assert "__folder" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "PushedFilters: [IsNotNull(__bucket), GreaterThanOrEqual(__bucket" in plan and "LessThanOrEqual(__bucket" in plan


def test_trees_must_fit(spark):
    tree = stored(spark, [])
    with pytest.raises(ValueError):
        reconcile.differences(spark, tree, stored(spark, [], bits=9))
    with pytest.raises(ValueError):
        reconcile.differences(spark, tree, stored(spark, [], schema="k string, a bigint, `b.c` string, at timestamp_ntz"))
    with pytest.raises(ValueError):
        reconcile.differences(spark, tree, stored(spark, [], schema="k string, z int"))
    with pytest.raises(ValueError):
        stored(spark, [], bits=30)
