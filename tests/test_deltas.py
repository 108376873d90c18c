"""Totals kept up by changes beside totals of everything."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bazaarline.operators import deltas as d
from bazaarline.sources.writers import fresh_path

SPEC = d.TotalSpec(part="order", group="seller", sums=("n", "amount"), least=("first",), greatest=("last",))
SCHEMA = "order int, seller string, n int, amount decimal(12,2), first int, last int"
KEYS = "order int"


def contributions(spark, state: dict):
    rows = [(order, seller, *values) for order, sellers in state.items() for seller, values in sellers.items()]
    return spark.createDataFrame([(o, s, n, None if a is None else Decimal(a), first, last) for o, s, n, a, first, last in rows], SCHEMA)


def brute(state: dict) -> set:
    totals: dict = {}
    for sellers in state.values():
        for seller, values in sellers.items():
            totals.setdefault(seller, []).append(values)
    known = lambda values: [v for v in values if v is not None]
    return {
        (
            seller,
            len(rows),
            sum(n or 0 for n, *_ in rows),
            sum(a or 0 for _, a, *_ in rows),
            min(known(f for *_, f, _ in rows), default=None),
            max(known(last for *_, last in rows), default=None),
        )
        for seller, rows in totals.items()
    }


def told(totals) -> set:
    return {(r["seller"], r["parts"], r["n"], int(r["amount"]), r["first"], r["last"]) for r in totals.collect()}


def some(draw: random.Random) -> dict:
    sellers = draw.sample(["a", "b", "c", None], draw.randint(0, 3))
    value = lambda: draw.choice([None, *range(6)])
    return {s: (value(), value(), value(), value()) for s in sellers}


def run(spark, root, changed, state, label):
    keys = spark.createDataFrame([(k,) for k in changed], KEYS)
    fresh = contributions(spark, {k: state[k] for k in changed if k in state})
    d.apply_changes(spark, root, SPEC, keys, fresh, label)


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_of_changes_give_the_totals_of_everything(spark, seed):
    draw, root = random.Random(seed), fresh_path(spark, "deltas")
    state = {order: some(draw) for order in range(12)}
    run(spark, root, list(state), state, "0")
    assert told(d.stored_totals(spark, root, SPEC)) == brute(state)
    for label in "123":
        changed = draw.sample(range(15), 4)
        for order in changed:
            if draw.random() < 0.3:
                state.pop(order, None)
            else:
                state[order] = some(draw)
        run(spark, root, changed, state, label)
        assert told(d.stored_totals(spark, root, SPEC)) == brute(state)


def test_a_lost_witness_and_an_emptied_group(spark):
    root = fresh_path(spark, "deltas")
    state = {1: {"a": (1, 1, 1, 9)}, 2: {"a": (1, 1, 5, 5)}, 3: {"b": (1, 1, 1, 1)}}
    run(spark, root, [1, 2, 3], state, "1")
    state = {1: {"a": (1, 1, 6, 4)}, 2: state[2]}
    run(spark, root, [1, 3], state, "2")
    assert told(d.stored_totals(spark, root, SPEC)) == {("a", 2, 2, 2, 5, 5)}


def test_the_last_run_can_be_repeated_and_no_older_one(spark):
    root = fresh_path(spark, "deltas")
    state = {1: {"a": (1, 1, 1, 1)}, 2: {"b": (2, 2, 2, 2)}}
    run(spark, root, [1, 2], state, "1")
    run(spark, root, [2], state | {2: {"a": (9, 9, 9, 9)}}, "2")
    state[2] = {"b": (3, 3, 3, 3)}
    run(spark, root, [2], state, "2")
    assert told(d.stored_totals(spark, root, SPEC)) == brute(state)
    with pytest.raises(ValueError, match="older"):
        run(spark, root, [1], state, "1")


def test_untouched_groups_are_not_written(spark):
    root = fresh_path(spark, "deltas")
    state = {k: {"a" if k == 1 else "b": (1, 1, 1, 1)} for k in (1, 2)}
    run(spark, root, [1, 2], state, "1")
    state[1] = {"a": (2, 2, 2, 2)}
    run(spark, root, [1], state, "2")
    written = spark.read.parquet(f"{root}/run/attempts/2-*/totals")
    assert [r["seller"] for r in written.collect()] == ["a"]


def test_changed_keys(spark):
    before = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "id int, v string")
    after = spark.createDataFrame([(1, "x"), (2, "y"), (4, None)], "id int, v string")
    assert {r["id"] for r in d.changed_keys(before, after, "id").collect()} == {2, 3, 4}
    assert d.changed_keys(before, before, "id").where(F.lit(True)).count() == 0


def test_rows_of_one_run_are_not_sorted(spark):
    root = fresh_path(spark, "deltas")
    state = {k: {"a": (k, 1, 1, 1), None: (1, 1, 1, 1)} for k in (1, 2)}
    run(spark, root, [1, 2], state, "1")
    stored = d.stored_contributions(spark, root, SPEC)
    assert "Sort" not in stored._jdf.queryExecution().executedPlan().toString()


def test_stored_rows_are_dealt_once_to_find_the_removed(spark, settings):
    """The last row of a pair is looked for where the changed keys were met."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    root = fresh_path(spark, "deltas")
    state = {1: {"a": (1, 1, 1, 9), "b": (1, 1, 1, 1)}, 2: {"a": (1, 1, 5, 5)}}
    run(spark, root, [1, 2], state, "1")
    state[1] = {"a": (2, 2, 6, 4)}
    run(spark, root, [1], state, "2")
    removed = spark.read.parquet(f"{root}/run/attempts/2-*/removed")
    assert {(r["order"], r["seller"], r["n"]) for r in removed.collect()} == {(1, "a", 1), (1, "b", 1)}
    kept = d.stored_contributions(spark, root, SPEC)
    assert {(r["order"], r["seller"], r["n"]) for r in kept.collect()} == {(1, "a", 2), (2, "a", 1)}
    assert told(d.stored_totals(spark, root, SPEC)) == brute(state)
