from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bazaarline.operators import history as h
from bazaarline.operators.quality import check_intervals
from bazaarline.sources.commits import committed

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 1, 2, 12), datetime(2024, 1, 3)


def orders(spark, *data):
    return spark.createDataFrame(list(data), "order_id string, order_status string, note string")


FIRST = (
    ("same", "created", "x"),
    ("moved", "created", "x"),
    ("set", None, "x"),
    ("unset", "created", "x"),
    ("case", "Created", "x"),
    ("other", "created", "x"),
    ("gone", "created", "x"),
)
SECOND = (
    ("same", "created", "x"),
    ("moved", "shipped", "x"),
    ("set", "created", "x"),
    ("unset", None, "x"),
    ("case", "created", "x"),
    ("other", "created", "y"),
    ("fresh", "created", "x"),
)


def versions(df):
    return sorted(
        ((r.order_id, r.order_status, r.valid_from, r.valid_to) for r in df.collect()), key=repr
    )


EXPECTED = sorted(
    [
        ("same", "created", T1, None),
        ("moved", "created", T1, T2),
        ("moved", "shipped", T2, None),
        ("set", None, T1, T2),
        ("set", "created", T2, None),
        ("unset", "created", T1, T2),
        ("unset", None, T2, None),
        ("case", "Created", T1, T2),
        ("case", "created", T2, None),
        ("other", "created", T1, None),
        ("gone", "created", T1, None),
        ("fresh", "created", T2, None),
    ],
    key=repr,
)


def test_check_strategy(spark):
    first = h.open_versions(orders(spark, *FIRST), h.ORDER_STATUS, T1)
    second = h.scd2_apply(first, orders(spark, *SECOND), h.ORDER_STATUS, T2)
    assert versions(second) == EXPECTED
    ids = [row.scd_id for row in second.collect()]
    assert len(set(ids)) == len(ids)
    assert {row.failing for row in check_intervals(second, "history", "order_id").collect()} == {0}
    # A difference outside the checked columns leaves the stored row as it was.
    assert [r.note for r in second.where("order_id = 'other'").collect()] == ["x"]


def test_timestamp_strategy(spark):
    spec = h.HistorySpec(key="order_id", updated_at="changed_at")
    schema = "order_id string, order_status string, changed_at timestamp_ntz"
    first = spark.createDataFrame([("a", "created", T1), ("b", "created", T2)], schema)
    second = spark.createDataFrame(
        [("a", "shipped", T3), ("b", "late", T1), ("c", "created", T3)], schema
    )
    state = h.scd2_apply(h.open_versions(first, spec, T3), second, spec, T3)
    assert versions(state) == sorted(
        [
            ("a", "created", T1, T3),
            ("a", "shipped", T3, None),
            ("b", "created", T2, None),
            ("c", "created", T3, None),
        ],
        key=repr,
    )


def test_spec_needs_one_strategy():
    with pytest.raises(ValueError):
        h.HistorySpec(key="order_id")
    with pytest.raises(ValueError):
        h.HistorySpec(key="order_id", check=("a",), updated_at="b")


def test_stored_runs(spark, tmp_path):
    root = str(tmp_path / "history")
    assert len(versions(h.snapshot(orders(spark, *FIRST), root, h.ORDER_STATUS, T1))) == len(FIRST)
    assert versions(h.snapshot(orders(spark, *SECOND), root, h.ORDER_STATUS, T2)) == EXPECTED
    # The same run again replaces itself.
    assert versions(h.snapshot(orders(spark, *SECOND), root, h.ORDER_STATUS, T2)) == EXPECTED
    # A later run without changes adds nothing.
    assert versions(h.snapshot(orders(spark, *SECOND), root, h.ORDER_STATUS, T3)) == EXPECTED
    assert h.committed_runs(spark, root) == ["20240101T000000", "20240102T120000", "20240103T000000"]
    with pytest.raises(ValueError, match="older"):
        h.snapshot(orders(spark, *FIRST), root, h.ORDER_STATUS, T2)


def test_change_back_opens_a_third_version(spark, tmp_path):
    root = str(tmp_path / "history")
    for moment, status in ((T1, "created"), (T2, "shipped"), (T3, "created")):
        state = h.snapshot(orders(spark, ("o", status, "x")), root, h.ORDER_STATUS, moment)
    assert versions(state) == sorted(
        [("o", "created", T1, T2), ("o", "shipped", T2, T3), ("o", "created", T3, None)], key=repr
    )
    assert [row.transitions for row in h.status_transitions(state).collect()] == [2]


def test_unfinished_run_is_not_read(spark, tmp_path):
    root = tmp_path / "history"
    h.snapshot(orders(spark, *FIRST), str(root), h.ORDER_STATUS, T1)
    h.snapshot(orders(spark, *SECOND), str(root), h.ORDER_STATUS, T2)
    (root / "run" / "_published" / "20240102T120000").rename(tmp_path / "moved_pointer")
    assert len(versions(h.read_history(spark, str(root)))) == len(FIRST)
    assert versions(h.snapshot(orders(spark, *SECOND), str(root), h.ORDER_STATUS, T2)) == EXPECTED


def test_empty_history(spark, tmp_path):
    with pytest.raises(ValueError, match="no finished run"):
        h.read_history(spark, str(tmp_path / "nothing"))


def test_time_in_status(spark):
    first = h.open_versions(orders(spark, ("a", "created", "x")), h.ORDER_STATUS, T1)
    state = h.scd2_apply(first, orders(spark, ("a", "shipped", "x")), h.ORDER_STATUS, T2)
    hours = h.time_in_status(state, T3).select("order_status", "hours_in_status").collect()
    assert dict(hours) == {"created": 36, "shipped": 12}


def test_current_versions(spark):
    first = h.open_versions(orders(spark, *FIRST), h.ORDER_STATUS, T1)
    second = h.scd2_apply(first, orders(spark, *SECOND), h.ORDER_STATUS, T2)
    current = h.current_versions(second)
    assert current.count() == current.select(F.countDistinct("order_id")).first()[0] == 8


def test_a_run_writes_what_it_changes(spark, tmp_path):
    root = str(tmp_path / "history")
    many = spark.range(2000).selectExpr("cast(id as string) order_id", "'created' order_status", "'x' note")
    h.snapshot(many, root, h.ORDER_STATUS, T1)
    few = many.withColumn("order_status", F.when(F.col("order_id") < "1001", "shipped").otherwise("created"))
    changed = few.where("order_status = 'shipped'").count()
    h.snapshot(few, root, h.ORDER_STATUS, T2)
    folder = committed(spark, f"{root}/run")[h.run_label(T2)]
    assert spark.read.parquet(folder).count() == 2 * changed < 100
    before = versions(h.read_history(spark, root))
    assert len(before) == 2000 + changed
    h.compact(spark, root)
    assert versions(h.read_history(spark, root)) == before
    # After the compaction a run reads the base.
    assert versions(h.snapshot(few, root, h.ORDER_STATUS, T3)) == before
    assert h.open_rows(spark, root, h.committed_runs(spark, root)).count() == 2000


def test_null_keys_are_keys_and_repeated_ones_are_refused(spark, tmp_path):
    root = str(tmp_path / "history")
    rows = orders(spark, (None, "created", "x"), ("a", "created", "x"))
    for moment in (T1, T2, T3):
        state = h.snapshot(rows, root, h.ORDER_STATUS, moment)
    assert versions(state) == sorted([(None, "created", T1, None), ("a", "created", T1, None)], key=repr)
    later = datetime(2024, 1, 9)
    for twice in (None, "a"):
        with pytest.raises(h.RepeatedKeys):
            h.snapshot(rows.unionByName(orders(spark, (twice, "shipped", "x"))), root, h.ORDER_STATUS, later)
    assert h.committed_runs(spark, root)[-1] == h.run_label(T3)


def test_a_run_counts_only_after_its_check(spark, tmp_path):
    root = str(tmp_path / "history")
    h.snapshot(orders(spark, *FIRST), root, h.ORDER_STATUS, T1)

    def refuse(history):
        assert versions(history) == EXPECTED
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        h.snapshot(orders(spark, *SECOND), root, h.ORDER_STATUS, T2, check=refuse)
    assert len(versions(h.read_history(spark, root))) == len(FIRST)
