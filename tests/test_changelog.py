from __future__ import annotations

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from bazaarline.operators import changelog as c, history as h
from bazaarline.streaming.change_feed import changes_in_time, follow_log, write_changes

SPEC = c.LogSpec(key="id", at="at", state=("status",))
SCHEMA = "id string, at timestamp_ntz, status string"
T0 = datetime(2024, 1, 1)


def moment(hours: float) -> datetime:
    return T0 + timedelta(hours=hours)


def log(spark, rows):
    return spark.createDataFrame([(k, None if t is None else moment(t), s) for k, t, s in rows], SCHEMA)


def brute(rows) -> list[tuple]:
    """Sorted by instant, the largest state of an instant, a version for each change."""
    by_key: dict = {}
    for key, t, status in rows:
        if t is not None:
            at = by_key.setdefault(key, {})
            old = at.get(t, ())
            at[t] = max(old, (status is not None, status or ""))
    found = []
    for key, at in by_key.items():
        starts = []
        for t in sorted(at):
            if not starts or starts[-1][1] != at[t]:
                starts.append((t, at[t]))
        for (t, (known, status)), after in zip(starts, [*starts[1:], (None, None)], strict=True):
            found.append((key, status if known else None, moment(t), None if after[0] is None else moment(after[0])))
    return sorted(found, key=repr)


def versions(df) -> list[tuple]:
    return sorted(((r["id"], r["status"], r["valid_from"], r["valid_to"]) for r in df.collect()), key=repr)


def sample_rows(seed: int, n: int = 120) -> list[tuple]:
    """A hot key, ties, repeated rows and states, a null key and null states; long gaps."""
    chosen = random.Random(seed)
    keys = ["hot"] * 5 + ["a", "b", None]
    rows = [(chosen.choice(keys), chosen.randrange(400) * 0.5, chosen.choice(["x", "y", "z", None])) for _ in range(n)]
    return rows + rows[:10]


def test_versions_of_a_whole_log(spark):
    rows = [*sample_rows(1), ("late", None, "x")]
    table = log(spark, rows)
    assert versions(c.versions_of(table, SPEC)) == brute(rows)
    assert versions(c.islands(c.pieces_of(table, SPEC), SPEC)) == brute(rows)
    assert c.without_instant(table, SPEC).count() == 1
    assert c.versions_of(table.limit(0), SPEC).count() == 0
    found = c.versions_of(table, SPEC).where("id is not null")
    assert found.select("scd_id").distinct().count() == found.count()


@pytest.mark.parametrize("seed", [2, 3])
def test_any_order_of_arrival_gives_one_history(spark, tmp_path, seed):
    rows = sample_rows(seed, 60)
    chosen = random.Random(seed)
    chosen.shuffle(rows)
    root = str(tmp_path / "log")
    parts = [rows[k::3] for k in range(3)]
    for k, part in enumerate(parts):
        c.apply_rows(spark, log(spark, part), root, SPEC, run=f"{k:03d}")
        if k == 1:
            c.compact(spark, root, SPEC)
    assert versions(c.read_versions(spark, root, SPEC)) == brute(rows)
    pieces = c.stored_pieces(spark, root, SPEC)
    assert sorted(map(repr, pieces.select("id", "status", "valid_from", "valid_to").collect())) == sorted(
        map(repr, c.pieces_of(log(spark, rows), SPEC).select("id", "status", "valid_from", "valid_to").collect())
    )
    assert c.splice(pieces, log(spark, rows[:20]), SPEC).count() == 0


def test_a_late_row_cuts_one_piece(spark):
    stored = c.pieces_of(log(spark, [("a", 0, "x"), ("a", 10, "x"), ("b", 0, "x")]), SPEC)
    made = c.splice(stored, log(spark, [("a", 5, "y")]), SPEC)
    assert versions(made) == [("a", "x", moment(0), moment(5)), ("a", "y", moment(5), moment(10))]


def test_repeated_run_after_compaction(spark, tmp_path):
    for compacted in (False, True):
        root = str(tmp_path / f"log-{compacted}")
        c.apply_rows(spark, log(spark, [("a", 0, "x")]), root, SPEC, run="1")
        c.apply_rows(spark, log(spark, [("a", 5, "wrong"), ("b", 1, "w")]), root, SPEC, run="2")
        if compacted:
            c.compact(spark, root, SPEC)
        c.apply_rows(spark, log(spark, [("a", 6, "y")]), root, SPEC, run="2")
        assert versions(c.read_versions(spark, root, SPEC)) == brute([("a", 0, "x"), ("a", 6, "y")])
    with pytest.raises(c.OldRun):
        c.apply_rows(spark, log(spark, []), root, SPEC, run="1")


def test_snapshot_repeated_after_compaction(spark, tmp_path):
    """The repeat of a run gives the same history with and without a base of the run it replaces."""
    found = []
    for compacted in (False, True):
        root = str(tmp_path / f"history-{compacted}")

        def run(status, k, root=root):
            rows = spark.createDataFrame([("1", status), ("2", status)], "order_id string, order_status string")
            h.snapshot(rows, root, h.ORDER_STATUS, moment(k), run=str(k))

        run("a", 1)
        run("b", 2)
        if compacted:
            h.compact(spark, root)
        run("c", 2)
        rows = h.read_history(spark, root).select("order_id", "order_status", "valid_from", "valid_to").collect()
        found.append(sorted(map(tuple, rows), key=repr))
        opened = h.open_rows(spark, root, h.committed_runs(spark, root))
        assert {r["order_status"] for r in opened.collect()} == {"c"}
    assert found[0] == found[1]


def test_no_exchange_of_rows_by_the_key_alone(spark):
    """Rows are dealt by key and unit or instant; by the key alone only one row per key and unit."""
    plan = c.versions_of(log(spark, sample_rows(4)), SPEC)._jdf.queryExecution().executedPlan().toString()
    every = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    alone = [e for e in every if re.fullmatch(r"id#\d+, \d+", e)]
    assert any("__unit" in e for e in every) and any("valid_from" in e for e in every)
    # One for the edges before and one for those behind, which stands twice and is run once.
    assert len(alone) == 3
    assert "Join" not in plan


def write(spark, folder, rows):
    log(spark, rows).coalesce(1).write.mode("append").parquet(folder)


def feed_of(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def test_feed_in_any_order(spark, tmp_path):
    feed, root, checkpoint = (str(tmp_path / name) for name in ("feed", "log", "checkpoint"))
    rows = sample_rows(6, 30)
    for part in (rows[::2], rows[1::2]):
        write(spark, feed, part)
        query = follow_log(feed_of(spark, feed), root, checkpoint, SPEC, compact_every=2)
        query.awaitTermination()
        assert query.exception() is None
    assert versions(c.read_versions(spark, root, SPEC)) == brute(rows)
    # The last batch once more, as after a failure between its write and the stream's own note.
    c.apply_rows(spark, log(spark, rows[1::2]), root, SPEC, run=f"{1:012d}")
    assert versions(c.read_versions(spark, root, SPEC)) == brute(rows)


def test_changes_in_event_time(spark, tmp_path):
    feed, out, checkpoint = (str(tmp_path / name) for name in ("feed", "out", "checkpoint"))
    rows = [("a", 1, "x"), ("b", 2, "x"), ("a", 3, "x"), ("a", 2, "y"), ("a", 2, "y")]
    later = [("a", 4, "z"), ("b", 2.5, "x"), ("a", 3.5, "x")]
    end = [("c", 50, "x")]

    def run():
        query = write_changes(changes_in_time(feed_of(spark, feed), SPEC, "2 hours", idle="30 hours"), out, checkpoint)
        query.awaitTermination()
        assert query.exception() is None

    for part in (rows, later, end, [("c", 51, "y")], [("d", 200, "x")]):
        write(spark, feed, part)
        run()
    got = [tuple(r) for r in spark.read.parquet(out).select("id", "status", "at").collect()]
    want = [v[:3] for v in brute([*rows, *later, *end, ("c", 51, "y")])]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    run()
    assert spark.read.parquet(out).count() == len(want)
    assert versions(c.versions_of(spark.read.parquet(out), SPEC)) == brute([*rows, *later, *end, ("c", 51, "y")])
