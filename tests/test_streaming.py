from __future__ import annotations

from datetime import datetime, timedelta

from bazaarline.operators import history as h
from bazaarline.streaming.status_feed import follow_status

SCHEMA = "order_id string, order_status string, arrived timestamp_ntz"
T0 = datetime(2024, 1, 1)


def batch_time(batch_id: int) -> datetime:
    return T0 + timedelta(days=batch_id)


def run(spark, feed, root, checkpoint):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(feed)
    query = follow_status(stream, root, checkpoint, "arrived", as_of=batch_time)
    query.awaitTermination()
    assert query.exception() is None


def write(spark, feed, *data):
    rows = [(o, s, T0 + timedelta(minutes=m)) for o, s, m in data]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(feed)


def versions(spark, root):
    found = h.read_history(spark, root).collect()
    return sorted(((r.order_id, r.order_status, r.valid_from, r.valid_to) for r in found), key=repr)


def test_feed_equals_batch_runs(spark, tmp_path):
    feed, root, checkpoint = (str(tmp_path / name) for name in ("feed", "history", "checkpoint"))
    write(spark, feed, ("a", "created", 0), ("b", "created", 0), ("a", "approved", 5))
    run(spark, feed, root, checkpoint)
    # The second batch names only one known order; the other keeps its version.
    write(spark, feed, ("b", "shipped", 10), ("c", "created", 11))
    run(spark, feed, root, checkpoint)

    t0, t1 = batch_time(0), batch_time(1)
    expected = [
        ("a", "approved", t0, None),
        ("b", "created", t0, t1),
        ("b", "shipped", t1, None),
        ("c", "created", t1, None),
    ]
    assert versions(spark, root) == sorted(expected, key=repr)

    plain = str(tmp_path / "plain")
    columns = "order_id string, order_status string"
    for i, rows in enumerate(([("a", "approved"), ("b", "created")], [("b", "shipped"), ("c", "created")])):
        h.snapshot(spark.createDataFrame(rows, columns), plain, h.ORDER_STATUS, batch_time(i))
    assert versions(spark, plain) == versions(spark, root)


def test_repeated_batch_is_stored_once(spark, tmp_path):
    feed, root = str(tmp_path / "feed"), str(tmp_path / "history")
    write(spark, feed, ("a", "created", 0))
    run(spark, feed, root, str(tmp_path / "first"))
    # A lost checkpoint replays batch 0.
    run(spark, feed, root, str(tmp_path / "second"))
    assert versions(spark, root) == [("a", "created", T0, None)]


def test_late_rows_and_ties(spark, tmp_path):
    """Batches out of order end like one batch run per moment in order."""
    feed, root, checkpoint = (str(tmp_path / name) for name in ("feed", "history", "checkpoint"))
    write(spark, feed, ("a", "delivered", 50), ("b", "created", 5), ("b", "approved", 5))
    run(spark, feed, root, checkpoint)
    write(spark, feed, ("a", "shipped", 10), ("b", "zero", 5), ("c", "created", 60))
    run(spark, feed, root, checkpoint)
    t0, t1 = batch_time(0), batch_time(1)
    expected = [("a", "delivered", t0, None), ("b", "created", t0, None), ("c", "created", t1, None)]
    assert versions(spark, root) == sorted(expected, key=repr)
