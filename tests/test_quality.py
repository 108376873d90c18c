from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from bazaarline.operators import quality as q


def outcome(df):
    return {(row.rule, row.column_name): row.failing for row in df.collect()}


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k string, v int")


def rules():
    return [
        q.not_null("k"),
        q.accepted_values("v", [1, 2, 3]),
        q.holds("positive", "v", F.col("v") > 0),
        q.null_where("v", F.col("k") == "none", "null_for_none"),
        q.null_only_where("v", F.col("k") == "none", "null_iff_none"),
    ]


def test_row_rules(spark):
    passing = frame(spark, ("a", 1), ("b", 2), ("none", None))
    assert set(outcome(q.check_rows(passing, "t", rules())).values()) == {0}
    failing = frame(spark, (None, 9), ("none", -1), ("a", None), (None, None))
    assert outcome(q.check_rows(failing, "t", rules())) == {
        ("not_null", "k"): 2,
        ("accepted_values", "v"): 2,
        ("positive", "v"): 1,
        ("null_for_none", "v"): 1,
        ("null_iff_none", "v"): 3,
    }


def test_row_rules_on_rolled_up_rows(spark):
    df = frame(spark, ("a", 3), (None, 4), (None, 5))
    assert outcome(q.check_rows(df, "t", [q.not_null("k")], rows="v")) == {("not_null", "k"): 9}


def test_row_rules_on_an_empty_table(spark):
    assert set(outcome(q.check_rows(frame(spark), "t", rules())).values()) == {0}


def test_unique_counts_repeated_values(spark):
    df = frame(spark, ("a", 1), ("a", 2), ("b", 1), ("c", 1), ("c", 1), (None, 1), (None, 2))
    assert outcome(q.check_unique(df, "t", "k")) == {("unique", "k"): 2}
    assert outcome(q.check_unique(frame(spark), "t", "k")) == {("unique", "k"): 0}


def test_orphans_count_child_rows(spark):
    child = frame(spark, ("a", 1), ("x", 2), ("x", 3), (None, 4))
    parent = frame(spark, ("a", 1), ("b", 1))
    assert outcome(q.check_orphans(child, parent, "t", "k")) == {("no_orphans", "k"): 2}
    assert outcome(q.check_orphans(parent, parent, "t", "k")) == {("no_orphans", "k"): 0}
    # Rows that stand for several rows.
    assert outcome(q.check_orphans(child, parent, "t", "k", rows="v")) == {("no_orphans", "k"): 5}


def test_totals(spark):
    left, right = frame(spark, ("a", 1), ("b", 2)), frame(spark, ("a", 3))
    same = q.check_totals(left, F.sum("v"), right, F.sum("v"), "t", "sum").first()
    assert (float(same.actual), float(same.expected), same.passed) == (3, 3, True)
    rows = F.count(F.lit(1))
    assert not q.check_totals(left, rows, right, rows, "t", "rows").first().passed
    assert q.check_totals(left, rows, right, rows, "t", "rows", at_least=True).first().passed
    empty = q.check_totals(frame(spark), F.sum("v"), frame(spark), F.sum("v"), "t", "sum").first()
    assert empty.passed


def test_share(spark):
    df = frame(spark, ("a", 1), ("b", 1), ("c", 1), ("d", None))
    row = q.check_share(df, "t", "ones", F.col("v") == 1, 0.75).first()
    assert (row.share, row["limit"], row.passed) == (0.75, 0.75, True)
    assert not q.check_share(df, "t", "ones", F.col("v") == 1, 0.75, above=False).first().passed


def test_freshness(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 10),)], "at timestamp_ntz")
    on_time = q.check_freshness(df, "t", "at", datetime(2024, 1, 2, 22), 36).first()
    assert (on_time.age_hours, on_time.stale) == (36, False)
    assert q.check_freshness(df, "t", "at", datetime(2024, 1, 2, 22, 1), 36).first().stale
    assert q.check_freshness(df.limit(0), "t", "at", datetime(2024, 1, 2), 36).first().stale


def test_intervals(spark):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    df = spark.createDataFrame(
        [("ok", t1, t2), ("ok", t2, None), ("back", t2, t1), ("back", t2, None), ("shut", t1, t2),
         ("twice", t1, None), ("twice", t2, None)],
        "k string, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )
    assert outcome(q.check_intervals(df, "t", "k")) == {
        ("starts_before_end", "valid_to"): 1,
        ("one_open_version", "k"): 2,
    }
