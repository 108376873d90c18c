from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from bazaarline.operators.latest import latest_per_key
from bazaarline.plans.staging import stg_order_reviews

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def test_latest_wins_and_nulls_lose(spark, rows):
    df = spark.createDataFrame(
        [
            ("two", T1, 1), ("two", T2, 2),
            ("null", None, 9), ("null", T1, 1),
            ("nulls", None, 1), ("nulls", None, 2),
            ("tie", T1, 1), ("tie", T1, 3), ("tie", T1, 2),
            ("one", T1, 7),
            (None, T1, 1), (None, T2, 2),
        ],
        "k string, at timestamp_ntz, n int",
    )
    result = latest_per_key(df, ["k"], "at", tiebreak=["n"])
    assert result.columns == ["k", "at", "n"]
    assert dict(rows(result, "k", "n")) == {
        "two": 2, "null": 1, "nulls": 2, "tie": 3, "one": 7, None: 2,
    }


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("at")
    )
    result = latest_per_key(df, ["k"], "at")
    assert result.count() == 20_001
    assert result.where("k = 0").first()["at"] == 29_997
    plan = result._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.rindex("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle


def test_staged_reviews(spark, rows):
    raw = spark.createDataFrame(
        [
            ("r1", "o1", "4.0", "t", "m", T1, T1),
            ("r1", "o2", "5", "t", "m", T1, T2),
            ("r2", "o1", "1", None, None, T2, None),
        ],
        """review_id string, order_id string, review_score string, review_comment_title string,
        review_comment_message string, review_creation_date timestamp_ntz,
        review_answer_timestamp timestamp_ntz""",
    )
    assert rows(stg_order_reviews(raw), "review_id", "order_id", "review_score") == [
        ("r1", "o2", 5), ("r2", "o1", 1),
    ]
