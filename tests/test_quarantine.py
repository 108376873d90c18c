"""Bad rows are set aside with their reasons."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from bazaarline.sources.quarantine import CORRUPT, TooManyRejected, load_sorted
from bazaarline.sources.writers import fresh_path

SCHEMA = "id bigint, price decimal(12,2), at timestamp_ntz, `a.note` string"


def lines(spark, rows: list[str]) -> str:
    path = fresh_path(spark, "lines")
    spark.createDataFrame([(r,) for r in rows], "line string").coalesce(1).write.text(path)
    return path


def load(spark, rows, **options):
    given = {"max_share": 1.0} | options
    return load_sorted(spark, lines(spark, rows), SCHEMA, fresh_path(spark, "sorted"), **given)


def test_good_and_rejected_rows_are_all_rows(spark):
    rows = ["id,price,at,a.note", "1,2.50,2024-01-02 03:04:05,x", "2,,,", "x,1,2024-13-01,y", ",1,,z", "5,1", "6,1,,q,r", '7,"1,5",,"a,""b"']
    got = load(spark, rows, required=["id"])
    assert sorted(map(tuple, got.good.collect())) == [
        (1, Decimal("2.50"), datetime(2024, 1, 2, 3, 4, 5), "x"),
        (2, None, None, None),
    ]
    assert got.good.schema.simpleString() == "struct<id:bigint,price:decimal(12,2),at:timestamp_ntz,a.note:string>"
    told = {tuple(r["reasons"]) for r in got.rejected.collect()}
    assert told == {
        ("id: not bigint", "at: not timestamp_ntz"),
        ("id: missing",),
        ("malformed line",),
        ("price: not decimal(12,2)",),
    }
    assert {r[CORRUPT] for r in got.rejected.where("reasons[0] = 'malformed line'").collect()} == {"5,1", "6,1,,q,r"}
    # A rejected row keeps its texts as they came.
    assert [r["price"] for r in got.rejected.where("id = '7'").collect()] == ["1,5"]
    assert (got.rows, got.rejected_rows) == (7, 5) and got.rejected.count() == 5


def test_stops_above_the_rate_and_keeps_the_reasons(spark):
    store = fresh_path(spark, "sorted")
    path = lines(spark, ["id,price,at,a.note", *[f"{n},1,," for n in range(9)], "x,1,,"])
    with pytest.raises(TooManyRejected, match="1 of 10"):
        load_sorted(spark, path, SCHEMA, store, max_share=0.09)
    assert spark.read.parquet(store).where("__bad = 'true'").count() == 1
    assert load_sorted(spark, path, SCHEMA, store, max_share=0.1).rejected_rows == 1


def test_json(spark):
    rows = ['{"id": 1, "price": 2.5, "a.note": "x"}', "{broken", '{"id": "one"}', '{"id": 3, "other": 1}']
    got = load(spark, rows, file_format="json")
    assert sorted(r["id"] for r in got.good.collect()) == [1, 3]
    assert sorted(r["reasons"] for r in got.rejected.collect()) == [["id: not bigint"], ["malformed line"]]


def test_empty_input_and_other_formats(spark):
    got = load(spark, ["id,price,at,a.note"])
    assert (got.rows, got.rejected_rows, got.good.count(), got.rejected.count()) == (0, 0, 0, 0)
    with pytest.raises(ValueError):
        load_sorted(spark, "x", SCHEMA, "y", "parquet")
