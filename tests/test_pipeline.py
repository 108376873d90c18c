from __future__ import annotations

from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import bazaarline.__main__ as jobs
from bazaarline.operators.history import read_history
from bazaarline.plans import contracts
from bazaarline.plans.pipeline import MARTS, ContractViolation, build, open_marts, snapshot_orders
from bazaarline.plans.relations import Relations
from bazaarline.sources.readers import load_raw_tables, load_seed
from bazaarline.sources.sample_binding import SAMPLE_SEED, SampleTables
from bazaarline.sources.schemas import RAW_SCHEMAS
from bazaarline.sources.writers import FULL_TIMESTAMP, materialize_table, shared_dir
from parity import SAMPLE
from parity.queries import CONFIG


def replaced(raw, **tables):
    """The raw tables with some of them replaced."""
    return SimpleNamespace(**{name: tables.get(name, getattr(raw, name)) for name in RAW_SCHEMAS})


def test_build_publishes_checked_marts(spark, tmp_path, rows):
    raw = SampleTables(spark, SAMPLE)
    marts = build(spark, raw, str(tmp_path), "run-1", CONFIG)
    assert list(marts) == list(MARTS)
    plain = Relations(raw, CONFIG)
    for name in MARTS:
        assert rows(spark.table(name)) == rows(getattr(plain, name))
    # Repeating the run replaces its tables.
    again = build(spark, raw, str(tmp_path), "run-1", CONFIG)
    assert again["order_revenue"].count() == plain.order_revenue.count()


def test_outcomes_of_the_checks_are_stored(spark, tmp_path):
    build(spark, SampleTables(spark, SAMPLE), str(tmp_path), "run-1", CONFIG)
    for stage in ("staging", *MARTS):
        checks = spark.read.parquet(f"{tmp_path}/quality/{stage}/run=run-1")
        assert checks.count() > 0
        if stage != "staging":
            assert checks.where("failing > 0").count() == 0


def test_snapshot_orders(spark, tmp_path):
    raw = SampleTables(spark, SAMPLE)
    first = snapshot_orders(spark, raw, str(tmp_path), datetime(2024, 1, 1))
    assert first.count() == raw.orders.count()
    shipped = replaced(raw, orders=raw.orders.withColumn("order_status", F.lit("SHIPPED")))
    second = snapshot_orders(spark, shipped, str(tmp_path), datetime(2024, 1, 2))
    changed = raw.orders.where("order_status <> 'SHIPPED'").count()
    assert second.count() == raw.orders.count() + changed
    assert spark.table("orders_status_snapshot").where("valid_to is not null").count() == changed


def test_repeated_orders_do_not_enter_the_history(spark, tmp_path):
    raw = SampleTables(spark, SAMPLE)
    doubled = replaced(raw, orders=raw.orders.unionByName(raw.orders.limit(1)))
    with pytest.raises(ContractViolation, match="raw_orders.order_id unique: 1"):
        snapshot_orders(spark, doubled, str(tmp_path), datetime(2024, 1, 1))
    assert not (tmp_path / "snapshots").exists()


def test_build_stops_at_a_broken_contract(spark, tmp_path):
    raw = SampleTables(spark, SAMPLE)
    doubled = replaced(raw, sellers=raw.sellers.unionByName(raw.sellers.limit(1)))
    with pytest.raises(ContractViolation, match="stg_sellers.seller_id unique: 1"):
        build(spark, doubled, str(tmp_path), "run-1", CONFIG)
    assert not (tmp_path / "core").exists()


def test_a_mart_that_fails_keeps_its_published_version(spark, tmp_path):
    raw = SampleTables(spark, SAMPLE)
    build(spark, raw, str(tmp_path), "run-1", CONFIG)
    before = spark.table("seller_performance").count()
    refunds = raw.order_items.withColumn("price", F.lit(-1).cast("double"))
    with pytest.raises(ContractViolation, match="seller_performance.seller_tier accepted_values"):
        build(spark, replaced(raw, order_items=refunds), str(tmp_path), "run-2", CONFIG)
    assert spark.table("seller_performance").count() == before
    assert spark.table("seller_performance").where("seller_tier = 'unclassified'").count() == 0


def test_a_failed_repeat_leaves_what_is_published(spark, tmp_path):
    raw = SampleTables(spark, SAMPLE)
    build(spark, raw, str(tmp_path), "r1", CONFIG)
    before = {name: mart.count() for name, mart in open_marts(spark, str(tmp_path)).items()}
    broken = raw.order_items.withColumn("price", F.lit(None).cast("double"))
    with pytest.raises(ContractViolation, match="fct_order_items.item_price not_null"):
        build(spark, replaced(raw, order_items=broken), str(tmp_path), "r1", CONFIG)
    marts = open_marts(spark.newSession(), str(tmp_path))
    assert {name: mart.count() for name, mart in marts.items()} == before
    assert marts["fct_order_items"].where("item_price is null").count() == 0


def test_a_failed_history_run_is_not_committed(spark, tmp_path, monkeypatch):
    raw = SampleTables(spark, SAMPLE)
    snapshot_orders(spark, raw, str(tmp_path), datetime(2024, 1, 1))
    before = spark.table("orders_status_snapshot").count()

    def failing(history, relation, key):
        return history.limit(1).selectExpr(
            "'h' relation", "'r' rule", "'c' column_name", "cast(1 as bigint) failing"
        )

    monkeypatch.setattr("bazaarline.plans.pipeline.check_intervals", failing)
    shipped = replaced(raw, orders=raw.orders.withColumn("order_status", F.lit("SHIPPED")))
    with pytest.raises(ContractViolation):
        snapshot_orders(spark, shipped, str(tmp_path), datetime(2024, 1, 2))
    assert read_history(spark, f"{tmp_path}/snapshots/orders_status_snapshot").count() == before


TRICKY = [None, "", "\\N", "\\", "a,b", 'q"q', '"', "x\ny", "x\r\ny", "\r", " lead", "trail ", "\t", "line1\n2,boom", '""', "é"]


@pytest.mark.parametrize("file_format", ["parquet", "csv", "json", "orc"])
def test_texts_survive_every_format(spark, tmp_path, file_format):
    data = [(i, a, b) for i, (a, b) in enumerate((a, b) for a in TRICKY for b in TRICKY)]
    df = spark.createDataFrame(data, "i int, a string, b string").repartition(2)
    out = materialize_table(df, str(tmp_path / "t"), file_format)
    assert sorted((tuple(r) for r in out.collect()), key=lambda r: r[0]) == data


def test_every_column_test_is_declared():
    unique = sum(len(c.unique) for c in contracts.CONTRACTS)
    not_null = sum(len(c.not_null) for c in contracts.CONTRACTS)
    accepted = sum(len(c.accepted) for c in contracts.CONTRACTS)
    assert (unique, not_null, accepted) == (15, 31, 4)


def test_contract_checks_cover_a_relation(spark):
    relations = Relations(SampleTables(spark, SAMPLE), CONFIG)
    contract = next(c for c in contracts.CONTRACTS if c.relation == "stg_orders")
    found = {
        (r.rule, r.column_name): r.failing
        for r in contracts.contract_checks(relations.stg_orders, contract).collect()
    }
    assert found == {
        ("unique", "order_id"): 0,
        ("not_null", "order_id"): 0,
        ("not_null", "customer_id"): 0,
        ("accepted_values", "order_status"): 0,
    }


@pytest.mark.parametrize("file_format", ["parquet", "csv", "json", "orc"])
def test_raw_tables_from_files(spark, tmp_path, rows, file_format):
    """Tables written in a format read back with the raw schemas."""
    sample = SampleTables(spark, SAMPLE)
    suffix = ".csv" if file_format == "csv" else ""
    expected = {}
    for name, schema in RAW_SCHEMAS.items():
        if name == "translations":
            continue
        typed = getattr(sample, name).to(spark.createDataFrame([], schema).schema)
        expected[name] = typed
        path = "people/2024" if name == "customers" else f"{name}{suffix}"
        if file_format == "csv":  # as another tool writes it: nothing stands for null
            options = {"header": True, "nullValue": "", "escape": '"', "timestampNTZFormat": FULL_TIMESTAMP}
            typed.write.options(**options).csv(f"{tmp_path}/{path}")
        else:
            materialize_table(typed, f"{tmp_path}/{path}", file_format)
    raw = load_raw_tables(
        spark, str(tmp_path), file_format, seed=SAMPLE_SEED, names={"customers": "people/2024"}
    )
    for name, typed in expected.items():
        assert rows(getattr(raw, name)) == rows(typed), name


def test_csv_fails_on_a_malformed_row(spark, tmp_path):
    (tmp_path / "sellers.csv").write_text("seller_id,seller_zip_code_prefix\ns1\n")
    from bazaarline.sources.readers import load_source

    df = load_source(spark, str(tmp_path / "sellers.csv"), RAW_SCHEMAS["sellers"], "csv")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        df.collect()


def test_seeds_of_any_size_and_order_of_columns(spark, tmp_path):
    columns = "product_category_name,product_category_name_english"
    path = tmp_path / "seed.csv"
    path.write_text(columns + "\n" + "".join(f'c{k},"a, ""{k}"""\n' for k in range(30_000)))
    seed = load_seed(spark, path, RAW_SCHEMAS["translations"])
    assert seed.count() == 30_000 and seed.where("product_category_name_english = 'a, \"7\"'").count() == 1
    path.write_text("something,else\na,b\n")
    with pytest.raises(Exception, match="CSV header does not conform|header"):
        load_seed(spark, path, RAW_SCHEMAS["translations"]).collect()


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_jobs(spark, tmp_path):
    """Both jobs over raw tables stored as files."""
    sample, raw, root = SampleTables(spark, SAMPLE), f"{tmp_path}/raw", f"{tmp_path}/marts"
    for name, schema in RAW_SCHEMAS.items():
        if name != "translations":
            typed = getattr(sample, name).to(spark.createDataFrame([], schema).schema)
            materialize_table(typed, f"{raw}/{name}")
    places = ["--raw", raw, "--root", root, "--seed", str(SAMPLE_SEED)]
    jobs.main(["snapshot", *places, "--at", "2024-01-02T03:00:00"])
    jobs.main(["build", *places, "--run", "a", "--as-of", "2001-08-02"])
    orders = sample.orders.count()
    assert spark.table("orders_status_snapshot").count() == orders
    fresh = spark.newSession()
    assert open_marts(fresh, root)["order_revenue"].count() == orders
    assert fresh.table("order_revenue").count() == orders
    totals = spark.read.parquet(f"{root}/quality/reconciliation/run=a")
    passed = {(r.relation, r.rule): r.passed for r in totals.collect()}
    assert not passed.pop(("seller_performance", "gmv")) and all(passed.values())
    counts = spark.read.parquet(f"{root}/quality/row_counts/run=a")
    assert counts.where("not passed").count() == 0 and counts.where("relation = 'status_history'").count() == 1
    orphans = spark.read.parquet(f"{root}/quality/orphans/run=a")
    assert orphans.where("relation = 'raw_orders' and failing = 0").count() == 1
    assert spark.read.parquet(f"{root}/quality/history/run=a").first().failing == 0
    assert spark.read.parquet(f"{root}/quality/freshness/run=a").where("stale").count() == 3
