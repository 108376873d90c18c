"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from parity import SAMPLE
from parity.check import difference, duckdb_on
from parity.oracles import ORACLES
from parity.queries import REGISTRY


@pytest.fixture(scope="module")
def oracle():
    return duckdb_on(SAMPLE)


def test_every_query_has_sql():
    """Each query of the engine; those of the text operators, if present, may have none."""
    assert set(REGISTRY) == set(ORACLES)
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(REGISTRY) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_its_sql(spark, oracle, name):
    assert difference(spark, oracle, SAMPLE, name) is None


@pytest.mark.parametrize(
    "name",
    ["seller_performance", "customer_segmentation", "order_revenue", "customer_order_dates", "orders_status_snapshot"],
)
def test_result_does_not_depend_on_the_physical_plan(spark, oracle, settings, name):
    settings(spark__sql__shuffle__partitions="3", spark__sql__autoBroadcastJoinThreshold="-1")
    assert difference(spark, oracle, SAMPLE, name) is None
