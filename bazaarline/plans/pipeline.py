"""Builds every mart as a table, checks it, and only then gives it its name."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from bazaarline.config import MartConfig
from bazaarline.operators.history import ORDER_STATUS, committed_runs, read_history, run_label, snapshot
from bazaarline.operators.quality import all_of, check_intervals
from bazaarline.plans import contracts
from bazaarline.plans.contracts import CONTRACT_OF, ROW_WISE, Contract, contract_checks, relation
from bazaarline.plans.relations import Relations
from bazaarline.plans.staging import order_versions
from bazaarline.session import prepare
from bazaarline.sources.commits import commit, published
from bazaarline.sources.readers import RawTables
from bazaarline.sources.writers import materialize_table, materialize_view

STAGING = (*ROW_WISE, "stg_order_reviews", "stg_translations")

STATUS_HISTORY = "orders_status_snapshot"

# The layer each mart belongs to.
MARTS = {
    "dim_products": "core",
    "fct_order_items": "core",
    "order_revenue": "core",
    "seller_performance": "core",
    "customer_segmentation": "marketing",
}


class ContractViolation(RuntimeError):
    """A relation broke a rule; it and everything after it was not published."""


def build(
    spark: SparkSession, raw: RawTables, root: str, run: str, config: MartConfig = MartConfig()
) -> dict[str, DataFrame]:
    """Build all marts under ``root`` for the run ``run``; returns them by name.

    Every attempt writes each table to a folder of its own, checks it and only then points the
    table's name to it, so readers see the last version that passed, whether a run is new or
    repeated. The names outlast the session: see :func:`open_marts`. The outcome of every
    check is stored under ``root/quality``.
    """
    prepare(spark)

    def gate(relations: Relations, stage: str, *tests: Contract) -> None:
        checks = all_of(contract_checks(relation(relations, c.relation), c) for c in tests)
        _stop_on_failures(materialize_table(checks, f"{root}/quality/{stage}/run={run}"))

    def attempt(layer: str, name: str, df: DataFrame) -> tuple[str, DataFrame]:
        folder = f"{root}/{layer}/{name}/run={run}/{uuid.uuid4().hex}"
        return folder, materialize_table(df, folder)

    relations = Relations(raw, config)
    gate(relations, "staging", *_staging_contracts())
    for name in STAGING:
        materialize_view(relation(relations, name), name)

    # All marts read this one: written once instead of joined again per mart.
    folder, summary = attempt("shared", "order_summary", relations.order_summary)
    commit(spark, f"{root}/shared", "order_summary", folder)
    stored = {"order_summary": summary}
    marts: dict[str, DataFrame] = {}
    for name, layer in MARTS.items():
        relations = Relations(raw, config, stored)
        folder, marts[name] = attempt(layer, name, getattr(relations, name))
        stored[name] = marts[name]
        gate(Relations(raw, config, stored), name, CONTRACT_OF[name])
        commit(spark, f"{root}/{layer}", name, folder)
        materialize_view(marts[name], name)
    return marts


def open_marts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The marts that count as published now, also as views of this session."""
    marts = {name: published(spark, f"{root}/{layer}", name) for name, layer in MARTS.items()}
    for name, mart in marts.items():
        materialize_view(mart, name)
    return marts


def snapshot_orders(spark: SparkSession, raw: RawTables, root: str, as_of: datetime) -> DataFrame:
    """Take the status history one run further; the history is published as a view.

    Meant to run before :func:`build`, so that it sees the orders as the source has them. The
    run counts only after its checks passed.
    """
    prepare(spark)
    label = run_label(as_of)

    def gate(stage: str, checks: DataFrame) -> None:
        _stop_on_failures(materialize_table(checks, f"{root}/quality/{stage}/run={label}"))

    # Two rows of one order would open two versions, so they must not get into the history.
    gate(f"{STATUS_HISTORY}_input", contract_checks(raw.orders, CONTRACT_OF["raw_orders"]))
    history = snapshot(
        order_versions(raw.orders),
        f"{root}/snapshots/{STATUS_HISTORY}",
        ORDER_STATUS,
        as_of,
        run=label,
        check=lambda new: gate(STATUS_HISTORY, check_intervals(new, STATUS_HISTORY, ORDER_STATUS.key)),
    )
    return materialize_view(history, STATUS_HISTORY)


# Acceptance criteria beyond the column tests. They report, they do not stop a run: some are
# expectations about the business, such as the share of sellers in a tier.
ACCEPTANCE = {
    "ranges": contracts.range_checks,
    "nullness": contracts.nullness_checks,
    "reconciliation": contracts.reconciliation_checks,
    "shares": contracts.share_checks,
}


def report_acceptance(
    raw: RawTables,
    marts: Mapping[str, DataFrame],
    root: str,
    run: str,
    config: MartConfig = MartConfig(),
    now: datetime | None = None,
) -> dict[str, DataFrame]:
    """Check the built marts against their acceptance criteria and store the outcomes.

    The order summary of the build is read, not joined again. If there is a status history
    below ``root``, its criteria are checked as well. ``now`` is the time that the age of the
    marts is taken at; the clock's, if not given.
    """
    spark = next(iter(marts.values())).sparkSession
    summary = published(spark, f"{root}/shared", "order_summary")
    relations = Relations(raw, config, {"order_summary": summary, **marts})
    folder = f"{root}/snapshots/{STATUS_HISTORY}"
    history = read_history(spark, folder) if committed_runs(spark, folder) else None
    checks = {name: check(relations) for name, check in ACCEPTANCE.items()}
    checks["orphans"] = contracts.orphan_checks(relations, history=history)
    checks["row_counts"] = contracts.row_count_checks(relations, history)
    clock = now or datetime.now(UTC).replace(tzinfo=None)
    checks["freshness"] = contracts.freshness_checks(relations, clock)
    if history is not None:
        checks["history"] = contracts.history_checks(history)
    return {name: materialize_table(df, f"{root}/quality/{name}/run={run}") for name, df in checks.items()}


def _staging_contracts() -> list[Contract]:
    single = [CONTRACT_OF[name] for name in ("raw_order_reviews", "stg_order_reviews", "stg_translations")]
    return single + [CONTRACT_OF[name].joined(CONTRACT_OF[raw]) for name, raw in ROW_WISE.items()]


def _stop_on_failures(checks: DataFrame) -> None:
    """Brings only the failing rules to the driver."""
    failed = checks.where("failing > 0").collect()
    if failed:
        report = "; ".join(
            f"{row.relation}.{row.column_name} {row.rule}: {row.failing}" for row in failed
        )
        raise ContractViolation(report)
