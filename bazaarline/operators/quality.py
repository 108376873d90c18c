"""Data quality rules. Every check returns a small DataFrame; nothing is collected.

Rows of a check: ``relation, rule, column_name, failing`` where 0 failing rows is a pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from bazaarline.functions import hours_between
from bazaarline.operators.history import at


@dataclass(frozen=True)
class RowRule:
    """A rule on single rows. Rows where ``violation`` is true fail; null passes.

    ``relation`` names another relation whose rows are the same, if the rule is that one's.
    """

    name: str
    column: str
    violation: Column
    relation: str | None = None

    def of(self, relation: str) -> RowRule:
        return replace(self, relation=relation)


def not_null(column: str) -> RowRule:
    return RowRule("not_null", column, F.col(column).isNull())


def accepted_values(column: str, values: Iterable) -> RowRule:
    return RowRule("accepted_values", column, ~F.col(column).isin(list(values)))


def holds(name: str, column: str, predicate: Column) -> RowRule:
    """``predicate`` must not be false; a null predicate passes."""
    return RowRule(name, column, ~predicate)


def null_only_where(column: str, condition: Column, name: str = "null_only_where") -> RowRule:
    """The column is null exactly where ``condition`` is true."""
    expected = F.coalesce(condition, F.lit(False))
    return RowRule(name, column, F.col(column).isNull() != expected)


def null_where(column: str, condition: Column, name: str = "null_where") -> RowRule:
    """The column is null wherever ``condition`` is true."""
    return RowRule(name, column, F.col(column).isNotNull() & condition)


def check_rows(
    df: DataFrame, relation: str, rules: Sequence[RowRule], rows: str | None = None
) -> DataFrame:
    """All row rules of a relation in one pass over it.

    If the relation is rolled up, ``rows`` names how many rows each of its rows stands for.
    """
    weight = F.col(rows) if rows else F.lit(1)
    counts = df.agg(
        *[
            F.coalesce(F.sum(F.when(rule.violation, weight)), F.lit(0)).alias(f"rule_{i}")
            for i, rule in enumerate(rules)
        ]
    )
    outcomes = [
        F.struct(*_outcome(rule.relation or relation, rule.name, rule.column, F.col(f"rule_{i}")))
        for i, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*outcomes)))


def check_unique(df: DataFrame, relation: str, column: str, also: Sequence[str] = ()) -> DataFrame:
    """Failing: non-null values that occur more than once.

    ``also`` names relations whose rows are the same; they get the same outcome.
    """
    repeated = df.where(F.col(column).isNotNull()).groupBy(column).count().where("count > 1")
    failing = repeated.agg(F.count(F.lit(1)).alias("failing"))
    outcomes = [F.struct(*_outcome(name, "unique", column, F.col("failing"))) for name in (relation, *also)]
    return failing.select(F.inline(F.array(*outcomes)))


def check_orphans(
    child: DataFrame, parent: DataFrame, relation: str, column: str, rows: str | None = None
) -> DataFrame:
    """Failing: child rows whose non-null key has no parent.

    The child is rolled up to one row per key before the join, so a hot key costs nothing.
    If the child is rolled up already, ``rows`` names how many rows each of its rows stands for.
    """
    counted = F.sum(rows) if rows else F.count(F.lit(1))
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(counted.alias("__rows"))
    orphans = keys.join(parent.select(column), column, "left_anti")
    failing = F.coalesce(F.sum("__rows"), F.lit(0))
    return orphans.select(*_outcome(relation, "no_orphans", column, failing))


@dataclass(frozen=True)
class Child:
    """A relation whose non-null ``column`` must be in its parent. ``rows`` as in :func:`check_orphans`."""

    relation: str
    df: DataFrame
    column: str
    rows: str | None = None


def check_children(children: Sequence[Child], parent: DataFrame, column: str) -> DataFrame:
    """:func:`check_orphans` for all children of one parent, by one grouping and one join.

    The children's keys are stacked and counted per key, one count a child; that row per key,
    already dealt by the key, meets the parent once.
    """
    stacked = all_of(
        child.df.where(F.col(child.column).isNotNull()).select(
            F.col(child.column).alias(column),
            F.lit(i).alias("__child"),
            (F.col(child.rows) if child.rows else F.lit(1)).cast("bigint").alias("__rows"),
        )
        for i, child in enumerate(children)
    )
    counts = [F.sum(F.when(F.col("__child") == i, F.col("__rows"))).alias(f"__rows_{i}") for i in range(len(children))]
    orphans = stacked.groupBy(column).agg(*counts).join(parent.select(column), column, "left_anti")
    failing = orphans.agg(
        *[F.coalesce(F.sum(f"__rows_{i}"), F.lit(0)).alias(f"__rows_{i}") for i in range(len(children))]
    )
    outcomes = [
        F.struct(*_outcome(child.relation, "no_orphans", child.column, F.col(f"__rows_{i}")))
        for i, child in enumerate(children)
    ]
    return failing.select(F.inline(F.array(*outcomes)))


def check_totals(
    left: DataFrame,
    left_total: Column,
    right: DataFrame,
    right_total: Column,
    relation: str,
    rule: str,
    at_least: bool = False,
) -> DataFrame:
    """Two totals side by side: ``relation, rule, actual, expected, passed``.

    Each side is one aggregate row; a union and a sum bring them together, so there is no
    join. ``at_least`` accepts an actual total above the expected one.
    """
    none = F.lit(None).cast("decimal(38,2)")
    sides = left.agg(left_total.cast("decimal(38,2)").alias("actual")).withColumn("expected", none)
    sides = sides.unionByName(
        right.agg(right_total.cast("decimal(38,2)").alias("expected")).withColumn("actual", none)
    )
    merged = sides.agg(F.max("actual").alias("actual"), F.max("expected").alias("expected"))
    actual, expected = F.col("actual"), F.col("expected")
    passed = actual >= expected if at_least else actual.eqNullSafe(expected)
    return merged.select(
        F.lit(relation).alias("relation"),
        F.lit(rule).alias("rule"),
        actual,
        expected,
        passed.alias("passed"),
    )


@dataclass(frozen=True)
class Equal:
    """Two measures, each a (relation, measure) name, that must be the same.

    ``at_least`` accepts an actual value above the expected one.
    """

    relation: str
    rule: str
    actual: tuple[str, str]
    expected: tuple[str, str]
    at_least: bool = False


def check_measures(
    measured: Mapping[str, tuple[DataFrame, Mapping[str, Column]]], rules: Sequence[Equal]
) -> DataFrame:
    """Totals side by side: ``relation, rule, actual, expected, passed``.

    All measures of a relation are taken in one aggregate; the one-row results are stacked and
    compared in a second one, so every relation is computed once and nothing is joined.
    """
    stacked = all_of(
        df.agg(*[column.cast("decimal(38,2)").alias(f"m_{name}") for name, column in columns.items()]).select(
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(f"{relation}.{name}").alias("measure"), F.col(f"m_{name}").alias("value"))
                        for name in columns
                    ]
                )
            )
        )
        for relation, (df, columns) in measured.items()
    )

    def value(names: tuple[str, str]) -> Column:
        return F.max(F.when(F.col("measure") == ".".join(names), F.col("value")))

    sides = stacked.agg(
        *[value(rule.actual).alias(f"a_{i}") for i, rule in enumerate(rules)],
        *[value(rule.expected).alias(f"e_{i}") for i, rule in enumerate(rules)],
    )
    outcomes = []
    for i, rule in enumerate(rules):
        actual, expected = F.col(f"a_{i}"), F.col(f"e_{i}")
        passed = actual >= expected if rule.at_least else actual.eqNullSafe(expected)
        outcomes.append(
            F.struct(
                F.lit(rule.relation).alias("relation"),
                F.lit(rule.rule).alias("rule"),
                actual.alias("actual"),
                expected.alias("expected"),
                passed.alias("passed"),
            )
        )
    return sides.select(F.inline(F.array(*outcomes)))


def check_share(
    df: DataFrame, relation: str, rule: str, predicate: Column, limit: float, above: bool = True
) -> DataFrame:
    """Share of rows that meet ``predicate``: ``relation, rule, share, limit, passed``."""
    hits = F.count_if(predicate).cast("double")
    share = F.try_divide(hits, F.count(F.lit(1)).cast("double"))
    ok = F.col("share") >= limit if above else F.col("share") < limit
    return df.agg(share.alias("share")).select(
        F.lit(relation).alias("relation"),
        F.lit(rule).alias("rule"),
        "share",
        F.lit(limit).cast("double").alias("limit"),
        ok.alias("passed"),
    )


def check_intervals(history: DataFrame, relation: str, key: str) -> DataFrame:
    """Closed versions end after they start; every key has exactly one open version."""
    ordered = check_rows(
        history,
        relation,
        [holds("starts_before_end", "valid_to", F.col("valid_from") < F.col("valid_to"))],
    )
    open_count = F.count_if(F.col("valid_to").isNull())
    wrong = history.groupBy(key).agg(open_count.alias("n")).where("n <> 1")
    return ordered.unionByName(_counted(wrong, relation, "one_open_version", key))


def check_freshness(
    df: DataFrame, relation: str, column: str, as_of: datetime, max_hours: int
) -> DataFrame:
    """Newest row against ``as_of``: ``relation, newest, age_hours, max_hours, stale``."""
    limit = F.make_dt_interval(F.lit(0), F.lit(max_hours))
    return df.agg(F.max(column).cast("timestamp_ntz").alias("newest")).select(
        F.lit(relation).alias("relation"),
        "newest",
        hours_between(F.col("newest"), at(as_of)).alias("age_hours"),
        F.lit(max_hours).alias("max_hours"),
        F.coalesce(F.col("newest") + limit < at(as_of), F.lit(True)).alias("stale"),
    )


def all_of(checks: Iterable[DataFrame]) -> DataFrame:
    """The rows of all checks, joined in pairs so that no plan is analysed once per check."""
    parts = list(checks)
    while len(parts) > 1:
        pairs = zip(parts[::2], parts[1::2], strict=False)
        rest = parts[len(parts) // 2 * 2 :]
        parts = [left.unionByName(right) for left, right in pairs] + rest
    return parts[0]


def _outcome(relation: str, rule: str, column: str, failing: Column) -> list[Column]:
    return [
        F.lit(relation).alias("relation"),
        F.lit(rule).alias("rule"),
        F.lit(column).alias("column_name"),
        failing.cast("bigint").alias("failing"),
    ]


def _counted(failures: DataFrame, relation: str, rule: str, column: str) -> DataFrame:
    return failures.select(*_outcome(relation, rule, column, F.count(F.lit(1))))
