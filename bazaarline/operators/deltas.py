"""Totals kept up by changes: signed sums for changed parts, a new look only at groups that need one.

A *part* (an order) gives each group (a seller) at most one row, its *contribution*. When parts
change, their old contributions leave the totals and their new ones enter. A sum follows by
adding; a least or greatest value does not if the row that had it left: such a group has lost
its witness and is computed anew from its contributions.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bazaarline.sources.commits import commit, folder_of, names
from bazaarline.sources.writers import materialize_table


@dataclass(frozen=True)
class TotalSpec:
    """``part`` and ``group`` name the keys of a contribution. ``sums`` are added up, a null as 0;
    of ``least`` and ``greatest`` the extreme value counts, without nulls."""

    part: str
    group: str
    sums: Sequence[str]
    least: Sequence[str] = ()
    greatest: Sequence[str] = ()

    @property
    def measures(self) -> list[str]:
        return [*self.sums, *self.least, *self.greatest]


def changed_keys(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Keys whose rows differ between two states of a table, or are in one of them only."""
    row = F.struct(*[F.col(f"`{c}`") for c in before.columns if c != key])
    old = before.select(F.col(key).alias("__key"), row.alias("__old"))
    new = after.select(F.col(key), row.alias("__new"))
    both = old.join(new, F.col("__key") == F.col(key), "full_outer")
    return both.where(~F.col("__old").eqNullSafe(F.col("__new"))).select(F.coalesce(F.col(key), F.col("__key")).alias(key))


def totals_of(contributions: DataFrame, spec: TotalSpec) -> DataFrame:
    """The totals of all groups, with their number of ``parts``."""
    return contributions.groupBy(spec.group).agg(
        F.count(F.lit(1)).alias("parts"),
        *[F.sum(F.coalesce(s, F.lit(0))).alias(s) for s in spec.sums],
        *[F.min(m).alias(m) for m in spec.least],
        *[F.max(m).alias(m) for m in spec.greatest],
    )


def _signed(removed: DataFrame, added: DataFrame, spec: TotalSpec) -> DataFrame:
    columns = [spec.group, *spec.measures]
    rows = removed.select(*columns, F.lit(-1).alias("__sign")).unionByName(added.select(*columns, F.lit(1).alias("__sign")))
    entering, leaving = F.col("__sign") > 0, F.col("__sign") < 0

    def added_up(name: str) -> Column:
        value = F.coalesce(name, F.lit(0))
        return F.sum(F.when(entering, value).otherwise(-value)).alias(f"__by_{name}")

    extremes = []
    for extreme, fields in ((F.min, spec.least), (F.max, spec.greatest)):
        for m in fields:
            extremes += [extreme(F.when(entering, F.col(m))).alias(f"__in_{m}"), extreme(F.when(leaving, F.col(m))).alias(f"__out_{m}")]
    return rows.groupBy(spec.group).agg(F.sum("__sign").alias("__by_parts"), *map(added_up, spec.sums), *extremes)


def moved_totals(totals: DataFrame, removed: DataFrame, added: DataFrame, current: DataFrame, spec: TotalSpec) -> DataFrame:
    """The totals after a change, of the groups it touches; a group without parts has 0 ``parts``.

    ``totals`` are those before, ``removed`` and ``added`` the contributions of the changed parts
    before and after, ``current`` all contributions after. Of ``current`` only groups that lost
    a witness are used in the result. A null group is a group like any other.
    """
    moves = _signed(removed, added, spec).withColumnRenamed(spec.group, "__group")
    same = F.col("__group").eqNullSafe(F.col(spec.group))
    met = moves.join(totals, same, "left").withColumn("__parts", F.coalesce("parts", F.lit(0)) + F.col("__by_parts"))

    def lost(m: str, least: bool) -> Column:
        # The extreme left, and what entered does not reach it.
        entered = F.col(f"__in_{m}")
        reached = (entered <= F.col(m)) if least else (entered >= F.col(m))
        return F.coalesce(F.col(f"__out_{m}") == F.col(m), F.lit(False)) & ~F.coalesce(reached, F.lit(False))

    any_lost = F.lit(False)
    for m in spec.least:
        any_lost = any_lost | lost(m, least=True)
    for m in spec.greatest:
        any_lost = any_lost | lost(m, least=False)
    met = met.withColumn("__lost", any_lost & (F.col("__parts") > 0))
    empty = F.col("__parts") == 0
    kept = met.where(~F.col("__lost")).select(
        F.col("__group").alias(spec.group),
        F.col("__parts").alias("parts"),
        *[(F.coalesce(s, F.lit(0)) + F.col(f"__by_{s}")).cast(totals.schema[s].dataType).alias(s) for s in spec.sums],
        *[F.when(~empty, F.least(m, f"__in_{m}")).alias(m) for m in spec.least],
        *[F.when(~empty, F.greatest(m, f"__in_{m}")).alias(m) for m in spec.greatest],
    )
    again = met.where("__lost").select(F.col("__group").alias("__again"))
    # Rows are added up by group before the groups meet those that lost a witness, so no rows are
    # shuffled for that; few such groups are broadcast, and then other rows are left out at once.
    anew = totals_of(current, spec).join(again, F.col(spec.group).eqNullSafe(F.col("__again")), "left_semi")
    return kept.unionByName(anew.select(kept.columns))


# Stored form: a folder per run with the contributions and the totals it changed. Of one part and
# group, and of one group, the row of the last run counts, a live one before one that is gone; a
# run's pointer publishes both.

RUN = "run"


def _rows(spark: SparkSession, root: str, what: str, before: str | None) -> tuple[DataFrame | None, int]:
    """The rows of all runs, or of those before a label, and how many runs they are of."""
    runs = [label for label in names(spark, f"{root}/{RUN}") if before is None or label < before]
    if not runs:
        return None, 0
    folders = [f"{folder_of(spark, f'{root}/{RUN}', label)}/{what}" for label in runs]
    schema = spark.read.parquet(folders[0]).schema
    return spark.read.schema(schema).parquet(*folders), len(runs)


def _after(spark: SparkSession, root: str, what: str, keys: Sequence[str], alive: Column, before: str | None) -> DataFrame | None:
    rows, runs = _rows(spark, root, what, before)
    return None if rows is None else _last(rows, keys, runs).where(alive)


def _last(rows: DataFrame, keys: Sequence[str], runs: int) -> DataFrame:
    """Of the rows with equal keys that of the last run, in a run a live one before one that is gone."""
    if runs == 1:
        # Columns of fixed width are grouped by hash here, while structs would be sorted.
        return rows.drop("run").dropDuplicates(list(keys))
    others = [c for c in rows.columns if c not in keys]
    newest = F.struct("run", *["live"] * ("live" in others))
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*others), newest).alias("__last")).select(*keys, "__last.*").drop("run")


def stored_contributions(spark: SparkSession, root: str, spec: TotalSpec, before: str | None = None) -> DataFrame | None:
    return _after(spark, root, "parts", [spec.part, spec.group], F.col("live"), before)


def stored_totals(spark: SparkSession, root: str, spec: TotalSpec, before: str | None = None) -> DataFrame | None:
    """The totals after all runs, or after those before a label; None before the first."""
    return _after(spark, root, "totals", [spec.group], F.col("parts") > 0, before)


def apply_changes(spark: SparkSession, root: str, spec: TotalSpec, changed: DataFrame, added: DataFrame, run: str) -> None:
    """One run: the contributions of the parts in ``changed`` are now those in ``added``.

    ``changed`` holds the keys of changed, new and gone parts. In the first run ``added`` is all
    there is. Repeating the last run replaces it; an older one is refused.
    """
    done = names(spark, f"{root}/{RUN}")
    if done and done[-1] > run:
        raise ValueError(f"run {run} is older than the last run {done[-1]}")
    attempt = f"{root}/{RUN}/attempts/{run}-{uuid.uuid4().hex}"
    columns = [spec.part, spec.group, *spec.measures]
    fresh = added.select(*columns, F.lit(True).alias("live"))
    stored, runs = _rows(spark, root, "parts", before=run)
    if stored is None:
        parts = materialize_table(fresh.withColumn("run", F.lit(run)), f"{attempt}/parts")
        totals = totals_of(parts, spec)
    else:
        pair = [spec.part, spec.group]
        keys = changed.select(F.col(spec.part).alias("__changed")).distinct()
        is_changed = F.col(spec.part).eqNullSafe(F.col("__changed"))
        # Stored rows meet the changed keys before the last of a pair is looked for: both go by the
        # part, so the rows are dealt once, or not at all if the keys are few.
        removed = _last(stored.join(keys, is_changed, "left_semi"), pair, runs).where("live").select(*columns)
        removed = materialize_table(removed, f"{attempt}/removed")
        # A pair that is in both is live in this run.
        gone = removed.withColumn("live", F.lit(False))
        both = gone.unionByName(fresh.dropDuplicates(pair)).withColumn("run", F.lit(run))
        parts = materialize_table(both, f"{attempt}/parts")
        added = parts.where("live").select(*columns)
        others = _last(stored.join(keys, is_changed, "left_anti"), pair, runs).where("live").select(*columns)
        current = others.unionByName(added)
        totals = moved_totals(stored_totals(spark, root, spec, before=run), removed, added, current, spec)
    totals.withColumn("run", F.lit(run)).write.parquet(f"{attempt}/totals")
    commit(spark, f"{root}/{RUN}", run, attempt)
