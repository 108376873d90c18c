"""Histories from change logs: rows of a key in any order of arrival.

A *piece* is one observed state of a key, valid from its instant to the next instant of the
key. Pieces follow from the set of rows alone, whatever order they came in: a row that comes
late cuts the piece that holds its instant. A *version* is an island of pieces: neighbours
with equal states are one.

A key may own a third of all rows, so no step brings the rows of a key together: they are dealt
by units of time, and only the first and last row of each unit meet in the order of the key.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from bazaarline.functions import hashed_key
from bazaarline.sources.commits import commit, folder_of, names


@dataclass(frozen=True)
class LogSpec:
    """``key`` and ``at`` name a row's key and instant, ``state`` the columns whose change opens a
    version. ``unit`` is the unit of time by which rows of one key are dealt over tasks."""

    key: str
    at: str
    state: Sequence[str]
    unit: str = "day"


def _beside(rows: DataFrame, spec: LogSpec, order: str, value: Column, name: str, ahead: bool) -> DataFrame:
    """``rows`` with ``value`` of the row before (or behind) in the order of the key.

    Within a unit by a window. The first and last row of each unit, two at most, meet in a
    window over the key: there the row beside the last of a unit is the first of the next.
    """
    shift = F.lead if ahead else F.lag
    given = F.struct(value.alias("v"))
    within = Window.partitionBy(spec.key, "__unit").orderBy(order)
    dealt = rows.withColumn("__unit", F.date_trunc(spec.unit, F.col(order))).select(
        "*",
        given.alias("__value"),
        shift(given).over(within).alias("__near"),
        (F.lag(order).over(within).isNull() | F.lead(order).over(within).isNull()).alias("__edge"),
    )
    across = Window.partitionBy(spec.key).orderBy(order)
    inner = dealt.where(~F.col("__edge"))
    edges = dealt.where("__edge").withColumn("__near", F.coalesce("__near", shift("__value").over(across)))
    return inner.unionByName(edges).select(*rows.columns, F.col("__near")["v"].alias(name))


def pieces_of(log: DataFrame, spec: LogSpec) -> DataFrame:
    """The pieces of a log: ``key, state columns, valid_from, valid_to``.

    Rows of a key with equal instants are one: the one with the largest state, null least, so
    repeated rows change nothing. A null key is a key like any other. Rows without an instant
    have no place in a history and are refused, see :func:`without_instant`.
    """
    return _linked(_observed(log, spec), spec)


def without_instant(log: DataFrame, spec: LogSpec) -> DataFrame:
    """Rows that no history can hold."""
    return log.where(F.col(spec.at).isNull())


def _observed(log: DataFrame, spec: LogSpec) -> DataFrame:
    """One row per key and instant."""
    state = F.max(F.struct(*spec.state)).alias("__state")
    placed = log.where(F.col(spec.at).isNotNull()).withColumn("valid_from", F.col(spec.at).cast("timestamp_ntz"))
    return placed.groupBy(spec.key, "valid_from").agg(state).select(spec.key, "__state.*", "valid_from")


def _linked(starts: DataFrame, spec: LogSpec) -> DataFrame:
    return _beside(starts, spec, "valid_from", F.col("valid_from"), "valid_to", ahead=True)


def islands(pieces: DataFrame, spec: LogSpec) -> DataFrame:
    """The versions that pieces make: neighbours with equal states are one.

    Columns: the key, the state, ``scd_id``, ``updated_at``, ``valid_from`` and ``valid_to``.
    """
    starts = pieces.select(spec.key, *spec.state, "valid_from")
    state = F.struct(*spec.state)
    before = _beside(starts, spec, "valid_from", state, "__before", ahead=False)
    opening = before.where(F.col("__before").isNull() | ~F.col("__before").eqNullSafe(state)).drop("__before")
    return _linked(opening, spec).select(
        spec.key,
        *spec.state,
        hashed_key(F.col(spec.key), F.col("valid_from"), separator="|").alias("scd_id"),
        F.col("valid_from").alias("updated_at"),
        "valid_from",
        "valid_to",
    )


def versions_of(log: DataFrame, spec: LogSpec) -> DataFrame:
    """The history of a whole log: several changes of a key in one run are several versions."""
    return islands(_observed(log, spec), spec)


def splice(pieces: DataFrame | None, rows: DataFrame, spec: LogSpec) -> DataFrame:
    """What ``rows``, in time or late, do to stored pieces: the new pieces and those they cut.

    A new row takes its place between the stored pieces of its key: the piece that holds its
    instant now ends there, and the row's piece ends where that one did. At an instant that is
    stored already the larger state stays. Each returned piece replaces the stored one of its
    key and ``valid_from``, if there is one; pieces that stay as they are are not returned.
    Only the pieces of the keys in ``rows`` are sorted.
    """
    fresh = _observed(rows, spec)
    if pieces is None:
        return _linked(fresh, spec)
    keys = fresh.select(F.col(spec.key).alias("__key")).distinct()
    touched = pieces.join(keys, F.col(spec.key).eqNullSafe(F.col("__key")), "left_semi")
    state = F.struct(*spec.state)
    old = touched.select(spec.key, *spec.state, "valid_from", F.struct(state.alias("s"), F.col("valid_to").alias("to")).alias("__old"))
    both = old.unionByName(fresh.withColumn("__old", F.lit(None).cast(old.schema["__old"].dataType)))
    merged = both.groupBy(spec.key, "valid_from").agg(F.max(state).alias("__state"), F.max("__old").alias("__old"))
    starts = merged.select(spec.key, "__state.*", "valid_from", "__old")
    linked = _linked(starts, spec)
    now = F.struct(state.alias("s"), F.col("valid_to").alias("to"))
    return linked.where(~F.col("__old").eqNullSafe(now)).drop("__old")


# Stored form: a folder per run with the pieces it made or cut. Of the pieces of a key that start
# at one instant, the one of the last run counts. ``compact`` writes them as a base.

RUN, BASE = "run", "base"


def stored_pieces(spark: SparkSession, root: str, spec: LogSpec, before: str | None = None) -> DataFrame | None:
    """The pieces after all runs, or after those before a label; None before the first run."""
    runs = [label for label in names(spark, f"{root}/{RUN}") if before is None or label < before]
    base, folder = "", None
    for label in reversed(names(spark, f"{root}/{BASE}")):
        if label in runs:
            told, _, built_from = folder_of(spark, f"{root}/{BASE}", label).partition("\n")
            if built_from == folder_of(spark, f"{root}/{RUN}", label):
                base, folder = label, told
                break
    later = [(label, folder_of(spark, f"{root}/{RUN}", label)) for label in runs if label > base]
    parts = ([(base, folder)] if folder else []) + later
    if not parts:
        return None
    schema = spark.read.parquet(parts[0][1]).schema
    found = spark.read.schema(schema).parquet(*[path for _, path in parts])
    if len(parts) == 1:
        return found.drop("run")
    others = [c for c in found.columns if c not in (spec.key, "valid_from", "run")]
    last = found.groupBy(spec.key, "valid_from").agg(F.max_by(F.struct(*others), "run").alias("__last"))
    return last.select(spec.key, "valid_from", "__last.*")


class OldRun(ValueError):
    """A run older than the last one; only the last can be repeated."""


def apply_rows(spark: SparkSession, rows: DataFrame, root: str, spec: LogSpec, run: str) -> None:
    """One run: place ``rows`` in the stored history. Repeating the last run replaces it."""
    done = names(spark, f"{root}/{RUN}")
    if done and done[-1] > run:
        raise OldRun(f"run {run} is older than the last run {done[-1]}")
    attempt = f"{root}/{RUN}/attempts/{run}-{uuid.uuid4().hex}"
    made = splice(stored_pieces(spark, root, spec, before=run), rows, spec)
    made.withColumn("run", F.lit(run)).write.parquet(attempt)
    commit(spark, f"{root}/{RUN}", run, attempt)


def compact(spark: SparkSession, root: str, spec: LogSpec) -> None:
    """Write all pieces as a base, so that later runs read it and not the runs before.

    The base names the attempt of the last run that it holds and counts only as long as that one
    does.
    """
    runs = names(spark, f"{root}/{RUN}")
    if not runs:
        raise ValueError(f"no finished run in {root}")
    built_from = folder_of(spark, f"{root}/{RUN}", runs[-1])
    attempt = f"{root}/{BASE}/attempts/{runs[-1]}-{uuid.uuid4().hex}"
    stored_pieces(spark, root, spec).withColumn("run", F.lit(runs[-1])).write.parquet(attempt)
    commit(spark, f"{root}/{BASE}", runs[-1], f"{attempt}\n{built_from}")


def read_versions(spark: SparkSession, root: str, spec: LogSpec) -> DataFrame:
    """The history after all finished runs."""
    pieces = stored_pieces(spark, root, spec)
    if pieces is None:
        raise ValueError(f"no finished run in {root}")
    return islands(pieces, spec)
