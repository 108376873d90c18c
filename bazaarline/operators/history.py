"""Type-2 history: every version of a row with the interval it was valid in.

Managed columns: ``scd_id``, ``updated_at``, ``valid_from`` and ``valid_to`` (null while
the version is current).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bazaarline.functions import hashed_key, hours_between
from bazaarline.sources.commits import commit, folder_of, names
from bazaarline.sources.commits import existing as _paths

MANAGED = ("scd_id", "updated_at", "valid_from", "valid_to")


@dataclass(frozen=True)
class HistorySpec:
    """How a changed row is recognised.

    ``check`` columns: any difference, nulls included, is a change. ``updated_at``: a later
    value in that column is a change, and versions are dated by it instead of the run.
    """

    key: str
    check: Sequence[str] = ()
    updated_at: str | None = None

    def __post_init__(self) -> None:
        if bool(self.check) == bool(self.updated_at):
            raise ValueError("give either check columns or an updated_at column")


ORDER_STATUS = HistorySpec(key="order_id", check=("order_status",))


def at(moment: datetime) -> Column:
    """A zone-free timestamp literal."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def open_versions(incoming: DataFrame, spec: HistorySpec, as_of: datetime) -> DataFrame:
    """The incoming rows as open versions: the whole history after a first run."""
    since = F.col(spec.updated_at) if spec.updated_at else at(as_of)
    return incoming.select(
        "*",
        hashed_key(F.col(spec.key), since, separator="|").alias("scd_id"),
        since.alias("updated_at"),
        since.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )


def changes(
    open_rows: DataFrame, incoming: DataFrame, spec: HistorySpec, as_of: datetime
) -> DataFrame:
    """What a run does to the open versions: the versions it closes and those it opens.

    A new key opens a version; a changed row closes its version and opens another; for an
    unchanged row and a key missing from ``incoming`` nothing is returned. One outer join on
    the key, in which a null key is a key like any other. Both sides hold one row per key;
    :func:`snapshot` refuses inputs that do not.
    """
    data = incoming.columns
    fresh = open_versions(incoming, spec, as_of)
    old, new = F.col("__old"), F.col("__new")
    left = open_rows.select(F.col(spec.key).alias("__old_key"), F.struct(*data, *MANAGED).alias("__old"))
    right = fresh.select(F.col(spec.key).alias("__new_key"), F.struct(*data, *MANAGED).alias("__new"))
    pairs = left.join(right, F.col("__old_key").eqNullSafe(F.col("__new_key")), "right")
    closed = F.struct(
        *[old[name].alias(name) for name in (*data, "scd_id", "updated_at", "valid_from")],
        new["valid_from"].alias("valid_to"),
    )
    versions = F.when(old.isNull(), F.array(new)).when(_changed(old, new, spec), F.array(closed, new))
    return pairs.select(F.explode(versions).alias("__version")).select("__version.*")


def scd2_apply(
    open_rows: DataFrame, incoming: DataFrame, spec: HistorySpec, as_of: datetime
) -> DataFrame:
    """The open versions of the previous run after this run's rows: what :func:`changes`
    returns and the versions it leaves as they are.

    Closed versions of earlier runs never change and are not read.
    """
    data = incoming.columns
    fresh = open_versions(incoming, spec, as_of)
    old, new = F.col("__old"), F.col("__new")
    left = open_rows.select(F.col(spec.key).alias("__old_key"), F.struct(*data, *MANAGED).alias("__old"))
    right = fresh.select(F.col(spec.key).alias("__new_key"), F.struct(*data, *MANAGED).alias("__new"))
    pairs = left.join(right, F.col("__old_key").eqNullSafe(F.col("__new_key")), "full")
    closed = F.struct(
        *[old[name].alias(name) for name in (*data, "scd_id", "updated_at", "valid_from")],
        new["valid_from"].alias("valid_to"),
    )
    versions = (
        F.when(old.isNull(), F.array(new))
        .when(new.isNull() | ~F.coalesce(_changed(old, new, spec), F.lit(False)), F.array(old))
        .otherwise(F.array(closed, new))
    )
    return pairs.select(F.explode(versions).alias("__version")).select("__version.*")


def _changed(old: Column, new: Column, spec: HistorySpec) -> Column:
    if spec.updated_at:
        return new["updated_at"] > old["updated_at"]
    return reduce(
        lambda left, right: left | right,
        [~old[name].eqNullSafe(new[name]) for name in spec.check],
    )


def current_versions(history: DataFrame) -> DataFrame:
    return history.where(F.col("valid_to").isNull())


# Stored form: one folder per run with the versions closed and the versions opened in it, so a
# run writes what it changed and nothing else. The versions open now are those opened in some
# run and closed in none. ``compact`` writes them as a new base, in a folder of its own.
# Each attempt at a run or base has its own folder; a small file named after the run, written
# last, says which attempt counts.

RUN, BASE = "run", "base"


def run_label(as_of: datetime) -> str:
    return as_of.strftime("%Y%m%dT%H%M%S")


def committed_runs(spark: SparkSession, root: str) -> list[str]:
    """Labels of the finished runs, oldest first."""
    return names(spark, f"{root}/{RUN}")


class RepeatedKeys(ValueError):
    """The input of a run has a key more than once."""


def snapshot(
    incoming: DataFrame,
    root: str,
    spec: HistorySpec,
    as_of: datetime,
    run: str | None = None,
    check: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """One run: compare with the versions open after the run before it, store, read back.

    Labels order the runs; repeating the last run replaces it. A key that occurs more than
    once in ``incoming`` is refused, null as well as others. ``check`` gets the history as it
    would be and may raise: the run is committed only after it. The work grows with the
    changes since the last compaction and the open versions; what is written grows with the
    changes of the run.
    """
    spark = incoming.sparkSession
    label = run or run_label(as_of)
    done = committed_runs(spark, root)
    if any(other > label for other in done):
        raise ValueError(f"run {label} is older than the last run {done[-1]}")
    repeated = incoming.groupBy(spec.key).count().where("count > 1").limit(3).collect()
    if repeated:
        raise RepeatedKeys(f"{spec.key} occurs more than once: {[row[0] for row in repeated]}")
    before = [other for other in done if other < label]
    state = open_rows(spark, root, before)
    new = open_versions(incoming, spec, as_of) if state is None else changes(state, incoming, spec, as_of)
    marked = new.withColumn("state", F.when(F.col("valid_to").isNull(), "opened").otherwise("closed"))
    attempt = f"{root}/{RUN}/attempts/{label}-{uuid.uuid4().hex}"
    marked.write.partitionBy("state").parquet(attempt)
    if check is not None:
        check(_history(spark, root, before, attempt))
    commit(spark, f"{root}/{RUN}", label, attempt)
    return read_history(spark, root)


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """All versions: those closed in any finished run and those open after the last one."""
    runs = committed_runs(spark, root)
    if not runs:
        raise ValueError(f"no finished run in {root}")
    return _history(spark, root, runs)


def compact(spark: SparkSession, root: str) -> None:
    """Write the versions open now as a base, so that later runs read it and not the runs before.

    The versions closed until then stay where they are. The base names the attempt at the last
    run that it was built from; if that run is repeated afterwards, the base no longer counts.
    Runs before the last one cannot be repeated. Meant as a job of its own.
    """
    runs = committed_runs(spark, root)
    state = open_rows(spark, root, runs)
    if state is None:
        raise ValueError(f"no finished run in {root}")
    built_from = folder_of(spark, f"{root}/{RUN}", runs[-1])
    attempt = f"{root}/{BASE}/attempts/{runs[-1]}-{uuid.uuid4().hex}"
    state.write.parquet(attempt)
    commit(spark, f"{root}/{BASE}", runs[-1], f"{attempt}\n{built_from}")


def _last_base(spark: SparkSession, root: str, runs: Sequence[str]) -> tuple[str, str | None]:
    """Label and folder of the last base at or before the last run that is still of its runs."""
    for label in reversed(names(spark, f"{root}/{BASE}")):
        if label in runs:
            folder, _, built_from = folder_of(spark, f"{root}/{BASE}", label).partition("\n")
            if built_from == folder_of(spark, f"{root}/{RUN}", label):
                return label, folder
    return "", None


def open_rows(spark: SparkSession, root: str, runs: Sequence[str], attempt: str | None = None) -> DataFrame | None:
    """The versions open after ``runs``, and after an attempt that is not committed yet.

    Read from the last base at or before the last run and the runs after it; no pointer of an
    older run is read.
    """
    base, folder = _last_base(spark, root, runs)
    later = [folder_of(spark, f"{root}/{RUN}", label) for label in runs if label > base]
    later += [attempt] if attempt else []
    opened = [path for folder_ in later for path in _paths(spark, f"{folder_}/state=opened")]
    closed = [path for folder_ in later for path in _paths(spark, f"{folder_}/state=closed")]
    parts = ([folder] if folder else []) + opened
    if not parts:
        return None
    found = spark.read.parquet(parts[0])
    if len(parts) > 1:
        found = found.unionByName(spark.read.schema(found.schema).parquet(*parts[1:]))
    if closed:
        ended = spark.read.schema(found.schema).parquet(*closed).select("scd_id")
        found = found.join(ended, "scd_id", "left_anti").select(*found.columns)
    return found


def _history(spark: SparkSession, root: str, runs: Sequence[str], attempt: str | None = None) -> DataFrame:
    history = open_rows(spark, root, runs, attempt)
    folders = [folder_of(spark, f"{root}/{RUN}", label) for label in runs] + ([attempt] if attempt else [])
    if history is None:
        # A first run without rows.
        return spark.read.parquet(*folders)
    closed = [path for folder in folders for path in _paths(spark, f"{folder}/state=closed")]
    if closed:
        history = history.unionByName(spark.read.schema(history.schema).parquet(*closed))
    return history


# Measures over a history.


def time_in_status(history: DataFrame, as_of: datetime) -> DataFrame:
    """Every version with the clock hours it lasted; open versions last until ``as_of``."""
    end = F.coalesce("valid_to", at(as_of))
    return history.select(
        "order_id",
        "order_status",
        "valid_from",
        "valid_to",
        hours_between(F.col("valid_from"), end).alias("hours_in_status"),
    )


def status_transitions(history: DataFrame) -> DataFrame:
    """Status changes per order; 0 if it never changed."""
    return history.groupBy("order_id").agg((F.count(F.lit(1)) - 1).alias("transitions"))
