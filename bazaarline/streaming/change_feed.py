"""A change feed in event time: rows in any order become changes and a spliced history."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from bazaarline.operators.changelog import LogSpec, apply_rows, compact
from bazaarline.sources.commits import names


def follow_log(
    feed: DataFrame, root: str, checkpoint: str, spec: LogSpec, compact_every: int = 20
) -> StreamingQuery:
    """Start placing ``feed`` in the history under ``root``, one run per micro-batch.

    Rows of a key may come in any order: a late one cuts the stored piece that holds its
    instant. The batch number is the run label, so a batch repeated after a failure replaces
    its own run; a base is written after every ``compact_every`` runs. Rows without an instant
    are left out.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        apply_rows(spark, batch, root, spec, run=f"{batch_id:012d}")
        if len(names(spark, f"{root}/run")) % compact_every == 0:
            compact(spark, root, spec)

    return (
        feed.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def changes_in_time(feed: DataFrame, spec: LogSpec, delay: str, idle: str | None = None) -> DataFrame:
    """The changes of each key in the order of their instants, as an append-only stream.

    Rows wait in the state of their key until the watermark, ``delay`` behind the latest instant
    seen, has passed them; then those that change the state of the key are given out, once and
    in order. Repeated rows are dropped while the watermark has not passed them. Rows older
    than the watermark are dropped by it: feed those to :func:`follow_log`, which places any.

    The state of a key is what waits and the last state given out; with ``idle`` a key without
    rows for so long in event time is forgotten, so the state is bounded by the rows of that time.
    A forgotten key that comes back gives out its state even if it is the old one; versions
    made of the changes are the same.
    """
    moment = F.col(spec.at).cast("timestamp")
    rows = feed.select(spec.key, moment.alias(spec.at), *spec.state).withWatermark(spec.at, delay)
    rows = rows.dropDuplicatesWithinWatermark([spec.key, spec.at, *spec.state])
    # Instants go through the state as microseconds, so no time zone matters.
    timed = rows.select(spec.key, spec.at, F.unix_micros(spec.at).alias(MICROS), *spec.state)
    names_, n = list(spec.state), len(spec.state)
    kind = {f.name: f.dataType.simpleString() for f in timed.schema}
    schema = ", ".join(f"`{name}` {kind[name]}" for name in (spec.key, MICROS, *names_))
    waits = ", ".join(f"`{name}` array<{kind[name]}>" for name in (MICROS, *names_))
    last = ", ".join(f"`last_{name}` {kind[name]}" for name in names_)
    patience = None if idle is None else int(pd.Timedelta(idle).value // 1000)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else None
        waiting = list(zip(*held[: n + 1], strict=True)) if held else []
        given = tuple(held[n + 1 : -1]) if held and held[-1] else None
        for batch in batches:
            # Held rows are plain already.
            waiting += zip(*(map(_plain, batch[name].tolist()) for name in (MICROS, *names_)), strict=True)
        mark = state.getCurrentWatermarkMs() * 1000
        # At one instant the largest state counts.
        passed = {row[0]: row for row in sorted((row for row in waiting if row[0] <= mark), key=_order)}
        waiting = [row for row in waiting if row[0] > mark]
        out = []
        for row in passed.values():
            if given is None or row[1:] != given:
                out.append((*key, *row))
                given = row[1:]
        if state.hasTimedOut and not waiting and not passed:
            state.remove()
        else:
            lists = list(map(list, zip(*waiting, strict=True))) if waiting else [[] for _ in range(n + 1)]
            state.update((*lists, *(given or [None] * n), given is not None))
            wake = min((row[0] for row in waiting), default=None if patience is None else mark + patience)
            if wake is not None:
                state.setTimeoutTimestamp(max(wake, mark) // 1000 + 1)
        if out:
            yield pd.DataFrame(dict(zip((spec.key, MICROS, *names_), zip(*out, strict=True), strict=True)))

    changes = timed.groupBy(spec.key).applyInPandasWithState(
        step, schema, f"{waits}, {last}, known boolean", "append", GroupStateTimeout.EventTimeTimeout
    )
    at = F.timestamp_micros(MICROS).cast("timestamp_ntz").alias(spec.at)
    return changes.select(spec.key, at, *spec.state)


MICROS = "__micros"


def _plain(value):
    """A value that the state can hold."""
    if value is None or value is pd.NaT or value != value:
        return None
    return value.item() if hasattr(value, "item") else value


def _order(row: tuple) -> tuple:
    """Instant, then state; null is least."""
    return row[0], tuple((value is not None, "" if value is None else value) for value in row[1:])


def write_changes(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start writing changes as files: the sink's own log makes a repeated batch count once."""
    return (
        changes.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
