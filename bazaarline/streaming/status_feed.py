"""Status history fed by a stream of order rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from bazaarline.operators.history import ORDER_STATUS, HistorySpec, committed_runs, compact, open_rows, snapshot
from bazaarline.operators.latest import latest_per_key


def utc_now(batch_id: int) -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def follow_status(
    feed: DataFrame,
    root: str,
    checkpoint: str,
    arrival: str,
    spec: HistorySpec = ORDER_STATUS,
    as_of: Callable[[int], datetime] = utc_now,
    compact_every: int = 20,
) -> StreamingQuery:
    """Start applying ``feed`` to the history under ``root``, one run per micro-batch.

    ``arrival`` orders the rows of a key, within a batch and across batches: it is kept in the
    stored versions, and a row that arrives late, with an older or the same ``arrival`` as the
    version it would close, is ignored. Of rows of one key with equal ``arrival`` in a batch
    the one with the largest values in the other columns, in their order, counts. A row that
    repeats the stored status leaves the stored version, and its ``arrival``, as they are. The batch
    number is the run label, so a batch repeated after a failure replaces its own run and the
    history holds it once. A batch may hold changed orders only: keys it does not name stay as
    they are. After every ``compact_every`` runs a base is written, so a batch reads
    at most that many runs.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        label = f"{batch_id:012d}"
        others = [name for name in batch.columns if name not in (spec.key, arrival)]
        rows = latest_per_key(batch, keys=[spec.key], order_by=arrival, tiebreak=others)
        before = [run for run in committed_runs(spark, root) if run < label]
        state = open_rows(spark, root, before)
        if state is not None:
            newest = state.select(F.col(spec.key).alias("__key"), F.col(arrival).alias("__arrival"))
            late = F.col(spec.key).eqNullSafe(F.col("__key")) & (F.col(arrival) <= F.col("__arrival"))
            rows = rows.join(newest, late, "left_anti")
        snapshot(rows, root, spec, as_of(batch_id), run=label)
        if (len(before) + 1) % compact_every == 0:
            compact(spark, root)

    return (
        feed.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
