"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

_RANK = "__rank"


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_by: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Keep the row with the greatest ``order_by`` of every key; nulls lose.

    The filter on the rank lets Spark cut every key to one row per input partition before
    the shuffle, so a key with a third of all rows ships a few rows, not its whole group.
    """
    order = [F.col(name).desc_nulls_last() for name in (order_by, *tiebreak)]
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)
