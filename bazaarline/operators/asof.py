"""As-of join: each row meets the last row of its key at or before its instant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from bazaarline.sources.writers import fresh_path, materialize_table


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    at: str,
    values: Sequence[str],
    right_at: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """The columns of ``left`` and the ``values`` of the last row of ``right`` with its key whose
    instant is not after its own.

    One row per row of ``left``, repeated rows too. Where there is no earlier row, or the key or
    the instant is null, the values are null. Of several rows of ``right`` at one instant the
    largest counts, compared by its values in their order. ``values`` replace columns of ``left``
    with the same names.

    No key is brought together: both sides are dealt by ranges of (key, instant), so a hot key
    spans many ranges, and a range that begins inside a key takes the value the ranges before
    it end with. That is one row per range, so it can be broadcast whatever the data.
    """
    spark = left.sparkSession
    tasks = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = [F.col(f"`{c}`") for c in left.columns]
    value = F.struct(*[F.col(f"`{v}`") for v in values]).alias("__value")
    placed = F.col(key).isNotNull() & F.col(at).isNotNull()
    rows = left.select(F.col(key).alias("__key"), F.col(at).alias("__at"), F.lit(1).alias("__side"), F.struct(*own).alias("__row"))
    told = right.select(F.col(key).alias("__key"), F.col(right_at or at).alias("__at"), F.lit(0).alias("__side"), value)
    told = told.where(F.col("__key").isNotNull() & F.col("__at").isNotNull())
    both = told.unionByName(rows.where(F.col("__key").isNotNull() & F.col("__at").isNotNull()), allowMissingColumns=True)

    # Stored, so that a range keeps its rows if an executor is lost.
    dealt = both.repartitionByRange(tasks, "__key", "__at", "__side").withColumn("__range", F.spark_partition_id())
    dealt = materialize_table(dealt, fresh_path(spark, "asof"))

    # In a range rows of the right come first at an instant; the largest of them is the last.
    inside = Window.partitionBy("__range", "__key").orderBy("__at", "__side", "__value").rowsBetween(Window.unboundedPreceding, 0)
    met = dealt.withColumn("__met", F.last(F.when(F.col("__side") == 0, F.struct("__value")), ignorenulls=True).over(inside))

    # One row per range: its first key, and the last row of the right that it holds.
    last = F.max(F.when(F.col("__side") == 0, F.struct("__key", "__at", "__value")))
    ends = dealt.groupBy("__range").agg(F.min("__key").alias("__first"), last.alias("__end"))
    # A range asks for the last end with its first key in the ranges before it.
    asks = ends.select("__range", F.col("__first").alias("__of"), F.lit(None).cast(ends.schema["__end"].dataType).alias("__end"), F.lit(True).alias("__asks"))
    tells = ends.where(F.col("__end").isNotNull()).select("__range", F.col("__end.__key").alias("__of"), "__end", F.lit(False).alias("__asks"))
    earlier = Window.partitionBy("__of").orderBy("__range").rangeBetween(Window.unboundedPreceding, -1)
    carried = asks.unionByName(tells).withColumn("__was", F.max("__end").over(earlier))
    carried = carried.where(F.col("__asks") & F.col("__was").isNotNull()).select(
        F.col("__range").alias("__in"), F.col("__of").alias("__first"), F.col("__was.__value").alias("__carried")
    )
    here = (F.col("__range") == F.col("__in")) & (F.col("__key") == F.col("__first"))
    joined = met.where(F.col("__side") == 1).join(F.broadcast(carried), here, "left")
    found = F.when(F.col("__met").isNotNull(), F.col("__met.__value")).otherwise(F.col("__carried"))
    kept = [c for c in left.columns if c not in values]

    def shown(row: DataFrame) -> DataFrame:
        return row.select(
            *[F.col("__row")[c].alias(c) for c in kept], *[F.col("__found")[v].alias(v) for v in values]
        )

    nowhere = left.where(~placed).select(
        F.struct(*own).alias("__row"), F.lit(None).cast(told.schema["__value"].dataType).alias("__found")
    )
    return shown(joined.withColumn("__found", found)).unionByName(shown(nowhere))
