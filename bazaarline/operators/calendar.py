"""Calendars, and rows filled up to a calendar."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def days_from_to(first: Column, last: Column) -> Column:
    """Array of the days from ``first`` to ``last``, both included; null if there are none.

    Without the guard a descending range would fail instead of being empty.
    """
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day")))


def date_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row ``date_day`` per day from ``start`` up to, not including, ``end``."""
    days = days_from_to(F.lit(start), F.lit(end - timedelta(days=1)))
    return spark.range(1).select(F.explode(days).alias("date_day"))


def densify_calendar(
    daily: DataFrame,
    entity: str,
    day: str,
    measures: Sequence[str],
    start: date,
    end: date,
    flag: str = "had_order",
    partitions: int | None = None,
) -> DataFrame:
    """Every entity on every day of the calendar ``[start, end)``, measures 0 on idle days.

    ``daily`` holds at most one row per entity and day. The result has the columns
    ``entity, date_day, measures..., flag`` and is ordered by entity and day. A null entity
    matches no day, so all its days are idle.

    There is no grid join. The compact daily rows are range partitioned by entity, and each
    row then emits its own day and the idle days up to the entity's next one, so only daily
    rows are shuffled and the grid is produced in its final place and order. Days outside
    the calendar act as markers that keep their entity in the result. ``partitions`` is
    fixed, not merged by input size, because the output is far larger than the input.
    """
    spark = daily.sparkSession
    tasks = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    inside = (F.col(day) >= F.lit(start)) & (F.col(day) < F.lit(end)) & F.col(entity).isNotNull()
    compact = daily.select(
        entity, F.when(inside, F.col(day)).alias("__day"), *measures
    ).repartitionByRange(tasks, entity)

    by_day = Window.partitionBy(entity).orderBy(F.col("__day").asc_nulls_first())
    spans = compact.select(
        entity,
        "__day",
        *measures,
        F.lag("__day").over(by_day).alias("__previous"),
        F.lead("__day").over(by_day).alias("__next"),
        F.lead(F.lit(True)).over(by_day).alias("__more"),
    )
    # A marker followed by another row emits nothing: that row covers the days before it.
    emitting = spans.where(F.col("__day").isNotNull() | F.col("__more").isNull())
    first = F.when(F.col("__previous").isNull(), F.lit(start)).otherwise(F.col("__day"))
    last = F.date_sub(F.coalesce("__next", F.lit(end)), 1)
    grid = emitting.select(
        entity, "__day", *measures, F.explode(days_from_to(first, last)).alias("date_day")
    )

    active = F.col("__day").eqNullSafe(F.col("date_day"))

    def on_active_days(measure: str) -> Column:
        value = F.coalesce(F.when(active, F.col(measure)), F.lit(0))
        return value.cast(daily.schema[measure].dataType).alias(measure)

    return grid.select(entity, "date_day", *map(on_active_days, measures), active.alias(flag))
