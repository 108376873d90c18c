"""Distinct entities over days: bitmaps that can be merged, and running counts without a grid."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from bazaarline.operators.calendar import date_spine
from bazaarline.sources.writers import materialize_table


def numbered(entities: DataFrame, entity: str, path: str) -> DataFrame:
    """Every distinct entity with a number, stored at ``path``; for ids that are not whole numbers.

    Numbers are dense within the tasks that gave them, so entities share bitmaps; a null entity
    gets none.
    """
    distinct = entities.where(F.col(entity).isNotNull()).select(entity).distinct()
    return materialize_table(distinct.withColumn("number", F.monotonically_increasing_id()), path)


def daily_bitmaps(rows: DataFrame, day: Column, number: Column) -> DataFrame:
    """``day, bucket, bitmap``: which numbers a day has, 32,768 of them to a bitmap.

    Rows without a day or number are left out. Bitmaps are made before the shuffle, so a hot
    day or number is shuffled once per task.
    """
    placed = rows.select(F.to_date(day).alias("day"), number.cast("bigint").alias("__number")).where("day is not null and __number is not null")
    bit = F.bitmap_construct_agg(F.bitmap_bit_position("__number"))
    return placed.groupBy("day", F.bitmap_bucket_number("__number").alias("bucket")).agg(bit.alias("bitmap"))


def distinct_by(daily: DataFrame, period: Column) -> DataFrame:
    """``period, distinct_count``: exact numbers of distinct entities from daily bitmaps alone."""
    merged = daily.groupBy(period.alias("period"), "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"))
    return merged.groupBy("period").agg(F.sum("n").alias("distinct_count"))


def prefix_sums(rows: DataFrame, order: str, value: str, block: Column) -> DataFrame:
    """``rows`` with ``value`` summed up to each row in the order of the unique ``order``.

    In two levels: within blocks, which ascend with the order, and over the blocks before. Blocks
    are whole numbers from 0 to 2^31. The sums of 1, 2, 4, ... neighbours are made once; the blocks
    before a block are one such run for each bit of its number, so no task sees all blocks.
    """
    within = Window.partitionBy("__block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    dealt = rows.withColumn("__block", block.cast("bigint"))
    sums = dealt.groupBy("__block").agg(F.sum(value).alias("__sum"))
    bits = sums.select("*", F.explode(F.sequence(F.lit(0), F.lit(30))).alias("__bit"))
    number = F.expr("shiftright(__block, __bit)")
    runs = bits.groupBy("__bit", number.alias("__run")).agg(F.sum("__sum").alias("__sum"))
    before = bits.where(number % 2 == 1).select(F.col("__block").alias("__of"), "__bit", (number - 1).alias("__run"))
    offsets = before.join(runs, ["__bit", "__run"]).groupBy("__of").agg(F.sum("__sum").alias("__offset"))
    inside = dealt.withColumn("__inside", F.sum(value).over(within))
    summed = inside.join(offsets, F.col("__block") == F.col("__of"), "left")
    total = F.col("__inside") + F.coalesce("__offset", F.lit(0))
    return summed.select(*[c for c in rows.columns if c != value], total.alias(value))


def active_entities(rows: DataFrame, entity: str, day: Column, days: int, start: date, end: date) -> DataFrame:
    """``date_day, active``: how many entities had a row in the ``days`` days up to each day of
    ``[start, end)``.

    A sweep line: an active day opens an interval that ends when it is ``days`` old or at the
    entity's next one, so an entity counts once. Openings and endings are summed by day and then
    along the calendar; the grid of entities and days is never made. Null entities and days
    are left out; rows before ``start`` count as long as they last.
    """
    placed = rows.select(F.col(entity).alias("__entity"), F.to_date(day).alias("__day"))
    placed = placed.where("__entity is not null and __day is not null").distinct()
    following = F.lead("__day").over(Window.partitionBy("__entity").orderBy("__day"))
    opened = placed.withColumn("__until", F.least(F.date_add("__day", days), following))
    edges = opened.select(F.explode(F.array(
        F.struct(F.col("__day").alias("at"), F.lit(1).alias("by")), F.struct(F.col("__until").alias("at"), F.lit(-1).alias("by"))
    )).alias("e"))
    first, last = F.lit(start), F.lit(end - timedelta(days=1))
    moves = edges.select(F.greatest("e.at", first).alias("date_day"), "e.by").where(F.col("date_day") <= last)
    by_day = moves.groupBy("date_day").agg(F.sum("by").alias("by"))
    spine = date_spine(rows.sparkSession, start, end)
    every = spine.join(by_day, "date_day", "left").select("date_day", F.coalesce("by", F.lit(0)).alias("active"))
    return prefix_sums(every, "date_day", "active", 12 * F.year("date_day") + F.month("date_day"))
