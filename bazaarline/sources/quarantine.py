"""Readers of text tables that set bad rows aside with the reasons, instead of ending the job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "__corrupt"
REASONS = "reasons"


class TooManyRejected(ValueError):
    """More rows were rejected than the reader accepts; the stored rows tell why."""


@dataclass(frozen=True)
class Sorted:
    """Rows with the types asked for, and the others: their texts as they came and ``reasons``."""

    good: DataFrame
    rejected: DataFrame
    rows: int
    rejected_rows: int


def reasons(schema: StructType, required: Sequence[str] = ()) -> Column:
    """Why a row of texts does not fit the schema: ``column: reason`` for each column at fault.

    A line that cannot be cut into the columns has no other reason than that.
    """

    def reason(field: StructField) -> Column:
        text = F.col(f"`{field.name}`")
        found = F.when(text.isNotNull() & text.try_cast(field.dataType).isNull(), F.lit(f"{field.name}: not {field.dataType.simpleString()}"))
        if field.name in required or not field.nullable:
            found = F.when(text.isNull(), F.lit(f"{field.name}: missing")).otherwise(found)
        return found

    each = F.array_compact(F.array(*[reason(f) for f in schema.fields]))
    return F.when(F.col(CORRUPT).isNotNull(), F.array(F.lit("malformed line"))).otherwise(each)


def load_sorted(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    store: str,
    file_format: str = "csv",
    required: Sequence[str] = (),
    max_share: float = 0.01,
    header: bool = True,
    multi_line: bool = False,
    null_value: str = "",
) -> Sorted:
    """Read a CSV or JSON table; every input row comes out once, as a good or a rejected one.

    All values are read as texts and cast with ``try_cast``, so one pass over the input finds
    every fault of a row. Both kinds are stored below ``store`` in one job, in folders of their
    own; readers of either skip the other. A line that is no record, or that has too few or too
    many values, is rejected whole, with its text in ``__corrupt``. Nulls are good unless the
    column is ``required`` or not nullable. Texts are never cut; an empty input has no rejected
    rows.

    If more than ``max_share`` of all rows are rejected, ``TooManyRejected`` is raised after both
    are stored, so the reasons can be read.
    """
    typed = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if file_format not in ("csv", "json"):
        raise ValueError("only text formats have rows to set aside")
    texts = StructType([StructField(f.name, StringType()) for f in typed.fields]).add(CORRUPT, "string")
    reader = spark.read.schema(texts).options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    if file_format == "csv":
        reader = reader.options(header=header, multiLine=multi_line, escape='"', nullValue=null_value, enforceSchema=not header)
    read = reader.format(file_format).load(path)
    told = read.withColumn(REASONS, reasons(typed, required)).withColumn("__bad", F.size(REASONS) > 0)
    told.write.mode("overwrite").partitionBy("__bad").parquet(store)

    stored = spark.read.schema(told.schema).parquet(store)
    counts = {r["__bad"]: r["count"] for r in stored.groupBy("__bad").count().collect()}
    bad, rows = counts.get(True, 0), sum(counts.values())
    if rows and bad > max_share * rows:
        raise TooManyRejected(f"{bad} of {rows} rows rejected, at most {max_share:.2%} accepted; see {store}")
    good = stored.where("not __bad").select(
        *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in typed.fields]
    )
    return Sorted(good, stored.where("__bad").drop("__bad"), rows, bad)
