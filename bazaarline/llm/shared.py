"""Helpers of the operators: tables in the shared folder, words, files that every node reaches."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarline.sources.writers import fresh_path

# White space between words: the blank and the control characters from tab to carriage return.
SPACE = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write the relation below the shared folder and read it back.

    What is above no longer depends on the executors that made it, is computed once, and has
    a size that the optimizer knows.
    """
    path = fresh_path(df.sparkSession, name)
    if (turn := _turn.get()) is not None:
        _tables.setdefault(turn, []).append(path)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Tables stored in a turn of several steps, to be deleted when the next step begins.
_turn: ContextVar[str | None] = ContextVar("turn", default=None)
_tables: dict[str, list[str]] = {}


@contextmanager
def step(spark: SparkSession, turn: str) -> Iterator[None]:
    """A step of ``turn``: the tables that the step before stored are deleted first.

    For steps whose results are written before the next one begins; then nothing reads their
    tables any more, and the shared folder holds those of one step at a time.
    """
    for name in _tables.pop(turn, []):
        deleted(spark, name)
    before = _turn.set(turn)
    try:
        yield
    finally:
        _turn.reset(before)


def deleted(spark: SparkSession, name: str) -> None:
    """Delete a working folder that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def batches_of(spark: SparkSession, most: int) -> Iterator[None]:
    """Python workers get batches of about ``most`` bytes, one row at least, from what runs inside.

    A batch has 10,000 rows else, of any length, and stays in memory on both sides.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lower_ascii(value: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(value, upper, upper.lower())


def slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about ``most`` bytes; a longer text is a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for k, size in enumerate(sizes):
        if total and total + size > most:
            yield batch.slice(start, k - start)
            start, total = k, 0
        total += int(size)
    if start < len(batch):
        yield batch.slice(start)


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that every node reaches."""
    return pafs.FileSystem.from_uri(uri if ":/" in uri else os.path.abspath(uri))


def publish(store: pafs.FileSystem, written: str, name: str) -> None:
    """Give a finished file its name; readers never see a half-written one."""
    store.move(written, name)
