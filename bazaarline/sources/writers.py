"""Sinks: views, fully refreshed tables, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from bazaarline.sources.readers import CSV_NULL, STORED_CSV, load_source

TEXT_FORMATS = ("csv", "json")
# The default of text formats cuts timestamps to milliseconds.
FULL_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def shared_dir(spark: SparkSession) -> str:
    """The folder every node can reach, named by ``spark.checkpoint.dir``.

    A temporary folder, one for the application, stands in only for a local master, as in tests.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all nodes")
    return _own_folder(spark.sparkContext.applicationId)


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="bazaarline-")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody else writes to, below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """Register the lazy plan under a name; nothing is computed or stored."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def materialize_table(df: DataFrame, path: str, file_format: str = "parquet") -> DataFrame:
    """Write the whole relation, replacing what was there, and read it back.

    Reading back cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    stored = _escaped(df) if file_format == "csv" else df
    writer = stored.write.mode("overwrite").format(file_format)
    if file_format in TEXT_FORMATS:
        writer = writer.options(timestampNTZFormat=FULL_TIMESTAMP)
    if file_format == "csv":
        writer = writer.options(**STORED_CSV, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    writer.save(path)
    return read_table(df.sparkSession, path, df.schema, file_format)


def read_table(spark: SparkSession, path: str, schema: StructType, file_format: str = "parquet") -> DataFrame:
    """A table that :func:`materialize_table` wrote, with the values it had."""
    texts = any(isinstance(f.dataType, StringType) for f in schema)
    read = load_source(spark, path, schema, file_format, multi_line=texts, null_value=CSV_NULL)
    return _escaped(read, undo=True) if file_format == "csv" else read


def _escaped(df: DataFrame, undo: bool = False) -> DataFrame:
    """A text that begins with a backslash gets a second one, so none is the mark of a null."""

    def column(field: StructField) -> Column:
        text = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, StringType):
            return text
        other = F.substr(text, F.lit(2)) if undo else F.concat(F.lit("\\"), text)
        return F.when(F.startswith(text, F.lit("\\")), other).otherwise(text).alias(field.name)

    return df.select(*[column(field) for field in df.schema])
