"""Raw table readers."""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path
from types import SimpleNamespace
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from bazaarline.sources.schemas import RAW_SCHEMAS

SEED_DIR = Path(__file__).resolve().parents[1] / "seeds"

# Marks a null in CSV, so that it differs from an empty text.
CSV_NULL = "\\N"
# CSV as this library writes it: every text in quotes, quotes doubled.
STORED_CSV = {"header": True, "nullValue": CSV_NULL, "emptyValue": "", "escape": '"', "quoteAll": True}


class RawTables(Protocol):
    """The raw tables every plan starts from."""

    orders: DataFrame
    order_items: DataFrame
    order_payments: DataFrame
    order_reviews: DataFrame
    customers: DataFrame
    sellers: DataFrame
    products: DataFrame
    translations: DataFrame


def load_source(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    file_format: str = "parquet",
    multi_line: bool = False,
    null_value: str = "",
) -> DataFrame:
    """One table with a given schema. Text formats fail on a malformed row.

    ``multi_line`` admits line breaks inside quoted CSV fields; such a file cannot be
    split, so keep it off unless the table holds free text. ``null_value`` is the text that
    stands for null in CSV: nothing between two commas in files from elsewhere, and
    :data:`CSV_NULL` in those of :func:`bazaarline.sources.writers.materialize_table`, where
    an empty text stays one.
    """
    reader = spark.read.schema(schema)
    if file_format == "csv":
        reader = reader.options(
            header=True, nullValue=null_value, mode="FAILFAST", multiLine=multi_line, escape='"'
        )
        if null_value:
            reader = reader.options(emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    elif file_format == "json":
        reader = reader.options(mode="FAILFAST")
    return reader.format(file_format).load(path)


def load_seed(spark: SparkSession, path: str | Path, schema: str) -> DataFrame:
    """A version-controlled CSV with a header, read like any other source.

    The optimizer broadcasts it by its size. Every node has to reach the path; a
    :class:`~pathlib.Path` names a file of this machine, which on a cluster must be there on
    every node, as part of the installed package is.
    """
    uri = path.resolve().as_uri() if isinstance(path, Path) else path
    reader = spark.read.schema(schema).options(
        header=True, enforceSchema=False, mode="FAILFAST", multiLine=True, escape='"'
    )
    return reader.csv(uri)


def load_raw_tables(
    spark: SparkSession,
    root: str,
    file_format: str = "parquet",
    seed: str | Path | None = None,
    names: Mapping[str, str] | None = None,
) -> RawTables:
    """All raw tables under ``root``, one directory or file per table.

    ``names`` gives the path below ``root`` of tables that are not called like their role
    (``orders``, or ``orders.csv`` for CSV).
    """
    suffix = ".csv" if file_format == "csv" else ""
    tables = {
        role: load_source(
            spark,
            f"{root}/{(names or {}).get(role, role + suffix)}",
            schema,
            file_format,
            multi_line=file_format == "csv" and role == "order_reviews",
        )
        for role, schema in RAW_SCHEMAS.items()
        if role != "translations" or seed is None
    }
    if seed is not None:
        tables["translations"] = load_seed(spark, seed, RAW_SCHEMAS["translations"])
    return SimpleNamespace(**tables)
