"""Where two relations differ: a tree of checksums per relation, compared from the top down.

A relation is stored once, dealt by its key to ``2 ** bits`` buckets, with one checksum a bucket.
Two stored relations are compared level by level: children are looked at only below nodes
that differ, and rows are read only of buckets that differ.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from bazaarline.sources.writers import materialize_table

# Bits of a bucket number that name the folder its rows are stored in.
FOLDER_BITS = 5
# Bits from one level of the tree to the next.
LEVEL_BITS = 4


@dataclass(frozen=True)
class Stored:
    """A relation stored with its tree: ``rows`` and ``leaves`` name folders, ``bits`` its size."""

    rows: str
    leaves: str
    schema: StructType
    keys: tuple[str, ...]
    bits: int


def _hash(columns: Sequence[str]) -> Column:
    """A hash of some columns in which a null counts, wherever it is."""
    named = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(*[c.isNull() for c in named], *named)


def _halves(value: Column) -> tuple[Column, Column]:
    """A long as two numbers whose sums over 2 ** 31 rows still fit a long."""
    return F.shiftright(value, 32), value.bitwiseAND(F.lit(0xFFFFFFFF))


def store(df: DataFrame, path: str, keys: Sequence[str], bits: int = 16) -> Stored:
    """Store the relation below ``path``, and the checksums of its buckets beside it.

    The rows of a bucket lie in one of ``2 ** FOLDER_BITS`` folders, in order of their bucket,
    so that a reader of few buckets skips folders by name and row groups by their limits. No
    key is brought together: rows are dealt by their whole hash within a folder, so a key that
    a third of all rows have is written by many tasks. ``bits`` grows with the relation: about
    one bucket for as many rows as are cheap to read again.

    Keys may be null and may repeat. Columns may have any names but ``__bucket`` and ``__folder``.
    """
    if not FOLDER_BITS <= bits <= 20:
        raise ValueError(f"bits must be from {FOLDER_BITS} to 20")
    spark = df.sparkSession
    bucket = F.pmod(_hash(keys), F.lit(1 << bits)).cast("int")
    placed = df.withColumn("__bucket", bucket).withColumn("__folder", F.shiftright("__bucket", bits - FOLDER_BITS))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.repartition(tasks, "__folder", F.pmod(_hash(df.columns), F.lit(max(1, tasks >> 2))))
    written = dealt.sortWithinPartitions("__folder", "__bucket")
    written.write.mode("overwrite").partitionBy("__folder").parquet(f"{path}/rows")
    stored = Stored(f"{path}/rows", f"{path}/leaves", df.schema, tuple(keys), bits)
    rows = _rows(spark, stored)
    high, low = _halves(_hash(df.columns))
    leaves = rows.groupBy("__bucket").agg(F.count(F.lit(1)).alias("rows"), F.sum(high).alias("high"), F.sum(low).alias("low"))
    materialize_table(leaves, stored.leaves)
    return stored


def _rows(spark: SparkSession, stored: Stored) -> DataFrame:
    schema = StructType(list(stored.schema)).add("__bucket", "integer").add("__folder", "integer")
    return spark.read.schema(schema).parquet(stored.rows)


def differing_buckets(spark: SparkSession, left: Stored, right: Stored) -> list[int]:
    """Numbers of the buckets whose checksums differ, found from the top of both trees down.

    A node's checksum is the sum of those below it. At each level only children of differing
    nodes are summed; the list has at most ``2 ** bits`` numbers whatever the relations hold.
    """
    if (left.bits, left.keys) != (right.bits, right.keys):
        raise ValueError("trees of different keys or sizes cannot be compared")
    sums = ("rows", "high", "low")
    signed = [F.when(F.col("side") == 0, F.col(c)).otherwise(-F.col(c)).alias(c) for c in sums]
    sides = [spark.read.parquet(s.leaves).select("__bucket", *sums, F.lit(k).alias("side")) for k, s in enumerate((left, right))]
    # One row a bucket: at most 2 ** bits.
    net = sides[0].unionByName(sides[1]).select("__bucket", *signed).groupBy("__bucket").agg(*[F.sum(c).alias(c) for c in sums])
    differs = reduce(or_, [F.col(c) != 0 for c in sums])
    nodes, level = [0], 0
    while nodes and level < left.bits:
        above, level = level, min(level + LEVEL_BITS, left.bits)
        node = F.shiftright("__bucket", left.bits - level)
        below = spark.createDataFrame([(n,) for n in nodes], "above int")
        kept = net.join(F.broadcast(below), F.shiftright("__bucket", left.bits - above) == F.col("above"), "left_semi")
        children = kept.groupBy(node.alias("node")).agg(*[F.sum(c).alias(c) for c in sums])
        nodes = sorted(r["node"] for r in children.where(differs).select("node").collect())
    return nodes


def differences(spark: SparkSession, left: Stored, right: Stored) -> DataFrame:
    """The keys whose rows are not the same on both sides: the key columns, ``left_rows``,
    ``right_rows`` and ``differing``, the names of the other columns whose values differ.

    A key of one side only, or of repeated rows whose numbers differ, tells so by its row
    counts. ``differing`` is empty if only the combination of values in repeated rows differs.
    Checksums are sums of 64-bit hashes, so a difference is overlooked with a chance of about
    2 ** -64 a bucket. Rows are grouped, never joined: signed sums of both sides' hashes per
    key, so a key with a third of all rows is summed up before it is shuffled.
    """
    if left.schema.names != right.schema.names:
        raise ValueError("relations of different columns cannot be compared")
    types = [f.dataType for f in left.schema], [f.dataType for f in right.schema]
    if types[0] != types[1]:
        raise ValueError("relations of different types cannot be compared")
    keys = list(left.keys)
    others = [c for c in left.schema.names if c not in keys]
    buckets = differing_buckets(spark, left, right)
    folders = sorted({b >> (left.bits - FOLDER_BITS) for b in buckets})
    wanted = F.broadcast(spark.createDataFrame([(b,) for b in buckets], "__bucket int"))
    limits = F.col("__bucket").between(min(buckets, default=0), max(buckets, default=-1))
    sides = [
        _rows(spark, s)
        .where(F.col("__folder").isin(folders) & limits)
        .join(wanted, "__bucket", "left_semi")
        .select(*[F.col(f"`{c}`") for c in s.schema.names], F.lit(sign).alias("__sign"))
        for s, sign in ((left, 1), (right, -1))
    ]
    sign = F.col("__sign")
    hashes = {"row": _halves(_hash(left.schema.names))} | {f"c{k}": _halves(_hash([c])) for k, c in enumerate(others)}
    net = [F.sum(sign * half).alias(f"__{n}_{i}") for n, pair in hashes.items() for i, half in enumerate(pair)]
    rows = [F.count_if(sign == s).alias(name) for s, name in ((1, "left_rows"), (-1, "right_rows"))]
    met = sides[0].unionByName(sides[1]).groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*rows, *net)

    def moved(name: str) -> Column:
        return (F.col(f"__{name}_0") != 0) | (F.col(f"__{name}_1") != 0)

    named = F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(moved(f"c{k}"), F.lit(c)) for k, c in enumerate(others)]))
    both = (F.col("left_rows") > 0) & (F.col("right_rows") > 0)
    return met.where(moved("row")).select(
        *[F.col(f"`{k}`") for k in keys],
        "left_rows",
        "right_rows",
        F.when(both, named).otherwise(F.array().cast("array<string>")).alias("differing"),
    )
