"""Lines that many documents share, found in sorted hashes and told as compressed bitmaps."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarline.llm.shared import stored, text_or_empty

BLANKS = b" \t\n\x0b\x0c\r"
BATCH = 8192
RUN_SCHEMA = "hash binary, doc bigint, tag bigint, position int, part int, kind string, docs bigint"
# Kinds of rows: a line that goes; one that goes if its hash has enough documents in all; the
# first line of a hash here, if it may have begun before; what a partition has of such a hash.
GOES, WAITS, LEADS, EDGE = "goes", "waits", "leads", "edge"


def line_keys(text: str) -> list[bytes]:
    """The key of every line: stripped of blanks and A-Z lower-cased, in UTF-8."""
    return [line.strip(BLANKS).lower() for line in text.encode("utf-8", "surrogatepass").split(b"\n")]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every line with a key, 16 bytes of its digest in the place of the text."""
    for batch in batches:
        for start in range(0, len(batch), 256):
            part = batch.slice(start, 256)
            keys = [line_keys(text) for text in part.column(2).to_pylist()]
            rows = [(k, position, key) for k, ks in enumerate(keys) for position, key in enumerate(ks) if key]
            of = pa.array([k for k, _, _ in rows], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([blake2b(key, digest_size=16).digest() for _, _, key in rows], pa.binary()),
                    part.column(0).take(of),
                    part.column(1).take(of),
                    pa.array([position for _, position, _ in rows], pa.int32()),
                ],
                names=["hash", "doc", "tag", "position"],
            )


def _pass(enough: int, keep_first: bool):
    """Streams rows sorted by hash, document and position; holds back fewer than ``enough``
    documents of the hash at hand."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)

    def decided(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        runs = groupby(rows_of(batches), key=itemgetter(0))
        run, at_start = next(runs, None), True
        while run is not None:
            hash_, rows = run
            held: list[tuple] | None = []
            docs, doc, lead, part = 0, None, None, 0
            for _, row_doc, tag, position, part in rows:
                if docs == 0 or row_doc != doc:
                    docs, doc = docs + 1, row_doc
                row = (hash_, row_doc, tag, position, part)
                if keep_first and lead is None:
                    lead = row
                    continue
                if held is not None:
                    held.append(row)
                    if docs >= enough:
                        yield from ((*r, GOES, 0) for r in held)
                        held = None
                else:
                    yield (*row, GOES, 0)
            if docs >= enough and held is not None:
                yield from ((*r, GOES, 0) for r in held)
                held = None
            run = next(runs, None)
            at_edge, ends = at_start, run is None
            if at_edge or ends:
                yield from ((*r, WAITS, 0) for r in held or ())
                if lead is not None and at_edge:
                    yield (*lead, LEADS, 0)
                yield (hash_, None, None, None, part, EDGE, docs)
            at_start = False

    def batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64()]
        names = ["hash", "doc", "tag", "position", "part", "kind", "docs"]

        def pack(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
            )

        waiting: list[tuple] = []
        for row in decided(batches):
            waiting.append(row)
            if len(waiting) == BATCH:
                yield pack(waiting)
                waiting = []
        if waiting:
            yield pack(waiting)

    return batched


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = []
        for positions in batch.column(2).to_pylist():
            keep = np.ones(-(-(max(positions) + 1) // 8) * 8, dtype=bool)  # whole bytes
            keep[positions] = False
            packed.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["doc", "tag", "keep"]
        )


def keep_bits(keep: bytes | None, n_lines: int) -> np.ndarray:
    """Which lines stay: lines beyond the bitmap's end, and all without a bitmap, do."""
    bits = np.ones(n_lines, dtype=bool)
    if keep is not None:
        told = np.unpackbits(np.frombuffer(zlib.decompress(keep), "uint8"), bitorder="little")[:n_lines]
        bits[: len(told)] = told.astype(bool)
    return bits


def line_bitmaps(docs: DataFrame, min_docs: int = 2, keep_first: bool = True) -> DataFrame:
    """``doc, tag, keep`` for each text that loses lines.

    A line's key is the line stripped of blanks and A-Z lower-cased. Keys found in at least
    ``min_docs`` documents lose their lines; with ``keep_first`` the first one, by document and
    position, stays. Lines with an empty key always stay. ``doc`` is the id, ``tag`` the
    ``xxhash64`` of the text, ``keep`` the zlib-compressed bits, one per line up to
    the byte with the last one dropped, least bit first.

    Rows with the same ``doc_id`` count as one document, null ids as one as well, and each row
    has its own bitmap; rows equal in id and text share one. Null and empty texts have one
    empty line. Columns other than ``doc_id`` and ``text`` are ignored; empty tables give none.

    Texts are hashed where they are read and the hashes stored, so the sample for the ranges
    reads a table. Rows are (hash, document, position), range-partitioned by hash and document, so the lines
    of a frequent key lie in several partitions. Each partition is streamed once; only the keys
    at its two ends can go on elsewhere, and their counts, two rows a partition, are joined.
    """
    lines = (
        stored(
            docs.select(F.col("doc_id").cast("long").alias("doc"), text_or_empty("text").alias("text"))
            .select("doc", F.xxhash64("text").alias("tag"), "text")
            .mapInArrow(_hashed, "hash binary, doc bigint, tag bigint, position int"),
            "lines",
        )
        .repartitionByRange("hash", "doc")
        .sortWithinPartitions("hash", "doc", "position", "tag")
        .withColumn("part", F.spark_partition_id())
    )
    told = stored(lines.mapInArrow(_pass(min_docs, keep_first), RUN_SCHEMA), "line-runs")
    edges = (
        told.where(F.col("kind") == EDGE)
        .groupBy("hash")
        .agg(F.sum("docs").alias("all_docs"), F.min("part").alias("begins"))
        .where(F.col("all_docs") >= min_docs)
    )
    late = (
        told.where(F.col("kind").isin(WAITS, LEADS))
        .join(edges, "hash")
        .where((F.col("kind") == WAITS) | (F.col("part") > F.col("begins")))
    )
    gone = told.where(F.col("kind") == GOES).select("doc", "tag", "position")
    return (
        gone.unionByName(late.select("doc", "tag", "position"))
        .groupBy("doc", "tag")
        .agg(F.collect_set("position").alias("positions"))
        .mapInArrow(_bitmaps, "doc bigint, tag bigint, keep binary")
    )


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``doc_id, text, keep`` for each row of ``docs``; ``keep`` is null if all lines stay."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    same = (F.col("doc_id").eqNullSafe(F.col("doc"))) & (F.xxhash64("text") == F.col("tag"))
    # As many bitmaps as texts that lose lines: never broadcast.
    return texts.join(bitmaps.hint("shuffle_merge"), same, "left").select("doc_id", "text", "keep")


def _kept_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, dropped, texts = [], [], []
        for text, keep in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if keep is None:
                total.append(text.count("\n") + 1)
                dropped.append(0)
                texts.append(text)
                continue
            lines = text.split("\n")
            bits = keep_bits(keep, len(lines))
            total.append(len(lines))
            dropped.append(len(lines) - int(bits.sum()))
            texts.append("\n".join(line for line, stays in zip(lines, bits, strict=True) if stays))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(total, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts, pa.string())],
            names=["doc_id", "n_lines", "n_dropped", "kept"],
        )


def kept_texts(docs: DataFrame, min_docs: int = 2, keep_first: bool = True) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` with the text that is left, for each row of ``docs``."""
    joined = with_bitmaps(docs, line_bitmaps(docs, min_docs, keep_first))
    return joined.mapInArrow(_kept_lines, "doc_id bigint, n_lines bigint, n_dropped bigint, kept string")
