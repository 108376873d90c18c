"""Token ids in seekable files of independent zstandard frames."""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarline.llm.shared import batches_of, open_store, publish, slices, stored, text_or_empty
from bazaarline.sources.writers import fresh_path

# Fixed values of the seekable zstandard format.
SKIPPABLE, SEEKABLE, HAS_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
SEEK_ENTRY, SEEK_FOOTER = struct.Struct("<III"), struct.Struct("<IBI")
# Own layout: the last data frame lists the documents; its entry is found by the seek table.
LISTED = np.dtype([("doc", "<i8"), ("known", "u1"), ("tokens", "<u8")])

FRAME_BYTES = 1 << 18
LEVEL = 1
MAX_WORDS = 400_000  # words whose ids a worker keeps, about twice as many with older ones
# A mark between a letter and a blank is a piece of its own. Only letters that are one letter
# after normalising, too.
LAST_MARK = r"([A-Za-zÀ-ÖØ-öø-ÿ])([.,;:!?])([ \n])"
LONG_WORD = 48
RUN_DOCS, READ_DOCS = 512, 8192  # documents that are one row, and that a task reads, about
TEXT_BYTES = 2_000_000  # of the texts encoded at a time
BATCH_BYTES = 4_000_000  # of the rows that a worker gets at a time


# --- ids of texts ---------------------------------------------------------------------------


class WordIds:
    """Ids of texts under a vocabulary that drops white space, word by word.

    Nothing in such a vocabulary goes across white space, so the ids of a text are those of its
    words one after the other. The library encodes letters-only words many at a time, as each
    ends with a token that ends a word, and others one by one; their ids are kept, up to a fixed
    number. Texts are lower-cased and marks set apart first, which changes no id, unless they
    may hold the text of a special token.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model = told["model"]
        self.lower = any(n["type"] == "Lowercase" for n in told["normalizer"]["normalizers"])
        suffix = model["end_of_word_suffix"]
        self.ends = np.zeros(max(model["vocab"].values()) + 1, dtype=bool)
        self.ends[[n for token, n in model["vocab"].items() if token.endswith(suffix)]] = True
        self.kind = pa.uint16() if self.small else pa.uint32()
        self.dtype = np.dtype("<u2" if self.small else "<u4")
        none = pa.array([], pa.string()), pa.array([], pa.list_(self.kind))
        self.kept = self.older = none  # words and the ids of each; a word met again moves back

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [found.ids for found in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _new_ids(self, words: list[str]) -> pa.ListArray:
        """Ids by the library; of letters-only words, some hundred are one text."""
        letters = [k for k, w in enumerate(words) if len(w) <= LONG_WORD and w.isalpha()]
        others = np.setdiff1d(np.arange(len(words)), letters).tolist()
        flat, sizes = [], []

        def add(some: list[list[int]]) -> None:
            flat.extend(np.array(ids, self.dtype) for ids in some)
            sizes.extend([len(ids)] for ids in some)

        parts = [[words[k] for k in letters[i : i + 256]] for i in range(0, len(letters), 256)]
        for start in range(0, len(parts), 16):
            some = parts[start : start + 16]
            for part, ids in zip(some, self._encode([" ".join(part) for part in some]), strict=True):
                cut = np.flatnonzero(self.ends[ids]) + 1
                if len(cut) == len(part):
                    flat.append(np.array(ids[: cut[-1]], self.dtype))
                    sizes.append(np.diff(cut, prepend=0))
                else:
                    add(self._encode(part))
        for start in range(0, len(others), 4096):
            add(self._encode([words[k] for k in others[start : start + 4096]]))
        offsets = np.cumsum(np.concatenate([[0], *sizes])).astype("int32")
        ids = np.concatenate([np.array([], self.dtype), *flat])
        found = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, self.kind))
        return found.take(pa.array(np.argsort([*letters, *others], kind="stable"), pa.int64()))

    def ids_of(self, words: pa.Array) -> pa.ListArray:
        """The ids of different words. Words and ids are kept in arrays, in a tenth of the bytes of objects."""
        (kept, kept_ids), (older, older_ids) = self.kept, self.older
        places = pc.index_in(words, value_set=kept)
        unknown = words.filter(places.is_null())
        before = pc.index_in(unknown, value_set=older)
        fresh = unknown.filter(before.is_null())
        again = unknown.filter(before.is_valid())
        added = pa.concat_arrays([again, fresh])
        added_ids = pa.concat_arrays([older_ids.take(before.drop_null()), self._new_ids(fresh.to_pylist())])
        at = np.empty(len(unknown), dtype="int64")
        old = before.is_valid().to_numpy(zero_copy_only=False)
        at[old], at[~old] = np.arange(len(again)), len(again) + np.arange(len(fresh))
        to = places.fill_null(-1).to_numpy().astype("int64")
        to[to < 0] = len(kept) + at
        found = pa.concat_arrays([kept_ids, added_ids]).take(pa.array(to))
        short = pc.less_equal(pc.utf8_length(added), LONG_WORD)
        kept = pa.concat_arrays([kept, added.filter(short)])
        self.kept = kept, pa.concat_arrays([kept_ids, added_ids.filter(short)])
        if len(kept) > MAX_WORDS:
            self.older, self.kept = self.kept, (kept[:0], kept_ids[:0])
        return found

    def encode(self, texts: pa.Array, end_id: int) -> list[bytes]:
        """The ids of each text, ``end_id`` last. Words that come again are looked up once."""
        if self.lower and not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)
        words = pc.ascii_split_whitespace(pc.replace_substring_regex(texts, LAST_MARK, r"\1 \2\3"))
        numbered = words.flatten().dictionary_encode()
        found = self.ids_of(numbered.dictionary)
        lengths = np.append(pc.list_value_length(found).to_numpy().astype("int64"), 1)
        flat = np.append(found.flatten().to_numpy(), end_id).astype(self.dtype)
        starts = np.cumsum(lengths) - lengths
        ends = np.asarray(words.offsets)[1:] - words.offsets[0].as_py()
        at = np.insert(numbered.indices.to_numpy(), ends, len(found))
        n = lengths[at]
        first = np.cumsum(n) - n
        step = np.ones(int(n.sum()), dtype="int64")
        used = np.flatnonzero(n)  # a blank at an end of a text makes an empty word
        step[first[used]] = starts[at[used]] - np.concatenate([[0], (starts + lengths - 1)[at[used[:-1]]]])
        ids = flat[np.cumsum(step)]
        cuts = (first + n)[ends + np.arange(len(ends))].tolist()
        return [ids[i:j].tobytes() for i, j in zip([0, *cuts], cuts, strict=False)]

    @property
    def small(self) -> bool:
        return self.library.get_vocab_size() <= 1 << 16


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def encoded(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """``doc_id, ids`` with the ids of each text, ``width`` bytes each, and the end id."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = word_ids(vocabulary)
        for batch in batches:
            for part in slices(batch, 1, TEXT_BYTES):
                ids = library.encode(part.column(1), end_id)
                width = 2 if library.small else 4
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array([width] * len(ids), pa.int32())],
                    names=["doc_id", "ids", "width"],
                )
                pa.default_memory_pool().release_unused()  # else a worker holds on to its largest part

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    return texts.mapInArrow(encode, "doc_id bigint, ids binary, width int")


# --- files ----------------------------------------------------------------------------------


class FrameWriter:
    """Writes documents into frames and ends the file with the list of documents and the seek table."""

    def __init__(self, out):
        self.out = out
        self.pack = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.waiting, self.size = [], 0
        self.entries: list[tuple[int, int, int]] = []
        self.listed: list[tuple[int, int, int]] = []

    def _frame(self, data: bytes) -> None:
        packed = self.pack.compress(data)
        self.entries.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.out.write(packed)

    def _flush(self) -> None:
        data = b"".join(self.waiting)
        self.waiting, self.size = [], 0
        for start in range(0, len(data), FRAME_BYTES):
            self._frame(data[start : start + FRAME_BYTES])

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """Ids as 32-bit little-endian integers."""
        self.listed.append((doc_id or 0, doc_id is not None, len(ids) // 4))
        self.waiting.append(ids)
        self.size += len(ids)
        if self.size >= FRAME_BYTES:
            self._flush()

    def end(self) -> tuple[int, int]:
        """Documents and tokens of the file."""
        self._flush()
        listed = np.array(self.listed, dtype=LISTED)
        self._frame(listed.tobytes())
        table = b"".join(SEEK_ENTRY.pack(*e) for e in self.entries)
        footer = SEEK_FOOTER.pack(len(self.entries), HAS_CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer)
        return len(listed), int(listed["tokens"].sum())


class FrameReader:
    """Reads documents of one file, decompressing the frames that hold them."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        n, flags, magic = SEEK_FOOTER.unpack(file.read_at(SEEK_FOOTER.size, size - SEEK_FOOTER.size))
        if magic != SEEKABLE or not flags & HAS_CHECKSUMS:
            raise ValueError("not a file of token ids")
        length = n * SEEK_ENTRY.size
        table = file.read_at(length, size - SEEK_FOOTER.size - length)
        entries = np.frombuffer(table, dtype="<u4").reshape(n, 3).astype("int64")
        self.packed, self.plain, self.sums = entries.T
        self.packed_at = np.concatenate([[0], np.cumsum(self.packed)])
        self.plain_at = np.concatenate([[0], np.cumsum(self.plain)])
        self.unpack = zstandard.ZstdDecompressor()
        self.last: tuple[int, bytes] = (-1, b"")
        self.listed = np.frombuffer(self.frame(n - 1), dtype=LISTED)
        self.first_byte = np.concatenate([[0], np.cumsum(self.listed["tokens"].astype("int64") * 4)])

    def frame(self, k: int) -> bytes:
        if self.last[0] != k:
            packed = self.file.read_at(int(self.packed[k]), int(self.packed_at[k]))
            data = self.unpack.decompress(packed, max_output_size=int(self.plain[k]))
            if len(data) != self.plain[k] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.sums[k]:
                raise ValueError(f"frame {k} is damaged")
            self.last = (k, data)
        return self.last[1]

    def read(self, start: int, end: int) -> bytes:
        """Bytes of the ids from ``start`` to ``end``."""
        parts = []
        k = int(np.searchsorted(self.plain_at, start, side="right")) - 1
        while start < end:
            data = self.frame(k)
            at = start - int(self.plain_at[k])
            part = data[at : at + end - start]
            parts.append(part)
            start += len(part)
            k += 1
        return b"".join(parts)

    def document(self, k: int) -> bytes:
        return self.read(int(self.first_byte[k]), int(self.first_byte[k + 1]))


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int) -> DataFrame:
    """Encode the texts and write their ids, ascending by ``doc_id``, into files of ``folder``.

    Result, stored: one row per file with ``part, file, documents, tokens, first_token``, where
    ``first_token`` counts the ids in the files before it. Null ids come last; rows with equal
    ids are ordered by their tokens. Null and empty texts have the end id only. Columns other
    than ``doc_id`` and ``text`` are ignored; an empty table writes no file.

    Texts are encoded where they are read and the ids stored, so they are range-partitioned
    without encoding them twice. A task writes one file under a name of its own and renames it
    when it is whole; only files of finished tasks are in the result, so repeated tasks do no
    harm.
    """
    spark = docs.sparkSession
    with batches_of(spark, BATCH_BYTES):
        ids = stored(encoded(docs, vocabulary, end_id), "token-ids", compression="zstd")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        name = f"{uuid.uuid4().hex}.tok.zst"
        out = writer = None
        part = 0
        for batch in batches:
            for doc_id, ids, width, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if writer is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(f"{root}/.{name}", compression=None)
                    writer = FrameWriter(out)
                wide = np.frombuffer(ids, dtype=f"<u{width}").astype("<u4").tobytes()
                writer.add(doc_id, wide)
        if writer is not None:
            documents, tokens = writer.end()
            out.close()
            publish(store, f"{root}/.{name}", f"{root}/{name}")
            columns = [
                pa.array([part], pa.int32()),
                pa.array([name]),
                pa.array([documents], pa.int64()),
                pa.array([tokens], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "file", "documents", "tokens"])

    sort = [F.asc_nulls_last("doc_id"), F.asc("hash"), F.asc("ids")]
    files = (
        ids.withColumn("hash", F.xxhash64("ids"))
        .repartitionByRange(*sort[:2])
        .sortWithinPartitions(*sort)
        .select("doc_id", "ids", "width", F.spark_partition_id().alias("part"))
        .mapInArrow(write, "part int, file string, documents bigint, tokens bigint")
    )
    with batches_of(spark, BATCH_BYTES):
        files = stored(files, "token-file-list")
    # One row per file, so one task is enough.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first_token", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_token_files(files: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files, checksums verified.

    Each file is read in runs of documents, one row per run, so that the tasks do not depend on
    the sizes of the files.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                starts = np.arange(0, row["documents"], RUN_DOCS)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["file"]] * len(starts)),
                        pa.array([row["first_token"]] * len(starts), pa.int64()),
                        pa.array(starts, pa.int64()),
                    ],
                    names=["file", "first_token", "run"],
                )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        name, reader = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["file"] != name:
                    name = row["file"]
                    reader = FrameReader(store.open_input_file(f"{root}/{name}"))
                ks = range(row["run"], min(row["run"] + RUN_DOCS, len(reader.listed)))
                told = reader.listed[ks.start : ks.stop]
                ids = [reader.document(k) for k in ks]
                known = told["known"].astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(told["doc"], pa.int64(), mask=~known),
                        pa.array(row["first_token"] + reader.first_byte[ks.start : ks.stop] // 4, pa.int64()),
                        pa.array(told["tokens"].astype("int64"), pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    documents = files.agg(F.sum("documents")).first()[0] or 0
    return (
        files.select("file", "documents", "first_token")
        .mapInArrow(runs, "file string, first_token bigint, run bigint")
        .repartition(1 + documents // READ_DOCS, "file", F.floor(F.col("run") / READ_DOCS))
        .sortWithinPartitions("file", "run")
        .mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
    )


def token_folder(spark: SparkSession) -> str:
    return fresh_path(spark, "token-files")


def documents_of(docs: DataFrame, vocabulary: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write the files and read them back: ``doc_id, start, n_tokens, ids`` for each row of ``docs``."""
    folder = folder or token_folder(docs.sparkSession)
    return read_token_files(write_token_files(docs, folder, vocabulary, end_id), folder)


def open_tokens(uri: str) -> FrameReader:
    """A reader of one file, for consumers outside Spark."""
    store, path = pafs.FileSystem.from_uri(uri) if ":/" in uri else (pafs.LocalFileSystem(), uri)
    return FrameReader(store.open_input_file(path))


def crc32(ids: bytes) -> int:
    return zlib.crc32(ids)
