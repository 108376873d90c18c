"""WARC archives: one gzip stream made into a member per record, with an index of offsets."""

from __future__ import annotations

import gzip
import json
import uuid
import zlib
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarline.llm.shared import open_store, publish, stored, text_or_empty
from bazaarline.sources.writers import fresh_path

LEVEL = 6
CHUNK = 1 << 20
READ_RECORDS = 2000  # records that a task reads, about
# Fixed values of the WARC format.
VERSION = b"WARC/1.1\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"

INDEX_SCHEMA = "file string, record bigint, offset bigint, length bigint, record_type string, record_id string"


# --- records ----------------------------------------------------------------------------------


def record_bytes(
    record_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None
) -> bytes:
    """A response record with the payload, or a revisit record without it.

    Both carry the HTTP head with the length of the full payload, and its digest.
    """
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url:
        # A line end would end the field.
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", REVISIT)]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return VERSION + lines.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return {n.strip().lower(): v.strip() for n, _, v in (line.partition(":") for line in lines if line)}


def split_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and bytes of every record of an inflated stream, one record in memory."""
    buffer = bytearray()
    for chunk in chunks:
        buffer += chunk
        while (end := buffer.find(b"\r\n\r\n")) >= 0:
            fields = fields_of(bytes(buffer[:end]))
            size = end + 4 + int(fields["content-length"]) + 4
            while len(buffer) < size:
                more = next(chunks, None)
                if more is None:
                    raise ValueError("the archive ends inside a record")
                buffer += more
            yield fields, bytes(buffer[:size])
            del buffer[:size]
    if buffer:
        raise ValueError("the archive ends inside a record")


def inflated(file) -> Iterator[bytes]:
    """The plain bytes of a gzip file of one or more members, read once from start to end.

    Zero bytes between and after members are padding, as some writers leave it. A file that
    ends inside a member, cut anywhere in its data or checksum, raises ValueError.
    """
    unpack = None
    while data := file.read(CHUNK):
        while data:
            if unpack is None:
                data = data.lstrip(b"\0")
                if not data:
                    break
                unpack = zlib.decompressobj(wbits=31)
            if plain := unpack.decompress(data, CHUNK):
                yield plain
            if unpack.eof:
                data, unpack = unpack.unused_data, None
            else:
                data = unpack.unconsumed_tail
    if unpack is not None:
        raise ValueError("the archive ends inside a gzip member")


# --- archives ---------------------------------------------------------------------------------


def page_urn(page_id: Column) -> Column:
    return F.concat(F.lit(URN), F.coalesce(page_id.cast("string"), F.lit("none")))


def record_types(pages: DataFrame, min_bytes: int) -> DataFrame:
    """``page_id, url, html, digest, refers_to``: null for responses, else the page revisited.

    Only digests and page ids are grouped and joined with the pages; a payload that many pages
    have is a frequent key of that join, which adaptive execution splits.
    """
    html = text_or_empty("html")
    rows = pages.select("page_id", "url", html.alias("html"), F.sha2(html, 256).alias("digest"))
    first = (
        rows.where(F.octet_length("html") >= min_bytes)
        .groupBy(F.col("digest").alias("first_digest"))
        .agg(F.min("page_id").alias("first_page"), F.count("*").alias("pages"))
        .where("pages > 1")
        .drop("pages")
    )
    joined = rows.join(first.hint("shuffle_merge"), F.col("digest") == F.col("first_digest"), "left")
    known = F.col("page_id").eqNullSafe(F.col("first_page"))
    return joined.select("page_id", "url", "html", "digest", F.when(~known, F.col("first_page")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int) -> DataFrame:
    """Write each partition's pages as one archive that is a single gzip stream.

    Result, stored: ``file, records`` of the archives of finished tasks. A task writes under a
    name of its own, so a repeated task leaves at most a file that nothing names.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        name, records = f"{uuid.uuid4().hex}.warc.gz", 0
        out = packed = None
        for batch in batches:
            for record_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if packed is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(f"{root}/.{name}", compression=None)
                    packed = gzip.GzipFile(fileobj=out, mode="wb", compresslevel=LEVEL, mtime=0)
                payload = html.encode("utf-8", "surrogatepass")
                packed.write(record_bytes(record_id, url, payload, digest, refers_to))
                records += 1
        if packed is not None:
            packed.close()
            out.close()
            publish(store, f"{root}/.{name}", f"{root}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records], pa.int64())], names=["file", "records"])

    typed = record_types(pages, min_bytes).select(
        page_urn(F.col("page_id")).alias("record_id"),
        "url",
        "html",
        "digest",
        F.when(F.col("refers_to").isNotNull(), page_urn(F.col("refers_to"))).alias("refers_to"),
    )
    return stored(typed.mapInArrow(write, "file string, records bigint"), "archives")


def normalise_archives(archives: DataFrame, source: str, folder: str) -> DataFrame:
    """Rewrite archives of ``source`` so that every record is a gzip member of its own.

    Each archive is inflated once from start to end, whatever its members are. Beside the new
    archive stands its index, a line of JSON per record with offset, length, type and id.
    Result, stored: the index lines of all archives with ``INDEX_SCHEMA``.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        old, old_root = open_store(source)
        store.create_dir(root, recursive=True)
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                name = f"{uuid.uuid4().hex}.warc.gz"
                lines = []
                offset = 0
                with (
                    old.open_input_stream(f"{old_root}/{archive}", compression=None) as file,
                    store.open_output_stream(f"{root}/.{name}", compression=None) as out,
                    store.open_output_stream(f"{root}/.{name}.index", compression=None) as index,
                ):
                    for record, (fields, data) in enumerate(split_records(inflated(file))):
                        member = gzip.compress(data, LEVEL, mtime=0)
                        out.write(member)
                        line = (name, record, offset, len(member), fields["warc-type"], fields["warc-record-id"][1:-1])
                        index.write(json.dumps(line[1:]).encode() + b"\n")
                        lines.append(line)
                        offset += len(member)
                publish(store, f"{root}/.{name}.index", f"{root}/{name}.index")
                publish(store, f"{root}/.{name}", f"{root}/{name}")
                columns = zip(*lines, strict=True) if lines else [[]] * 6
                types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)],
                    names=["file", "record", "offset", "length", "record_type", "record_id"],
                )

    # Rows are small and their work is not: as many tasks as archives.
    apart = archives.select("file").repartition(max(1, archives.count()))
    return stored(apart.mapInArrow(rewrite, INDEX_SCHEMA), "archive-index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Read the indexed records, each by its offset.

    ``record_id, payload_bytes, payload_digest, record_type, refers_to, payload``; the payload
    of a response is checked against its digest, a revisit has none.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        name = file = None
        for batch in batches:
            told = []
            for row in batch.to_pylist():
                if row["file"] != name:
                    name = row["file"]
                    file = store.open_input_file(f"{root}/{name}")
                data = gzip.decompress(file.read_at(row["length"], row["offset"]))
                head, _, rest = data.partition(b"\r\n\r\n")
                fields = fields_of(head)
                block = rest[: int(fields["content-length"])]
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(fields_of(http)["content-length"])
                digest = fields["warc-payload-digest"].removeprefix("sha256:")
                kind = fields["warc-type"]
                if kind == "response" and (len(payload) != size or sha256(payload).hexdigest() != digest):
                    raise ValueError(f"{fields['warc-record-id']} is damaged")
                refers_to = fields.get("warc-refers-to")
                told.append(
                    (
                        fields["warc-record-id"][1:-1],
                        size,
                        digest,
                        kind,
                        refers_to[1:-1] if refers_to else None,
                        payload if kind == "response" else None,
                    )
                )
            if told:
                types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
                names = ["record_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
                columns = [pa.array(c, t) for c, t in zip(zip(*told, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "record_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, payload binary"
    run = F.floor(F.col("record") / READ_RECORDS)
    spread = index.repartition(max(1, index.count() // READ_RECORDS), "file", run).sortWithinPartitions("file", "offset")
    return spread.select("file", "offset", "length").mapInArrow(read, schema)


def page_of(urn: Column) -> Column:
    return F.try_to_number(F.substring_index(urn, ":", -1), F.lit("S" + "9" * 19)).cast("long")


def archive_folder(spark: SparkSession, name: str) -> str:
    return fresh_path(spark, name)


def round_trip(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """Write the pages as archives, normalise these and read them back by their index.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to`` for each row of
    ``pages``. Of the pages with equal payloads of at least ``min_bytes`` bytes the one with
    the smallest ``page_id`` is a response and the others revisit it; rows with that same id
    and payload are responses too. Shorter payloads are all responses. A null payload is
    empty. A null ``page_id`` stays null; such a row revisits a known page with its payload
    and is a response if there is none. Columns other than ``page_id, url, html`` are ignored.
    An empty table writes no archive.
    """
    spark = pages.sparkSession
    whole, normal = archive_folder(spark, "warc-whole"), archive_folder(spark, "warc")
    index = normalise_archives(write_archives(pages, whole, min_bytes), whole, normal)
    read = read_records(index, normal)
    return read.select(
        page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
    )
