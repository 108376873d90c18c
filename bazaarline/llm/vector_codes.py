"""Vectors as short codes: a codebook per part, fitted in rounds with bounds that spare exact rescans."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarline.llm.shared import deleted, stored
from bazaarline.sources.writers import fresh_path

BLOCK = 4096  # vectors worked on at a time
# Up to this sum of squares all integers are exact as doubles; beyond it Python's integers count.
EXACT = 1 << 53
MARGIN = 1e-6  # bounds count as equal within it, far over the rounding of square roots


@dataclass(frozen=True)
class CodeSpec:
    """``parts`` equal parts of a vector, ``entries`` per codebook, ``rounds`` of fitting, and what
    components are multiplied by before they are cut to integers."""

    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096


@dataclass
class Codes:
    """``rows``: a row per kept vector with ``vec_id, label, code, error``; ``history``: the codebooks
    of every round, the last ones final, as ``[part][entry][position]``; ``rescans``: parts whose
    entries were all compared, by round."""

    rows: DataFrame
    history: list[list[list[list[int]]]]
    rescans: list[int] = field(default_factory=list)

    @property
    def codebooks(self) -> list[list[list[int]]]:
        return self.history[-1]


def usable(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    return vector.isNotNull() & ~bad


def _integers(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``, exact: as doubles where they hold it, else as Python's integers."""
    scaled = np.floor(values * float(scale))
    if not len(values) or np.abs(scaled).max() < EXACT:
        return scaled
    return np.array([math.floor(int(x) * scale if x == int(x) else x * scale) for x in values.tolist()], dtype=object)


class Book:
    """The codebooks of all rounds so far, for workers: entries, and how far each moved in all.

    ``moved(since)`` is the distance between an entry as it was at a round and as it is now: the
    norm of the sum of its moves, which is at most the sum of their norms.
    """

    def __init__(self, history: list[list[list[list[int]]]], exact: bool):
        self.exact = exact
        kind = np.float64 if exact else object
        self.at = [np.array(books, dtype=kind).reshape(len(books), -1, len(books[0][0])) for books in history]
        self.now = self.at[-1]
        self.round = len(history) - 1
        # By round of the stamp, part and entry; and the most that any other entry moved.
        self.moved = np.zeros((len(history), *self.now.shape[:2]))
        self.others = np.zeros_like(self.moved)
        if exact:
            for k, old in enumerate(self.at):
                self.moved[k] = np.sqrt(((self.now - old) ** 2).sum(axis=2))
            for entry in range(self.now.shape[1]):
                rest = np.delete(self.moved, entry, axis=2)
                self.others[:, :, entry] = rest.max(axis=2) if rest.shape[2] else 0.0

    def distances(self, part: int, vectors: np.ndarray) -> np.ndarray:
        """Squared distances of vectors to all entries of a part: exact integers."""
        entries = self.now[part]
        if not self.exact:
            return np.array([[sum((a - b) ** 2 for a, b in zip(v, e, strict=True)) for e in entries] for v in vectors], dtype=object)
        return (vectors**2).sum(axis=1)[:, None] - 2.0 * (vectors @ entries.T) + (entries**2).sum(axis=1)[None, :]

    def own(self, part: int, vectors: np.ndarray, codes: np.ndarray) -> np.ndarray:
        return ((vectors - self.now[part][codes]) ** 2).sum(axis=1)


# What a vector carries from round to round, for each part: its entry, the distance to it and to
# the nearest other one as they were measured, and the rounds of both measurements.
STATE = np.dtype([("code", "u1"), ("own_at", "u1"), ("other_at", "u1"), ("own", "<f8"), ("other", "<f8")])


def assign(book: Book, vectors: np.ndarray, state: np.ndarray | None) -> tuple[np.ndarray, int]:
    """The state after this round and the number of parts rescanned.

    A part keeps its entry without a look at the others if its distance to the entry, at most
    that measured once plus the way the entry went since then, is surely less than that to
    any other, at least that measured once less the way the other went since then. If not,
    the own distance is measured again; if that is not enough, all are. Ties go to the lower
    entry, so bounds that may be equal are never enough.
    """
    n, parts = vectors.shape[:2]
    now = np.zeros((n, parts), dtype=STATE) if state is None else state.copy()
    rescanned = 0
    for part in range(parts):
        mine = now[:, part]
        open_rows = np.arange(n)
        if state is not None and book.exact:
            code = mine["code"]
            lower = mine["other"] - book.others[mine["other_at"], part, code]
            upper = mine["own"] + book.moved[mine["own_at"], part, code]
            open_rows = np.flatnonzero(upper + MARGIN >= lower)
            own = np.sqrt(book.own(part, vectors[open_rows, part], code[open_rows]))
            mine["own"][open_rows], mine["own_at"][open_rows] = own, book.round
            open_rows = open_rows[own + MARGIN >= lower[open_rows]]
        if len(open_rows):
            rescanned += len(open_rows)
            found = book.distances(part, vectors[open_rows, part])
            best = found.argmin(axis=1)
            mine["code"][open_rows] = best
            if book.exact:
                rows = np.arange(len(best))
                mine["own"][open_rows] = np.sqrt(found[rows, best])
                found[rows, best] = np.inf
                mine["other"][open_rows] = np.sqrt(found.min(axis=1))
                mine["own_at"][open_rows] = mine["other_at"][open_rows] = book.round
    return now, rescanned


def _sums(vectors: np.ndarray, codes: np.ndarray, entries: int) -> list[dict]:
    """Number and sum of the parts of each entry that is used."""
    found = []
    for part in range(vectors.shape[1]):
        for entry in np.unique(codes[:, part]).tolist():
            chosen = vectors[codes[:, part] == entry, part]
            total = [int(x) for x in chosen.sum(axis=0)]
            found.append({"part": part, "entry": entry, "rows": len(chosen), "total": _limbs(total)})
    return found


# Sums go through Spark in digits of 31 bits, so sums of integers of any size stay exact.
LIMB = 31


def _limbs(values: list[int]) -> list[list[int]]:
    """Digits of each value, the lowest first; the last one carries the sign."""
    found = []
    for value in values:
        digits = []
        while not -(1 << LIMB) <= value < 1 << LIMB:
            digits.append(value & ((1 << LIMB) - 1))
            value >>= LIMB
        found.append([*digits, value])
    return found


def _packed(vectors: np.ndarray, width: int) -> list[bytes]:
    if width <= 8:
        rows = vectors.reshape(len(vectors), -1).astype(f"<i{width}")
        return [row.tobytes() for row in rows]
    return [b"".join(int(x).to_bytes(width, "little", signed=True) for x in row.ravel()) for row in vectors]


def _unpacked(values: pa.Array, width: int, parts: int, exact: bool) -> np.ndarray:
    """Vectors of a column, ``[row][part][position]``."""
    raw = b"".join(values.to_pylist())
    if width <= 8:
        flat = np.frombuffer(raw, f"<i{width}").astype(np.float64 if exact else object)
    else:
        read = [int.from_bytes(raw[k : k + width], "little", signed=True) for k in range(0, len(raw), width)]
        flat = np.array(read, dtype=object)
    return flat.reshape(len(values), parts, len(flat) // max(len(values) * parts, 1))


def _width(top: int) -> int:
    """Bytes of an integer of this absolute value and its sign."""
    return next((w for w in (2, 4, 8) if top < 1 << (8 * w - 1)), top.bit_length() // 8 + 1)


def compress(vectors: DataFrame, spec: CodeSpec = CodeSpec()) -> Codes:
    """Codes of the usable vectors of ``vec_id, embedding, label``.

    Dropped: null vectors and those with a null or non-finite component. The first codebooks
    are the parts of the ``entries`` vectors with the smallest ids (null last, equal ids by
    their components); with fewer vectors there are fewer entries. Each round gives every
    part the nearest entry of its codebook, ties to the lower index, and sets each used entry
    to the floor of the mean of its parts; then parts are assigned once more. Vectors of other
    lengths than the longest, or whose length ``parts`` does not divide, count with zeros
    at their end. Null and repeated ids keep their rows; other columns are ignored; an empty
    table gives no rows.

    A round is one pass over the vectors, as compact integers, with what they carry from the
    round before (:data:`STATE`); there is no shuffle but that of the sums, one row for each entry
    and block. The driver holds the codebooks of all rounds, whose size does not grow with
    the table. What a round wrote is deleted when the next one is written.
    """
    spark = vectors.sparkSession
    kept = vectors.select("vec_id", "label", "embedding").where(usable(F.col("embedding")))
    size = F.size("embedding")
    biggest = F.max(F.coalesce(F.array_max(F.transform("embedding", F.abs)), F.lit(0.0)).cast("double"))
    rows, longest, top = kept.agg(F.count(F.lit(1)), F.max(size), biggest).first()
    if not rows:
        empty = spark.createDataFrame([], kept.drop("embedding").schema).selectExpr("*", "'' as code", f"cast(0 as {_ERROR}) as error")
        return Codes(empty, [[[] for _ in range(spec.parts)]])
    length = max(-(-longest // spec.parts), 1) * spec.parts
    top = (int(top) + 1) * spec.scale
    exact = 4 * (length // spec.parts) * top**2 < EXACT
    width = _width(top)

    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), BLOCK):
                part = batch.slice(k, BLOCK)
                lists = part.column(2)
                sizes = np.diff(np.asarray(lists.offsets))
                flat = _integers(lists.flatten().to_numpy(zero_copy_only=False).astype("float64"), spec.scale)
                full = np.zeros((len(part), length), dtype=flat.dtype)
                full[np.arange(length)[None, :] < sizes[:, None]] = flat
                packed = pa.array(_packed(full, width), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), packed], names=["vec_id", "label", "ints"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.drop("embedding").schema)
    path = fresh_path(spark, "codes")

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{path}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{path}/{name}")

    state = written(kept.mapInArrow(integers, f"{kinds}, ints binary"), "ints")
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(spec.entries).collect()
    seeds = []
    for row in first:
        ints = [int(x) for x in _integers(np.array(row["embedding"], dtype="float64"), spec.scale)]
        seeds.append(np.array([*ints, *[0] * (length - len(ints))], dtype=object).reshape(spec.parts, -1))
    history = [[[seed[part].tolist() for seed in seeds] for part in range(spec.parts)]]
    rescans: list[int] = []
    for number in range(spec.rounds + 1):
        last = number == spec.rounds
        compared = state.mapInArrow(_round(history, spec, width, exact, last), _schema(kinds, last))
        state = stored(compared, "codes") if last else written(compared, f"round-{number}")
        deleted(spark, f"{path}/round-{number - 1}" if number else f"{path}/ints")
        notes = state.where("note is not null").select("note.*")
        rescans.append(notes.agg(F.sum("rescanned")).first()[0])
        if not last:
            history.append(_moved(history[-1], notes))
    return Codes(state.drop("note"), history, rescans)


NOTE = "note struct<rescanned:bigint,sums:array<struct<part:int,entry:int,rows:bigint,total:array<array<bigint>>>>>"


def _schema(kinds: str, last: bool) -> str:
    return f"{kinds}, code string, error {_ERROR}, {NOTE}" if last else f"{kinds}, ints binary, state binary, {NOTE}"


# Wide, as components may have any size; null beyond 38 digits.
_ERROR, _MOST = "decimal(38,0)", 10**38


def _round(history, spec: CodeSpec, width: int, exact: bool, last: bool):
    """One round over the vectors of a partition; the sums of a block stand on its first row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Book(history, exact)
        note_type = pa.struct(
            [
                ("rescanned", pa.int64()),
                (
                    "sums",
                    pa.list_(
                        pa.struct(
                            [
                                ("part", pa.int32()),
                                ("entry", pa.int32()),
                                ("rows", pa.int64()),
                                ("total", pa.list_(pa.list_(pa.int64()))),
                            ]
                        )
                    ),
                ),
            ]
        )
        for batch in batches:
            for k in range(0, len(batch), BLOCK):
                block = batch.slice(k, BLOCK)
                values = _unpacked(block.column(2), width, spec.parts, exact)
                before = None
                if "state" in block.schema.names:
                    raw = b"".join(block.column(block.schema.names.index("state")).to_pylist())
                    before = np.frombuffer(raw, STATE).reshape(len(block), spec.parts)
                now, rescanned = assign(book, values, before)
                codes = now["code"].astype(np.int64)
                note = {"rescanned": rescanned, "sums": [] if last else _sums(values, codes, spec.entries)}
                notes = pa.array([note, *[None] * (len(block) - 1)], note_type)
                if last:
                    errors = sum(book.own(part, values[:, part], codes[:, part]) for part in range(spec.parts))
                    hexes = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
                    told = [pa.array(hexes, pa.string()), pa.array([int(e) if e < _MOST else None for e in errors], pa.decimal128(38, 0))]
                    names = ["vec_id", "label", "code", "error", "note"]
                    columns = [block.column(0), block.column(1), *told, notes]
                else:
                    rows = pa.array([row.tobytes() for row in now], pa.binary())
                    names = ["vec_id", "label", "ints", "state", "note"]
                    columns = [block.column(0), block.column(1), block.column(2), rows, notes]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _moved(books: list[list[list[int]]], notes: DataFrame) -> list[list[list[int]]]:
    """The codebooks after a round: the floor of the mean of the parts of each entry that is used.

    What comes to the driver is a row for each entry, position and digit.
    """
    sums = notes.select(F.explode("sums").alias("s")).select("s.*")
    counts = sums.groupBy("part", "entry").agg(F.sum("rows").alias("rows"))
    values = sums.select("part", "entry", F.posexplode("total").alias("at", "digits"))
    digits = values.select("part", "entry", "at", F.posexplode("digits").alias("digit", "value"))
    totals: dict[tuple[int, int, int], int] = {}
    for row in digits.groupBy("part", "entry", "at", "digit").agg(F.sum("value").alias("value")).collect():
        key = (row["part"], row["entry"], row["at"])
        totals[key] = totals.get(key, 0) + (row["value"] << (LIMB * row["digit"]))
    new = [[list(entry) for entry in part] for part in books]
    for part, entry, rows in counts.collect():
        new[part][entry] = [totals[part, entry, at] // rows for at in range(len(new[part][entry]))]
    return new


def books_digest(books: list[list[list[int]]]) -> str:
    """Sha256 of all components, by part, entry and position, with commas between."""
    text = ",".join(str(x) for part in books for entry in part for x in entry)
    return hashlib.sha256(text.encode()).hexdigest()


def with_label_error(rows: DataFrame) -> DataFrame:
    """The rows with ``label_error``, the sum of ``error`` over equal labels; null is a label, too.

    Sums are made before the shuffle; the join back has one row per label on its other side.
    """
    totals = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "label_")
    return rows.join(totals, F.col("label").eqNullSafe(F.col("label_")), "left").drop("label_")


def reconstruct(codes: Column, books: list[list[list[int]]], spec: CodeSpec = CodeSpec()) -> Column:
    """The vector that a code stands for: the entries of its parts, in components as they were."""
    entries = F.array(*[F.array(*[F.array(*[F.lit(x / spec.scale) for x in e]) for e in part]) for part in books])
    part = F.sequence(F.lit(0), F.lit(spec.parts - 1))

    def entry(k: Column) -> Column:
        index = F.conv(F.substr(codes, k * 2 + 1, F.lit(2)), 16, 10).cast("int")
        return F.get(F.get(entries, k), index)

    return F.flatten(F.transform(part, entry))
