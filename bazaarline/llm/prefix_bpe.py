"""Byte-level BPE by prefixes: the last token of every byte prefix, kept so that texts can grow and change."""

from __future__ import annotations

import base64
import math
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame

from bazaarline.llm.shared import slices

# Bounds of what a worker keeps between texts.
MAX_CHUNKS = 400_000  # chunks with their tables, twice as many with older ones
MAX_PAIRS = 400_000
LONG_CHUNK = 64  # tables of chunks with more characters are not kept
TEXT_BYTES = 4_000_000  # of the texts worked on at a time

# Fixed value: how this kind of vocabulary cuts a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters after a piece that decide where it ends: two of "'ll", and white space is cut before
# its last character.
LOOK_AHEAD = 2
# Texts whose white space is single blanks and line ends between other characters are cut there.
SPACES = r"\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
UNEVEN = rf"  |\n\n| \n|\n |\A[ \n]|[ \n]\z|[\x00{SPACES}]"
LETTERS = r"\A ?[A-Za-zÀ-ÖØ-öø-ÿ]+\z"
MARKS = ".,;:!?#$%&*|<>()[]{}+-=/~^_@\""  # neither letters nor numbers, and no apostrophe

# A table entry is the last token of the prefix that ends with this byte, and this mark on the
# first byte of a piece.
START_BIT = 1 << 31
START = np.uint32(START_BIT)
TOKEN = np.uint32((1 << 31) - 1)


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks: a line holds the token in base 64 and the rank."""
    with open(path, "rb") as file:
        lines = (line.split() for line in file if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in lines}


def _marked(lasts: list[int]) -> bytes:
    """The table of a piece."""
    return array("I", [lasts[0] | START_BIT, *lasts[1:]]).tobytes()


def _shared(ordered: list[bytes]) -> list[int]:
    """How many first bytes each piece shares with the one before it, 32 at most."""
    rows = np.array(ordered, dtype="S32").view(np.uint8).reshape(len(ordered), 32)
    equal = np.cumprod(rows[1:] == rows[:-1], axis=1).sum(axis=1)
    lengths = np.fromiter(map(len, ordered), "int64", len(ordered))
    return [0, *np.minimum(equal, np.minimum(lengths[1:], lengths[:-1])).tolist()][: len(ordered)]


def _gathered(flat: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The chosen runs, one after the other, of an array of runs with these sizes."""
    starts, picked = np.cumsum(sizes) - sizes, sizes[chosen]
    ends = np.cumsum(picked)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[chosen] - (ends - picked), picked)]


class PrefixBpe:
    """The encoding of a piece by its prefixes.

    The encoding of a prefix is that of a shorter prefix and one last token; exactly one token
    at the end of the prefix stays beside the last token of the rest when both are merged
    anew. So a table with the last token of every prefix holds the encodings of all prefixes:
    each is read by walking back from its end. More bytes only add entries.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.lengths = np.zeros(max(ranks.values(), default=0) + 1, dtype=np.int64)
        self.bytes_of: list[bytes] = [b""] * len(self.lengths)
        # Every ending of a token, with the token's id if the ending is one itself.
        self.endings: dict[bytes, int] = {}
        for token, number in ranks.items():
            self.lengths[number] = len(token)
            self.bytes_of[number] = token
            for start in range(len(token)):
                ending = token[start:]
                if ending not in self.endings:
                    self.endings[ending] = ranks.get(ending, -1)
        self.flat = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        self.pieces = regex.compile(PIECES)
        # For a token those that were met before it, and whether both stay.
        self.pairs: defaultdict[int, dict[int, bool]] = defaultdict(dict)
        self.n_pairs = 0
        self.edges: tuple[dict[bytes, list], dict[bytes, list]] = ({}, {})
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # kept before; a chunk met again moves back

    def merged(self, piece: bytes, parts_left: int = 1) -> list[bytes]:
        """A short piece merged, lowest rank first and leftmost first, until so many parts are left."""
        rank_of = self.ranks.get
        parts = [piece[k : k + 1] for k in range(len(piece))]
        while len(parts) > parts_left:
            best, at = None, 0
            for k in range(len(parts) - 1):
                rank = rank_of(parts[k] + parts[k + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def edge(self, token: bytes, side: int) -> list[tuple[bytes, float]]:
        """The parts that stand at the right (1) or left (0) edge of a token while it is merged, the
        single byte first, each with the rank of the merge that ends it."""
        known = self.edges[side].get(token)
        if known is None:
            if len(token) == 1:
                known = [(token, math.inf)]
            else:
                parts = self.merged(token, 2)
                if len(parts) != 2:
                    raise ValueError(f"token {token!r} is not the encoding of its bytes")
                inner = self.edge(parts[side], side)
                known = [*inner[:-1], (inner[-1][0], self.ranks[token]), (token, math.inf)]
            self.edges[side][token] = known
        return known

    def stays(self, left: int, right: int) -> bool:
        """Whether two tokens side by side are the encoding of their bytes.

        Merges run in the order of their ranks, as a part has a lower rank than the whole. So
        both tokens are merged on their own unless at some time the parts at the border, as
        they stand then, have a merge that comes first; at equal ranks the left one does.
        """
        known = self.pairs[right].get(left)
        if known is None:
            if self.n_pairs >= MAX_PAIRS:
                self.pairs.clear()
                self.n_pairs = 0
            known = self._stays(self.edge(self.bytes_of[left], 1), self.edge(self.bytes_of[right], 0))
            self.pairs[right][left] = known
            self.n_pairs += 1
        return known

    def _stays(self, lefts: list[tuple[bytes, float]], rights: list[tuple[bytes, float]]) -> bool:
        i = j = 0
        while True:
            (left, left_ends), (right, right_ends) = lefts[i], rights[j]
            rank = self.ranks.get(left + right)
            if rank is not None and rank < left_ends and rank <= right_ends:
                return False
            if left_ends == right_ends == math.inf:
                return True
            if left_ends <= right_ends:
                i += 1
            else:
                j += 1

    def last_tokens(self, piece: bytes, known: list[int] | None = None) -> list[int]:
        """The last token of every prefix of a piece; ``known`` are those of its first prefixes."""
        lasts = list(known or ())
        endings, pairs = self.endings, self.pairs
        for end in range(len(lasts) + 1, len(piece) + 1):
            for at in range(end - 1, -1, -1):
                token = endings[piece[at:end]]
                if token >= 0:
                    if at == 0:
                        break
                    left = lasts[at - 1]
                    fits = pairs[token].get(left)
                    if fits or fits is None and self.stays(left, token):
                        break
            lasts.append(token)
        return lasts

    def _cut(self, chunks: list[str]) -> list[list[bytes]]:
        """The pieces of each chunk. Letters end where marks begin, so the usual chunk needs no search."""
        given = pa.array(chunks, pa.string())
        words = pc.ascii_rtrim(given, MARKS)
        usual = pc.match_substring_regex(words, LETTERS).to_pylist()
        raws, heads = given.cast(pa.binary()).to_pylist(), words.cast(pa.binary()).to_pylist()
        return [
            ([head, raw[len(head) :]] if len(head) < len(raw) else [raw])
            if plain
            else [piece.encode() for piece in self.pieces.findall(chunk)]
            for chunk, plain, raw, head in zip(chunks, usual, raws, heads, strict=True)
        ]

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Tables of chunks that are not kept.

        Pieces are worked out in the order of their bytes: what a piece shares with the one
        before it is taken over.
        """
        cut = self._cut(chunks)
        table_of: dict[bytes, bytes] = {}
        ordered = sorted({piece for pieces in cut for piece in pieces})
        lasts: list[int] = []
        for piece, same in zip(ordered, _shared(ordered), strict=True):
            lasts = self.last_tokens(piece, lasts[:same])
            table_of[piece] = _marked(lasts)
        return {
            chunk: table_of[pieces[0]] if len(pieces) == 1 else b"".join(map(table_of.__getitem__, pieces))
            for chunk, pieces in zip(chunks, cut, strict=True)
        }

    def _tables_of(self, chunks: list[str]) -> list[bytes]:
        """Tables of different chunks; those of short ones are kept."""
        found = list(map(self.kept.get, chunks))
        new = [k for k, table in enumerate(found) if table is None]
        if len(self.kept) + len(new) > MAX_CHUNKS:
            self.older, self.kept = self.kept, {}
        kept, older = self.kept, self.older
        learned = self._learn([chunks[k] for k in new if chunks[k] not in older])
        for k in new:
            chunk = chunks[k]
            found[k] = learned[chunk] if chunk in learned else older[chunk]
            if len(chunk) <= LONG_CHUNK:
                kept[chunk] = found[k]
        return found

    def tables(self, texts: pa.Array) -> np.ndarray:
        """The last token of every byte prefix of each piece of each text, one text after the other.

        Pieces never go across a single blank or line end between other characters, so texts
        with no other white space are cut there, and each different chunk is looked up once;
        others are cut into pieces.
        """
        texts = pc.fill_null(texts.cast(pa.string()), "")
        uneven = pc.match_substring_regex(texts, UNEVEN)
        marked = pc.replace_substring(pc.replace_substring(texts.filter(pc.invert(uneven)), " ", "\0 "), "\n", "\0\n\0")
        lists = pc.split_pattern(marked, "\0").cast(pa.list_(pa.string()))
        if len(lists) < len(texts):
            cut = [self.pieces.findall(t) for t in texts.filter(uneven).to_pylist()]
            order = np.argsort(np.argsort(uneven.to_numpy(zero_copy_only=False), kind="stable"), kind="stable")
            lists = pa.concat_arrays([lists, pa.array(cut, pa.list_(pa.string()))]).take(pa.array(order))
        numbered = lists.flatten().dictionary_encode()
        found = self._tables_of(numbered.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), "int64", len(found)) // 4
        return _gathered(np.frombuffer(b"".join(found), "<u4"), sizes, numbered.indices.to_numpy())

    def table(self, text: str) -> np.ndarray:
        return self.tables(pa.array([text], pa.string()))

    def ids(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and the bytes they start at, read from a table by walking back from the ends of all pieces."""
        begin = np.flatnonzero(table & START)
        tokens = (table & TOKEN).astype(np.int64)
        at = np.append(begin[1:], len(table)) if len(begin) else begin
        found = np.full(len(table), -1, dtype=np.int32)
        while len(at):
            last = tokens[at - 1]
            at = at - self.lengths[last]
            found[at] = last
            more = at > begin
            at, begin = at[more], begin[more]
        starts = np.flatnonzero(found >= 0)
        return found[starts].astype("<u4"), starts

    def ids_of_prefix(self, table: np.ndarray, n_bytes: int) -> np.ndarray:
        """Ids of the pieces of the text cut after ``n_bytes``: no byte is encoded anew."""
        return self.ids(table[:n_bytes])[0]

    def decoded(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that ids stand for."""
        return _gathered(self.flat, self.lengths, ids)

    def edited(self, text: str, table: np.ndarray, at: int, cut: int, put: str) -> tuple[str, np.ndarray, int]:
        """Put ``put`` in the place of ``cut`` characters from ``at``: the new text and table.

        Pieces that end ``LOOK_AHEAD`` characters before the change stay; from there on pieces
        are cut anew until one starts where an old one did, behind the change. In the first
        one the tokens of the prefixes before the change stay, too. The third value is the
        number of entries made anew.
        """
        at = min(max(at, 0), len(text))
        cut = min(max(cut, 0), len(text) - at)
        new = text[:at] + put + text[at + cut :]
        old_starts = np.flatnonzero(table & START)
        stable = len(text[: max(at - LOOK_AHEAD, 0)].encode())
        before = np.searchsorted(old_starts, stable, "right") - 1
        begin = int(old_starts[before]) if before >= 0 else 0
        change = len(text[:at].encode())
        shift = len(put.encode()) - len(text[at : at + cut].encode())
        head = len(text.encode()[:begin].decode())
        old_end = int(old_starts[before + 1]) if before + 1 < len(old_starts) else len(table)
        behind = change + len(put.encode())
        parts, made, place = [table[:begin]], 0, begin
        for found in self.pieces.finditer(new, head):
            old = place - shift
            if place >= behind and old < len(table) and table[old] & START:
                break
            piece = found.group().encode()
            known: list[int] = []
            if place == begin:
                same = min(change, old_end, begin + len(piece)) - begin
                known = (table[begin : begin + max(same, 0)] & TOKEN).tolist()
            parts.append(np.frombuffer(_marked(self.last_tokens(piece, known)), "<u4"))
            made += len(piece) - len(known)
            place += len(piece)
        parts.append(table[place - shift :])
        return new, np.concatenate(parts).astype("<u4"), made


@cache
def encoder(path: str) -> PrefixBpe:
    """One encoder per worker and vocabulary file."""
    return PrefixBpe(read_ranks(path))


def pack_table(table: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(table, "<u4").data)


def unpack_table(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), "<u4")


def encode(docs: DataFrame, vocabulary: str, decoded: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids, last_tokens`` for each row of ``docs``.

    ``vocabulary`` is the path of a file of ranks on every node. ``last_tokens`` is the packed
    table with the last token of every byte prefix (:func:`unpack_table`); ``ids``, as
    little-endian integers of four bytes, are read from it by walking back. They are those of
    the library that owns the format, without special tokens. With ``decoded`` a column of this
    name holds the bytes that the ids stand for, as :func:`decode` would add in a pass of its own.

    A null text counts as empty and has no tokens. Null and repeated ids keep their rows; an
    empty table gives an empty table; columns other than ``doc_id`` and ``text`` are ignored.
    Texts are never cut. There is no shuffle; a worker keeps the tables of short chunks up to a
    fixed number and works on about ``TEXT_BYTES`` of text at a time.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        for batch in batches:
            for part in slices(batch, 1, TEXT_BYTES):
                texts = part.column(1)
                sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype("int64")
                table = bpe.tables(texts)
                ids, starts = bpe.ids(table)
                text_ends = np.cumsum(sizes)
                ends = np.searchsorted(starts, text_ends)
                columns = [
                    part.column(0),
                    pa.array(np.diff(ends, prepend=0), pa.int64()),
                    _binaries(ids, ends),
                    pa.array(map(pack_table, np.split(table, text_ends[:-1])), pa.binary()),
                ]
                names = ["doc_id", "n_tokens", "ids", "last_tokens"]
                if decoded:
                    read = bpe.decoded(ids)
                    byte_ends = np.append(0, np.cumsum(bpe.lengths[ids]))[ends]
                    columns, names = [*columns, _binaries(read, byte_ends)], [*names, "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids binary, last_tokens binary"
    return docs.select("doc_id", "text").mapInArrow(encoded, schema + ", decoded binary" * decoded)


def _binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values that end at these places of an array."""
    offsets = np.append(0, ends * values.itemsize).astype("<i4")
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """The rows with a column ``decoded``: the bytes that the column ``ids`` stands for.

    Null ids give null. A column named ``decoded`` is replaced.
    """
    others = [f for f in encoded.schema if f.name != "decoded"]
    place = [f.name for f in others].index("ids")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        for batch in batches:
            for part in slices(batch, place, TEXT_BYTES):
                ids = part.column(place).to_pylist()
                texts = [None if i is None else bpe.decoded(np.frombuffer(i, "<u4")).tobytes() for i in ids]
                names = [f.name for f in others] + ["decoded"]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    rows = encoded.select(*[f"`{f.name}`" for f in others])
    return rows.mapInArrow(decoded, f"{schema}, decoded binary")


def edit(tables: DataFrame, vocabulary: str) -> DataFrame:
    """Changed texts without encoding them anew: ``doc_id, text, n_tokens, ids, last_tokens, made``.

    Rows of ``tables`` hold ``doc_id``, ``text``, its ``last_tokens`` and a change: ``at`` and
    ``cut`` in characters and the text ``put``. Null ``at`` appends, null ``cut`` cuts nothing,
    null ``put`` puts nothing, null ``text`` is empty; places outside the text are moved into it.
    ``made`` is the number of table entries made anew; all others are taken over.
    """

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        for batch in batches:
            for part in slices(batch, 1, TEXT_BYTES):
                rows = []
                for row in part.to_pylist():
                    text, packed = row["text"] or "", row["last_tokens"]
                    table = unpack_table(packed) if packed else np.zeros(0, "<u4")
                    at = len(text) if row["at"] is None else row["at"]
                    text, table, made = bpe.edited(text, table, at, row["cut"] or 0, row["put"] or "")
                    ids = bpe.ids(table)[0]
                    rows.append((text, len(ids), ids.tobytes(), pack_table(table), made))
                kinds = (pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.int64())
                columns = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                names = ["doc_id", "text", "n_tokens", "ids", "last_tokens", "made"]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=names)

    kind = tables.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text string, n_tokens bigint, ids binary, last_tokens binary, made bigint"
    return tables.select("doc_id", "text", "last_tokens", "at", "cut", "put").mapInArrow(edited, schema)
