"""Exact token counts of texts and of their prefixes under a byte-level BPE vocabulary."""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# Bounds of what a worker keeps between texts.
MAX_STEPS = 500_000
MAX_PREFIXES = 900_000
MAX_PAIRS = 1_000_000
SHORT_PIECE = 48  # states of pieces with more bytes and steps of longer words are not kept
MARKS = ".,;:!?"  # after a word, each is one token
ONE = b"\x01"

# How this kind of vocabulary cuts a text into pieces before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The letters that stand for the 256 bytes in a vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class PrefixCounter:
    """Counts tokens at every prefix of a piece, without encoding any prefix anew.

    The encoding of a prefix is the encoding of a shorter one and one last token, and that
    token is the only one whose pair with the token before it survives merging. So the state of
    a prefix, its last token and its count, follows from the states of shorter prefixes. Words
    share prefixes, so a worker keeps the states of short ones.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        letters = _byte_letters()
        model = told["model"]
        special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.ids: dict[bytes, int] = {
            bytes(letters[c] for c in token): number
            for token, number in model["vocab"].items()
            if token not in special
        }
        self.bytes_of = {number: token for token, number in self.ids.items()}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = (bytes(letters[c] for c in part) for part in (left, right))
            self.rank[self.ids[a], self.ids[b]] = (rank, self.ids[a + b])
        # Every ending of a token, with the token's id if the ending is one itself.
        self.endings: dict[bytes, int] = {}
        for token in self.ids:
            for start in range(len(token)):
                ending = token[start:]
                if ending not in self.endings:
                    self.endings[ending] = self.ids.get(ending, -1)
        self.special = [s for s in special if s]
        self.pieces = regex.compile(PIECES)
        self.cut = regex.compile("|".join(regex.escape(s) for s in self.special)) if self.special else None
        self.pairs: dict[int, bool] = {}
        self.states: dict[bytes, int] = {}
        self.steps: dict[str, np.ndarray] = {}
        self.spaced_steps, self.bare_steps = _WordSteps(self, " "), _WordSteps(self, "")

    def merged(self, piece: bytes) -> list[int]:
        """The encoding of a short piece by merging, lowest rank first."""
        parts = [self.ids[bytes((b,))] for b in piece]
        while len(parts) > 1:
            found = [(self.rank[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in self.rank]
            if not found:
                break
            (_, token), at = min(found)
            parts[at : at + 2] = [token]
        return parts

    def stays(self, left: int, right: int) -> bool:
        """Whether two tokens side by side are the encoding of their bytes."""
        pair = left << 32 | right
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            known = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
            self.pairs[pair] = known
        return known

    def _next(self, piece: bytes, end: int, state_at) -> int:
        """The state of ``piece[:end]``; ``state_at`` gives those of shorter prefixes.

        A state is the count and the last token in one integer.
        """
        endings, pairs = self.endings, self.pairs
        for at in range(end - 1, -1, -1):
            token = endings[piece[at:end]]
            if token >= 0:
                if at == 0:
                    return 1 << 32 | token
                state = state_at(at)
                last = state & 0xFFFFFFFF
                fits = pairs.get(last << 32 | token)
                if self.stays(last, token) if fits is None else fits:
                    return (state >> 32) + 1 << 32 | token
        raise AssertionError("no token fits")

    def prefix_counts_of(self, piece: bytes) -> list[int]:
        """Token counts of all prefixes of a piece, the empty one first."""
        states = [0]
        for end in range(1, len(piece) + 1):
            states.append(self._next(piece, end, states.__getitem__))
        return [state >> 32 for state in states]

    def piece_count(self, piece: str) -> int:
        raw = piece.encode("utf-8", "surrogatepass")
        if len(raw) > SHORT_PIECE:
            return self.prefix_counts_of(raw)[-1]
        known = self.states
        state = known.get(raw)
        if state is None:
            if len(known) >= MAX_PREFIXES:
                known.clear()
            # With a prefix all shorter ones are kept too.
            start = len(raw) - 1
            while start and raw[:start] not in known:
                start -= 1
            for end in range(start + 1, len(raw) + 1):
                state = self._next(raw, end, lambda at: known[raw[:at]])
                known[raw[:end]] = state
        return state >> 32

    def segments(self, text: str) -> Iterator[tuple[int, str, bool]]:
        """Start, text and whether it is a special token, of the parts of a text."""
        at = 0
        for found in self.cut.finditer(text) if self.cut else ():
            if found.start() > at:
                yield at, text[at : found.start()], False
            yield found.start(), found.group(), True
            at = found.end()
        if at < len(text):
            yield at, text[at:], False

    def count_by_pieces(self, text: str) -> int:
        return sum(
            1 if special else sum(map(self.piece_count, self.pieces.findall(part)))
            for _, part, special in self.segments(text)
        )

    def count(self, text: str) -> int:
        """Tokens of the whole text: the count at its last prefix."""
        return int(self.prefix_steps(text).sum(dtype=np.int64))

    def prefix_counts(self, text: str) -> np.ndarray:
        """Tokens of ``text[:n]`` for every ``n`` from 0 to the length, in code points.

        A prefix that ends inside a character sequence of a special token counts that sequence
        as ordinary text. Where white space runs are cut before their last character, the
        prefix that ends with the run has it as one piece.
        """
        steps = self.prefix_steps(text)
        return np.concatenate(([0], np.cumsum(steps, dtype=np.int32))).astype(np.int32)

    def prefix_steps(self, text: str) -> np.ndarray:
        """What each character adds to the count of the prefix before it; it may be negative.

        The steps of a piece do not depend on what stands before it, so those of words and
        pieces are kept and a text's are put together from them, in linear time.
        """
        try:
            parts = []
            for number, line in enumerate(text.split("\n") if text else ()):
                if number:
                    parts.append(ONE)  # a line end alone is one token
                words = line.split(" ")
                parts.append(self.bare_steps[words[0]])
                parts.extend(map(self.spaced_steps.__getitem__, words[1:]))
            return np.frombuffer(b"".join(parts), np.int8)
        except _Uneven:
            pass
        except OverflowError:
            return self._steps_by_pieces(text, wide=True)
        try:
            return self._steps_by_pieces(text)
        except OverflowError:
            return self._steps_by_pieces(text, wide=True)

    def _steps_by_pieces(self, text: str, wide: bool = False) -> np.ndarray:
        parts: list[bytes] = []
        mended: list[tuple[int, int]] = []  # prefixes whose count is not the sum of steps, and what it lacks
        last = ""  # the piece before
        for start, part, special in self.segments(text):
            if special:
                # Its own prefixes are ordinary text, which may join the piece before it.
                before = self.count_by_pieces(last)
                told = [0, *(self.count_by_pieces(last + part[:n]) - before for n in range(1, len(part))), 1]
                parts.append(_bytes_of([b - a for a, b in zip(told, told[1:], strict=False)], wide))
                last = ""
                continue
            at, run = start, start
            for piece in self.pieces.findall(part):
                steps = _bytes_of(self._steps_of(piece), wide) if wide else self.piece_steps(piece)
                parts.append(steps)
                if not (last.isspace() and piece[0].isspace()):
                    run = at
                else:
                    # The run up to here, taken as the end of the text, is one piece.
                    apart = self.piece_count(text[run:at]) + self.piece_count(piece[0])
                    mended.append((at, self.piece_count(text[run : at + 1]) - apart))
                last, at = piece, at + len(piece)
        steps = np.frombuffer(b"".join(parts), np.int32 if wide else np.int8)
        if mended:
            steps = steps.astype(np.int32)
            for at, by in mended:
                steps[at] += by
                if at + 1 < len(steps):
                    steps[at + 1] -= by
        return steps

    def _steps_of(self, piece: str) -> list[int]:
        raw = piece.encode("utf-8", "surrogatepass")
        if len(raw) > SHORT_PIECE:
            counts = self.prefix_counts_of(raw)
        else:
            self.piece_count(piece)
            known = self.states
            counts = [0, *(known[raw[:end]] >> 32 for end in range(1, len(raw) + 1))]
        if len(raw) > len(piece):
            end, ends = 0, [0]
            for c in piece:
                end += len(c.encode("utf-8", "surrogatepass"))
                ends.append(end)
            counts = [counts[end] for end in ends]
        if piece[0] == "'" and len(piece) <= 3:
            for n in range(1, len(piece)):
                counts[n] = self.count_by_pieces(piece[:n])
        return [b - a for a, b in zip(counts, counts[1:], strict=False)]

    def piece_steps(self, piece: str) -> bytes:
        known = self.steps.get(piece)
        if known is None:
            known = _bytes_of(self._steps_of(piece))
            if len(piece) <= SHORT_PIECE:
                if len(self.steps) >= MAX_STEPS:
                    self.steps.clear()
                self.steps[piece] = known
        return known


def _bytes_of(steps: list[int], wide: bool = False) -> bytes:
    """Steps of one byte, or four; an OverflowError if one does not fit."""
    return array("i" if wide else "b", steps).tobytes()


class _Uneven(Exception):
    """The text has blanks that stand together or other white space."""


class _WordSteps(dict):
    """The steps of words in texts whose words are parted by single blanks or line ends."""

    def __init__(self, counter: PrefixCounter, before: str):
        super().__init__()
        self.counter, self.before = counter, before

    def __missing__(self, word: str) -> bytes:
        if word.isalpha():
            packed = _bytes_of(self.counter._steps_of(self.before + word))
        elif word[:-1].isalpha() and word[-1] in MARKS:
            return self[word[:-1]] + ONE  # the mark is a piece of its own
        elif not word or not word.isprintable():
            raise _Uneven
        else:
            steps = self.counter._steps_by_pieces(self.before + word)
            packed = steps.astype(np.int8).tobytes()
        if len(word) <= SHORT_PIECE:
            if len(self) >= MAX_STEPS:
                self.clear()
            self[word] = packed
        return packed


@cache
def counter(path: str) -> PrefixCounter:
    """One counter per worker and vocabulary file."""
    return PrefixCounter(path)


def pack_steps(steps: np.ndarray) -> bytes:
    """The table of a text's prefixes: a letter for the width of a step, and the steps, compressed."""
    wide = steps.dtype != np.int8 and len(steps) and np.abs(steps).max() > 127
    return (b"w" if wide else b"n") + zlib.compress(steps.astype("<i4" if wide else "<i1").tobytes(), 1)


def unpack_counts(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(zlib.decompress(packed[1:]), "<i4" if packed[:1] == b"w" else "<i1")
    return np.concatenate(([0], np.cumsum(steps, dtype=np.int64)))


def count_at(packed: bytes, n_chars: int) -> int:
    """Tokens of the first ``n_chars`` characters."""
    counts = unpack_counts(packed)
    return int(counts[min(n_chars, len(counts) - 1)])


def fits(packed: bytes, budget: int) -> int:
    """Most characters of the text that take at most ``budget`` tokens."""
    return int(np.flatnonzero(unpack_counts(packed) <= budget)[-1])


def token_counts(docs: DataFrame, vocabulary: str, limit: int) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, limit_chars, prefix_counts`` for each row of ``docs``.

    ``vocabulary`` is the path of a byte-level BPE file on every node. ``prefix_counts`` holds
    the packed counts at every prefix, for :func:`count_at` and :func:`fits`; the other columns
    are read from it: ``n_tokens`` is the count at the last prefix, ``limit_chars`` the length of
    the longest prefix of at most ``limit`` tokens. The count is that of the library that owns
    the format, without added begin or end tokens; a special token's text counts as that token.
    A null text counts as empty and has 0 tokens. Null and repeated ids keep their rows; an empty
    table gives an empty table; columns other than ``doc_id`` and ``text`` are ignored. Texts
    are never cut.

    There is no shuffle. A worker keeps the states of short pieces up to a fixed number.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(vocabulary)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            packed, n_tokens, fitting = [], [], []
            for text in texts:
                steps = tokens.prefix_steps(text)
                counts = np.cumsum(steps, dtype=np.int32)
                packed.append(pack_steps(steps))
                n_tokens.append(int(counts[-1]) if text else 0)
                within = np.flatnonzero(counts <= limit)
                fitting.append(int(within[-1]) + 1 if len(within) else 0)
            columns = [
                batch.column(0),
                pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                pa.array(n_tokens, pa.int64()),
                pa.array([n > limit for n in n_tokens], pa.bool_()),
                pa.array(fitting, pa.int64()),
                pa.array(packed, pa.binary()),
            ]
            names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "limit_chars", "prefix_counts"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean, limit_chars bigint, prefix_counts binary"
    return docs.select("doc_id", "text").mapInArrow(counted, schema)
