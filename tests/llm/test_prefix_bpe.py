"""Byte-level BPE by prefixes beside the tiktoken library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from bazaarline.llm import prefix_bpe as pb
from bazaarline.llm.queries import BYTE_VOCABULARY, QUERIES, vocabulary

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "  ", "a  b", "a \n b", "\n\n", "a\n\nb ", "it's I'll x<|endoftext|> y", "\x1c\x1d a\x85b　c", "a\tb", "x",
       "日本語 テキスト 123 ４５", "é à ՘ Ᲊx", "a" * 3000, " " * 500 + "x", "\t\ta\r\n", "''''s 's", "x 'S 'll", "🙂🙂 🙂",
       "a b \x0b\x0c", "don't  stop  '  s", "A. b, c.", "x . y .\n.z", "a​b \x00", "end.\nNext", "q,,,'s r"]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers

    ranks = pb.read_ranks(vocabulary(BYTE_VOCABULARY))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return pb.encoder(vocabulary(BYTE_VOCABULARY))


@pytest.fixture(scope="module")
def texts(sample):
    points = [c for c in range(0, 0x20000, 17) if not 0xD800 <= c < 0xE000]
    every = [f"a{chr(c)}b {chr(c)}c d{chr(c)} 1. E{chr(c)}. x" for c in points]
    return [r["text"] for r in sample("documents").select("text").collect()] + ODD + every


def ids_of(bpe, text: str) -> list[int]:
    return bpe.ids(bpe.table(text))[0].tolist()


def test_pattern_is_the_vocabulary_s():
    import public_tokenizers

    assert pb.PIECES == public_tokenizers.PATTERN


def test_ids_are_the_library_s(bpe, library, texts):
    tables = np.split(bpe.tables(pa.array(texts)), np.cumsum([len(t.encode()) for t in texts]))
    for text, table in zip(texts, tables, strict=False):
        ids = bpe.ids(table)[0]
        assert ids.tolist() == library.encode_ordinary(text), text[:60]
        assert bpe.decoded(ids).tobytes() == text.encode()


def test_other_white_space():
    """Of the characters that the pattern takes for white space all but two make a text uneven."""
    import pyarrow.compute as pc
    import regex

    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    told = pc.match_substring_regex(pa.array([f"a{c}b" for c in every]), pb.UNEVEN).to_pylist()
    blank = regex.compile(r"\s")
    assert all(t for c, t in zip(every, told, strict=True) if blank.match(c) and c not in " \n")
    assert sum(told) < 40


def test_last_token_of_every_prefix(bpe, library, texts):
    pieces = {p for t in texts[::7] for p in bpe.pieces.findall(t)} | {"a" * 300, " " * 300, "=" * 200, "é" * 40}
    for piece in sorted(pieces)[::3]:
        raw = piece.encode()
        lasts = bpe.last_tokens(raw)
        for end in (1, len(raw) // 2, len(raw)):
            if end:
                assert lasts[end - 1] == library._core_bpe.encode_single_piece(raw[:end])[-1]


@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=1, max_size=60))
def test_any_bytes(raw):
    bpe = pb.encoder(vocabulary(BYTE_VOCABULARY))
    table = np.array(bpe.last_tokens(raw), dtype="<u4")
    table[0] |= pb.START
    assert [bpe.bytes_of[i] for i in bpe.ids(table)[0].tolist()] == bpe.merged(raw)


def test_pairs_stay_as_merging_tells(bpe):
    chosen = random.Random(3)
    for _ in range(4000):
        left, right = chosen.randrange(len(bpe.bytes_of)), chosen.randrange(len(bpe.bytes_of))
        parts = [bpe.bytes_of[left], bpe.bytes_of[right]]
        assert bpe.stays(left, right) == (bpe.merged(b"".join(parts)) == parts)


def test_bounded_tables_change_nothing(texts, library, monkeypatch):
    for name in ("MAX_CHUNKS", "MAX_PAIRS"):
        monkeypatch.setattr(pb, name, 40)
    monkeypatch.setattr(pb, "LONG_CHUNK", 5)
    bpe = pb.PrefixBpe(pb.read_ranks(vocabulary(BYTE_VOCABULARY)))
    for k in range(0, 240, 12):
        part = texts[k : k + 12]
        got = bpe.ids(bpe.tables(pa.array(part)))[0].tolist()
        assert got == [i for t in part for i in library.encode_ordinary(t)]


PUTS = ["", " ", "x", "'", "ll", "'ll", "\n", "  ", "é", "word and", "1", "🙂", " a'"]


def test_edits_equal_new_encodings(bpe, texts):
    chosen = random.Random(5)
    for text in [t for t in texts if len(t) < 400][:120] + ODD:
        table = bpe.table(text)
        for _ in range(6):
            at = chosen.randrange(len(text) + 1)
            cut, put = chosen.choice((0, 0, 1, 2, 7)), chosen.choice(PUTS)
            text, table, _ = bpe.edited(text, table, at, cut, put)
            assert table.tobytes() == bpe.table(text).tobytes(), (text, at, cut, put)


def test_edits_are_local(bpe):
    text = "some words in a row, " * 20_000
    table = bpe.table(text)
    assert bpe.edited(text, table, 200_000, 3, "other")[2] < 60
    new, _, made = bpe.edited(text, table, len(text), 0, "at the end")
    assert made < 30 and new.endswith("row, at the end")
    # A run that grows keeps its prefixes.
    run = bpe.table("a" * 5000)
    assert bpe.edited("a" * 5000, run, 5000, 0, "aaa")[2] == 3


def test_prefixes_are_read_from_the_table(bpe, library):
    text = "unbelievable"
    table = bpe.table(text)
    for n in range(len(text) + 1):
        assert bpe.ids_of_prefix(table, n).tolist() == library.encode_ordinary(text[:n])


def test_unknown_vocabulary_is_refused():
    with pytest.raises(ValueError):
        pb.PrefixBpe({b"a": 0, b"b": 1, b"c": 2, b"abc": 3}).edge(b"abc", 0)


def test_long_text(bpe, library):
    text = " ".join(f"w{k % 7919}" for k in range(300_000)) + "\n\n" + "=" * 50_000
    assert ids_of(bpe, text) == library.encode_ordinary(text)


def test_query_is_the_library_s(spark, sample, library):
    got = {r["doc_id"]: r for r in QUERIES["op13_prefix_bpe"](spark, SF).collect()}
    rows = sample("documents").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        row = got[doc_id]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_odd_documents(odd_docs, odd_rows, library):
    path = vocabulary(BYTE_VOCABULARY)
    got = pb.decode(pb.encode(odd_docs, path), path).collect()
    at_once = pb.encode(odd_docs, path, decoded=True).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, at_once))
    want = [(r[0], library.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in odd_rows]
    seen = [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist(), bytes(r["decoded"])) for r in got]
    assert sorted(map(repr, seen)) == sorted(map(repr, want))
    assert all(len(pb.unpack_table(r["last_tokens"])) == len(r["decoded"]) for r in got)
    assert pb.decode(pb.encode(odd_docs.limit(0), path), path).count() == 0


def test_edited_rows(spark, library):
    path = vocabulary(BYTE_VOCABULARY)
    docs = spark.createDataFrame([(1, "one two"), (2, None), (None, "x y z")], "doc_id bigint, text string")
    changes = spark.createDataFrame(
        [(1, 4, 3, "three"), (2, None, None, "new"), (3, 0, 0, "q")], "id bigint, at bigint, cut bigint, put string"
    )
    packed = {r["doc_id"]: r["last_tokens"] for r in pb.encode(docs, path).collect()}
    rows = [(r["doc_id"], r["text"], packed[r["doc_id"]]) for r in docs.collect()]
    joined = spark.createDataFrame(rows, "doc_id bigint, text string, last_tokens binary")
    joined = joined.join(changes, joined["doc_id"] == changes["id"], "left")
    got = {r["doc_id"]: r for r in pb.edit(joined, path).collect()}
    assert {k: r["text"] for k, r in got.items()} == {1: "one three", 2: "new", None: "x y z"}
    for row in got.values():
        assert np.frombuffer(row["ids"], "<u4").tolist() == library.encode_ordinary(row["text"])
        assert row["n_tokens"] == len(row["ids"]) // 4
    assert got[None]["made"] <= 5
