"""Token counts and token files beside the tokenizers library."""

from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bazaarline.llm import token_counts as tc
from bazaarline.llm import token_files as tf
from bazaarline.llm.queries import COUNT_VOCABULARY, END_ID, FILE_VOCABULARY, QUERIES, vocabulary
from bazaarline.llm.shared import stored

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "  ", "a  b", "a \n b", "\n\n", "a\n\nb ", "it's I'll x<|endoftext|> y", " <|endoftext|>\n<|endoftext|>", "<|endoft",
       "\x1c\x1d a\x85b\u3000c", "日本語 テキスト 123 ４５", "e\u0301 à", "a" * 3000, " " * 500 + "x", "\t\ta\r\n", "''''s 's", "x 'S 'll",
       "🙂🙂 🙂", "a b \x0b\x0c", "don't  stop  '  s", "X<|endoftext|>y <|ENDOFTEXT|>", "A. b, c.", "x . y .\n.z", "ΣΑΣ İ. ﬁ."]


@pytest.fixture(scope="module")
def texts(sample):
    return [r["text"] for r in sample("documents").select("text").collect()] + ODD


def _every_character(step: int) -> list[str]:
    points = [c for c in range(0, 0x30000, step) if not 0xD800 <= c < 0xE000]
    return [f"a{chr(c)}b {chr(c)}c d{chr(c)} 1. E{chr(c)}. x" for c in points]


def test_counts_are_the_library_s(texts):
    counter, library = tc.counter(vocabulary(COUNT_VOCABULARY)), Tokenizer.from_file(vocabulary(COUNT_VOCABULARY))
    for text in texts + _every_character(13):
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), text[:80]


def test_counts_of_every_prefix(texts):
    counter, library = tc.counter(vocabulary(COUNT_VOCABULARY)), Tokenizer.from_file(vocabulary(COUNT_VOCABULARY))
    for text in [t[:250] for t in texts[::25] + ODD]:
        want = [len(library.encode(text[:n], add_special_tokens=False).ids) for n in range(len(text) + 1)]
        assert counter.prefix_counts(text).tolist() == want, text[:60]
        packed = tc.pack_steps(counter.prefix_steps(text))
        assert tc.count_at(packed, len(text)) == want[-1]
        for budget in (0, 1, 5, 10**6):
            assert tc.fits(packed, budget) == max(n for n, count in enumerate(want) if count <= budget)


def test_prefixes_of_texts_of_odd_parts():
    counter, library = tc.counter(vocabulary(COUNT_VOCABULARY)), Tokenizer.from_file(vocabulary(COUNT_VOCABULARY))
    special = counter.special[0]
    parts = ["a", "Word", "don't", "'ll", " ", "  ", "\n\n", "\t", "é", "日本", "🙂", ".", "!!", "'", "12", special, special[:5], "\u00a0", "\x1c"]
    draw = random.Random(5)
    for _ in range(400):
        text = "".join(draw.choice(parts) + draw.choice(("", " ")) for _ in range(draw.randint(0, 9)))
        want = [len(library.encode(text[:n], add_special_tokens=False).ids) for n in range(len(text) + 1)]
        assert counter.prefix_counts(text).tolist() == want, text
        assert tc.unpack_counts(tc.pack_steps(counter.prefix_steps(text))).tolist() == want
        assert counter._steps_by_pieces(text, wide=True).tolist() == counter.prefix_steps(text).tolist()


def test_special_tokens_take_linear_work(monkeypatch):
    counter = tc.PrefixCounter(vocabulary(COUNT_VOCABULARY))
    seen = []
    counted = counter.count_by_pieces
    monkeypatch.setattr(counter, "count_by_pieces", lambda text: seen.append(len(text)) or counted(text))
    work = []
    for times in (50, 400):
        seen.clear()
        counter.prefix_steps(("two words " + counter.special[0]) * times)
        work.append(sum(seen))
    assert work[1] <= 9 * work[0]


def test_wide_steps_are_kept():
    steps = np.array([1, 200, -199, 0], np.int32)
    assert tc.unpack_counts(tc.pack_steps(steps)).tolist() == [0, 1, 201, 2, 2]


def test_bounded_states_change_nothing(texts, monkeypatch):
    for name in ("MAX_STEPS", "MAX_PREFIXES", "MAX_PAIRS"):
        monkeypatch.setattr(tc, name, 50)
    counter = tc.PrefixCounter(vocabulary(COUNT_VOCABULARY))
    kept = tc.counter(vocabulary(COUNT_VOCABULARY))
    assert [counter.count(t) for t in texts[:40]] == [kept.count(t) for t in texts[:40]]


def test_odd_counts(odd_docs, odd_rows):
    library = Tokenizer.from_file(vocabulary(COUNT_VOCABULARY))
    got = tc.token_counts(odd_docs, vocabulary(COUNT_VOCABULARY), 512).collect()
    want = []
    for doc_id, text, *_ in odd_rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((doc_id, len((text or "").encode()), n, n > 512))
    assert sorted(map(repr, (tuple(r)[:4] for r in got))) == sorted(map(repr, want))
    assert all(tc.unpack_counts(r["prefix_counts"])[-1] == r["n_tokens"] for r in got)
    assert all(tc.fits(r["prefix_counts"], 512) == r["limit_chars"] for r in got)
    assert tc.token_counts(odd_docs.limit(0), vocabulary(COUNT_VOCABULARY), 1).count() == 0


def test_ids_are_the_library_s(texts, monkeypatch):
    library = Tokenizer.from_file(vocabulary(FILE_VOCABULARY))
    every = texts + _every_character(7)
    want = [library.encode(t, add_special_tokens=False).ids + [END_ID] for t in every]
    for most in (tf.MAX_WORDS, 300):
        monkeypatch.setattr(tf, "MAX_WORDS", most)
        own = tf.WordIds(vocabulary(FILE_VOCABULARY))
        got = [ids for k in range(0, len(every), 500) for ids in own.encode(pa.array(every[k : k + 500]), END_ID)]
        assert [np.frombuffer(ids, "<u2").tolist() for ids in got] == want


def test_kept_words_take_few_bytes():
    """Strings, byte strings and their dict took some 200 bytes a word."""
    own = tf.WordIds(vocabulary(FILE_VOCABULARY))
    texts = [pa.array([" ".join(f"w{k}" for k in range(n, n + 1000))]) for n in range(0, 30_000, 1000)]
    own.encode(pa.array(["warm up"]), END_ID)
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    first = [own.encode(text, END_ID) for text in texts]
    del first
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert held < 50 * 30_000
    own.library = None  # words met before are not encoded again
    assert len(own.encode(texts[0], END_ID)) == 1


def test_workers_hold_few_bytes_of_long_texts(spark, monkeypatch):
    """Batches for the workers are bounded in bytes."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    rows = [(k, " ".join(f"t{k}w{n}" for n in range(1000))) for k in range(100)]
    docs = stored(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), "long-texts")

    def checked(batch, column, most):
        assert batch.nbytes < 200_000
        yield batch

    monkeypatch.setattr(tf, "slices", checked)
    monkeypatch.setattr(tf, "BATCH_BYTES", 100_000, raising=False)
    got = tf.documents_of(docs, vocabulary(FILE_VOCABULARY), END_ID)
    _checked(got.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("crc")).collect(), rows)
    assert spark.conf.get(name) == before


def _want(rows) -> list[tuple]:
    library = Tokenizer.from_file(vocabulary(FILE_VOCABULARY))
    ids = [(r[0], library.encode(r[1] or "", add_special_tokens=False).ids + [END_ID]) for r in rows]
    return [(d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in ids]


def _checked(got, rows) -> None:
    """All documents are there, in ascending order without gaps."""
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["crc"]) for r in got) == sorted(
        (d is None, d or 0, n, c) for d, n, c in _want(rows)
    )
    ordered = sorted(got, key=lambda r: r["start"])
    keys = [(r["doc_id"] is None, r["doc_id"] or 0) for r in ordered]
    assert keys == sorted(keys)
    at = 0
    for r in ordered:
        assert r["start"] == at
        at += r["n_tokens"]


def test_sample_files(spark, sample):
    rows = [tuple(r) for r in sample("documents").select("doc_id", "text").collect()]
    got = QUERIES["op8_token_files"](spark, SF).withColumnRenamed("ids_crc32", "crc").collect()
    _checked(got, rows)


def test_odd_files(odd_docs, odd_rows):
    from pyspark.sql import functions as F

    read = tf.documents_of(odd_docs, vocabulary(FILE_VOCABULARY), END_ID)
    _checked(read.withColumn("crc", F.crc32("ids")).collect(), odd_rows)
    assert tf.documents_of(odd_docs.limit(0), vocabulary(FILE_VOCABULARY), END_ID).count() == 0


def test_files_of_more_frames_and_damage(tmp_path, monkeypatch):
    monkeypatch.setattr(tf, "FRAME_BYTES", 1000)
    rng = np.random.default_rng(1)
    docs = [(k if k % 9 else None, rng.integers(0, 1 << 30, int(rng.integers(0, 2000)), dtype="<u4").tobytes()) for k in range(60)]
    path = str(tmp_path / "x.tok.zst")
    with open(path, "wb") as out:
        writer = tf.FrameWriter(out)
        for doc in docs:
            writer.add(*doc)
        assert writer.end() == (60, sum(len(d) // 4 for _, d in docs))
    reader = tf.open_tokens(path)
    assert [(int(d) if known else None) for d, known, _ in reader.listed] == [d for d, _ in docs]
    read: list[int] = []
    whole = reader.frame
    reader.frame = lambda k: read.append(k) or whole(k)
    assert reader.document(30) == docs[30][1]
    assert len(set(read)) <= len(docs[30][1]) // 1000 + 2 < len(reader.packed)
    assert [reader.document(k) for k in range(60)] == [d for _, d in docs]
    # The plain zstandard reader sees the same bytes: the seek table is a skippable frame.
    import zstandard

    with open(path, "rb") as file:
        plain = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read()
    assert plain.startswith(b"".join(d for _, d in docs))
    data = bytearray(open(path, "rb").read())
    data[-9 - 12 * len(reader.packed) + 8] ^= 1  # the first checksum
    open(path, "wb").write(bytes(data))
    with pytest.raises(ValueError):
        tf.open_tokens(path).document(0)
