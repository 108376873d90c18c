"""Targets, permutations and draws of a mix."""

from __future__ import annotations

import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bazaarline.llm import mixing as mx
from bazaarline.llm.queries import QUERIES
from bazaarline.llm.shared import stored

SF = "/root/testdata/sf0.001"


def test_permutations():
    for size in (1, 2, 3, 5, 16, 17, 1000, 4097):
        for key in (0, 1, 2**60):
            assert sorted(mx.permuted(np.arange(size), size, key)) == list(range(size))
            assert mx.permuted(mx.permuted(np.arange(size), size, key), size, key, back=True).tolist() == list(range(size))
    # One place of many is found without the others.
    far = np.array([10**12 + 7])
    assert mx.permuted(mx.permuted(far, 2 * 10**12, 5, back=True), 2 * 10**12, 5).tolist() == far.tolist()
    assert mx.permuted(np.arange(1000), 1000, 1).tolist() != mx.permuted(np.arange(1000), 1000, 2).tolist()


def test_targets_share_what_sources_cannot_give():
    assert mx.targets_of([100, 100, 100], mx.Mix()) == [200, Fraction(500, 3), Fraction(250, 3)]
    assert mx.targets_of([], mx.Mix()) == [] and mx.targets_of([0, 0], mx.Mix()) == [0, 0]
    rng = random.Random(1)
    for _ in range(100):
        sizes = [rng.choice([0, 1, 10, 1000, 50_000]) for _ in range(rng.randrange(1, 9))]
        targets = mx.targets_of(sizes, mx.Mix())
        assert sum(targets) == Fraction(3, 2) * sum(sizes)
        assert all(0 <= t <= 2 * n for t, n in zip(targets, sizes, strict=True))
        # Sources below their limit share by weight.
        units = {t / mx.WEIGHTS[k % 3] for k, (t, n) in enumerate(zip(targets, sizes, strict=True)) if t < 2 * n}
        assert len(units) <= 1
        assert all(t / mx.WEIGHTS[k % 3] <= min(units, default=t) for k, t in enumerate(targets) if units)


def test_quotas_are_met_to_the_word():
    mix = mx.Mix(block_words=7)
    for size in (1, 6, 7, 8, 50, 700, 701):
        for words in {0, 1, size // 3, size, size + 1, 2 * size - 1, 2 * size}:
            quota = mx.quota_of(3, size, Fraction(words), mix)
            lengths = [min(7, size - 7 * k) for k in range(quota.blocks)]
            taken = Counter()
            for draw in range(quota.slots):
                turn, index = divmod(draw, quota.blocks)
                block = int(mx.permuted(np.array([index]), quota.blocks, mx._key(mix, 3, turn))[0])
                taken[block] += min(lengths[block], quota.last if draw == quota.slots - 1 else 7)
            assert sum(taken.values()) == words and all(taken[b] <= 2 * lengths[b] for b in taken)


@pytest.fixture(scope="module")
def mixed_sample(spark):
    return QUERIES["op4_mixing"](spark, SF).collect()


def test_sample(spark, sample, mixed_sample):
    texts = {r["doc_id"]: r for r in sample("documents").collect()}
    taken, sizes, targets = Counter(), Counter(), {}
    for r in mixed_sample:
        assert r["size"] == len(mx.WORDS.findall(texts[r["doc_id"]]["text"])) and 0 <= r["taken"] <= 2 * r["size"]
        source = texts[r["doc_id"]]["source"]
        taken[source] += r["taken"]
        sizes[source] += r["size"]
        targets[source] = (r["source_size"], r["target"])
    ordered = sorted(sizes)
    want = mx.targets_of([sizes[s] for s in ordered], mx.Mix())
    for source, target in zip(ordered, want, strict=True):
        assert targets[source] == (sizes[source], float(target)) and taken[source] == int(target)
    assert len(mixed_sample) == len(texts)


def test_reruns_agree(spark, settings, sample, mixed_sample, rows):
    settings(spark__sql__shuffle__partitions="3")
    again = mx.taken_words(sample("documents").repartition(6))
    assert rows(again) == sorted((tuple(r) for r in mixed_sample), key=repr)


def test_shards_draw_by_themselves_and_meet_the_quota(spark, sample):
    mix = mx.Mix(block_words=16, shard_slots=64)
    quotas = [mx.quota_of(k, n, t, mix) for k, (n, t) in enumerate(zip((4000, 900, 77), (Fraction(5000), Fraction(1500), Fraction(10)), strict=True))]
    counts = mx.shard_counts(spark.range(1), quotas, mix)
    by_shard, by_source, places = Counter(), Counter(), set()
    for r in counts.collect():
        by_shard[r["shard"]] += r["slots"]
        by_source[r["source"]] += r["slots"]
        new = {(r["source"], r["first"] + k) for k in range(r["slots"])}
        assert not places & new
        places |= new
    assert [by_source[k] for k in range(3)] == [q.slots for q in quotas]
    assert places == {(k, n) for k, q in enumerate(quotas) for n in range(q.slots)}
    assert set(sorted(by_shard.values())[1:]) == {64}


def test_texts_of_the_mix(spark, sample, mixed_sample):
    docs = sample("documents")
    mixed = mx.mixed_texts(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in mixed.collect():
        own = mx.WORDS.findall(r["text"])
        words[r["doc_id"]] += len(own)
        assert r["n_chars"] == len(r["text"]) and not Counter(own) - Counter(mx.WORDS.findall(texts[r["doc_id"]]))
    assert {r["doc_id"]: r["taken"] for r in mixed_sample if r["taken"]} == dict(words)


def test_odd_tables(spark, odd_docs, odd_rows):
    got = mx.taken_words(odd_docs).collect()
    assert len(got) == len(odd_rows)
    assert sorted(r["size"] for r in got) == sorted(len(mx.WORDS.findall(r[1] or "")) for r in odd_rows)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    for name in {r[3] for r in odd_rows}:
        size = sum(len(mx.WORDS.findall(r[1] or "")) for r in odd_rows if r[3] == name)
        same = [r for r in got if r["source_size"] == size]
        assert sum(r["taken"] for r in same) == sum({int(r["target"]) for r in same})
    texts = mx.mixed_texts(odd_docs)
    assert texts.columns == odd_docs.columns
    assert sum(len(mx.WORDS.findall(r["text"])) for r in texts.select("text").collect()) == sum(r["taken"] for r in got)
    assert mx.taken_words(odd_docs.limit(0)).count() == 0 and mx.mixed_texts(odd_docs.limit(0)).count() == 0


def test_sums_before_in_two_levels(spark):
    rng = random.Random(3)
    rows = [(s, k, rng.randrange(9)) for s in range(50) for k in range(3) if rng.random() < 0.8]
    df = spark.createDataFrame(rows, "shard bigint, source int, drawn bigint")
    got = mx._with_sum_before(df, ["source"], "drawn", "first", 50).collect()
    assert {(r["shard"], r["source"]): r["first"] for r in got} == {
        (s, k): sum(n for t, j, n in rows if j == k and t < s) for s, k, _ in rows
    }
    line = mx._with_sum_before(df.groupBy("shard").agg(F.sum("drawn").alias("over")), [], "over", "begins", 50).collect()
    assert {r["shard"]: r["begins"] for r in line} == {s: sum(n for t, _, n in rows if t < s) for s, _, _ in rows}
    assert mx._with_sum_before(df.limit(0), ["source"], "drawn", "first", 0).count() == 0


def test_workers_get_a_text_once_and_no_rows_of_the_driver(spark, monkeypatch):
    """Rows that the driver makes from Python objects start a second set of Python workers."""
    rows = [(k, " ".join(f"w{n}" for n in range(200)), "ab"[k % 2], 0) for k in range(20)]
    docs = stored(spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint"), "texts")
    made = type(spark).createDataFrame

    def tables_only(self, data, *args, **kwargs):
        assert isinstance(data, pa.Table)
        return made(self, data, *args, **kwargs)

    def checked(batch, column, most):
        assert batch.column(0).type.names == ["doc_id", "source"]
        yield batch

    monkeypatch.setattr(type(spark), "createDataFrame", tables_only)
    monkeypatch.setattr(mx, "slices", checked, raising=False)
    got = mx.mixed_texts(docs)
    assert got.columns == docs.columns
    found = got.collect()
    assert sum(len(r["text"].split()) for r in found) == 20 * 200 * 3 // 2
    assert all(r["n_chars"] == len(r["text"]) and r["source"] == "ab"[r["doc_id"] % 2] for r in found)
