"""Near-duplicates beside a brute force over all pairs."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter
from math import log

import numpy as np
import pyarrow as pa
import pytest

from bazaarline.llm import near_dedup as nd
from bazaarline.llm.shared import stored


def _shingles(text: str | None) -> Counter:
    words = (text or "").lower().split()
    return Counter([tuple(words[k : k + 5]) for k in range(len(words) - 4)] or ([tuple(words)] if words else []))


def _roots(edges, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.fixture(scope="module")
def copies(sample):
    """Sample texts, copies of some with few and with more words changed, and a chain."""
    rng = random.Random(11)
    texts = [r["text"] for r in sample("documents").select("text").orderBy("doc_id").collect()]
    out = list(texts)
    for k in range(0, 60, 3):
        words = texts[k].split()
        for share in (0.005, 0.02, 0.3):
            out.append(" ".join(w if rng.random() > share else f"new{rng.random()}" for w in words))
        out.append(texts[k].upper())
    words = [f"w{k}" for k in range(200)]
    for step in range(8):  # each like the one before, the last unlike the first
        out.append(" ".join(words[step * 8 :] + [f"x{k}" for k in range(step * 8)]))
    return out


def _brute(texts: list[str]) -> tuple[dict, list[float]]:
    sets = [_shingles(t) for t in texts]
    df = Counter(s for c in sets for s in c)
    n = sum(1 for c in sets if c)
    rarest = log((1 + n) / 1)  # of a counter that no text has
    weight = {s: log((1 + n) / (1 + f)) / rarest + 1 for s, f in df.items()}
    sums = [sum(c[s] * weight[s] for s in c) for c in sets]
    edges, close = [], []
    for a in range(len(texts)):
        for b in range(a):
            common = sum(min(sets[a][s], sets[b][s]) * weight[s] for s in sets[a].keys() & sets[b].keys())
            if sets[a] or sets[b]:
                found = common / (sums[a] + sums[b] - common)
                if abs(found - 0.8) < 0.03:
                    close.append((a, b))
                if found >= 0.8:
                    edges.append((b, a))
    return _roots(edges, range(len(texts))), close


def test_classes_beside_all_pairs(spark, copies):
    want, close = _brute(copies)
    unsure = {want[x] for pair in close for x in pair}
    docs = spark.createDataFrame(list(enumerate(copies)), "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: r["class_id"] for r in nd.classes(docs).rows.collect()}
    assert len(got) == len(copies)
    differ = [k for k in got if got[k] != want[k] and want[k] not in unsure and want[got[k]] not in unsure]
    assert differ == [] and len(set(want.values())) < len(copies) - 60


def test_odd_texts(spark, odd_docs, odd_rows, rows):
    got = rows(nd.classes(odd_docs).rows, "doc_id", "class_id", "class_rows")
    assert len(got) == len(odd_rows)
    # 1 twice and 2 are the same words; 7 and 8 differ in one word; four texts have no word.
    assert [g for g in got if g[0] in (1, 2)] == [(1, 1, 3), (1, 1, 3), (2, 1, 3)]
    assert [g for g in got if g[0] in (7, 8)] == [(7, 7, 2), (8, 7, 2)]
    assert [g for g in got if g[0] in (3, 4, 5)] == [(3, 3, 4), (4, 3, 4), (5, 3, 4)]
    kept = nd.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    classes = {(g[1], g[2]) for g in got}
    assert kept.count() == len(classes)
    assert nd.classes(odd_docs.limit(0)).rows.count() == 0
    assert nd.one_of_each(odd_docs.limit(0)).count() == 0


def test_members_unlike_their_leader_are_compared(spark, monkeypatch):
    """One bucket for all: groups of copies must still be found, each by a leader of its own."""
    monkeypatch.setattr(nd, "samples", lambda found, weights, number: np.ones((len(found.texts), number), "uint64"))
    rng = random.Random(2)
    texts = []
    for group in range(7):
        words = [f"g{group}w{k}" for k in range(120)]
        for _ in range(5):
            changed = list(words)
            changed[rng.randrange(120)] = f"new{rng.random()}"
            texts.append(" ".join(changed))
    want, _ = _brute(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in nd.classes(docs).rows.collect()}
    assert got == want and len(set(want.values())) == 7


def test_edited_copy_of_a_third_of_all_rows(spark):
    """Common shingles weigh little there; the similarity without weights counts as well."""
    base = [f"w{k}" for k in range(200)]
    edited = [f"new{k}" if k in (30, 80, 120, 160) else w for k, w in enumerate(base)]
    less = [f"new{k}" if k % 25 == 10 else w for k, w in enumerate(base)]
    texts = [" ".join(base)] * 100 + [" ".join(f"t{n}w{k}" for k in range(40)) for n in range(200)]
    texts += [" ".join(edited), " ".join(less)]
    plain = []
    for other in texts[-2:]:
        a, b = _shingles(texts[0]), _shingles(other)
        plain.append((a & b).total() / (a | b).total())
    assert plain[0] > 0.81 and plain[1] < 0.75
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in nd.classes(docs).rows.collect()}
    assert got[300] == 0 and got[301] == 301


def test_components_of_paths_and_stars(spark):
    def node(k: int) -> bytes:
        return (k * 2654435761 % 2**32).to_bytes(4, "big")

    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 200)]
    told = spark.createDataFrame([(node(a), node(b)) for a, b in edges], "a binary, b binary")
    got = {bytes(r["node"]): bytes(r["root"]) for r in nd.components(told).collect()}
    want = _roots([(node(a), node(b)) for a, b in edges], {node(x) for e in edges for x in e})
    assert {n: got.get(n, n) for n in want} == want
    assert nd.components(told.limit(0)).count() == 0


def test_samples_agree_as_weighted_similarity():
    base = [f"w{k}" for k in range(300)]
    other = base[:200] + [f"v{k}" for k in range(100)]
    found = nd.shingles_of(pa.array([" ".join(base), " ".join(other)]), 5)
    weights = found.counts * (1 + found.hashes % np.uint32(3))
    drawn = nd.samples(found, weights, 2000)
    half = found.starts[1]
    a, b = dict(zip(found.hashes[:half], weights[:half], strict=True)), dict(zip(found.hashes[half:], weights[half:], strict=True))
    want = sum(min(a.get(s, 0), b.get(s, 0)) for s in a | b) / sum(max(a.get(s, 0), b.get(s, 0)) for s in a | b)
    assert abs((drawn[0] == drawn[1]).mean() - want) < 0.04


def test_frequencies_count_all_texts(spark):
    texts = ["a b c d e f"] * 3 + ["a b c d e"] + [None, ""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").fillna("").repartition(4)
    idf = nd.inverse_frequencies(docs, nd.Near())
    found = nd.shingles_of(pa.array(["a b c d e"]), 5)
    assert idf[found.hashes[0] & np.uint32(nd.COUNTERS - 1)] == pytest.approx(1)
    assert idf.max() == pytest.approx(2)


def test_table_of_the_distribution_is_made_in_pieces():
    tracemalloc.start()
    value, inverse, log_value = nd._gamma.__wrapped__()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 16_000_000
    x = np.linspace(0, 40, 4_000_001)
    want = np.interp((np.arange(1 << 16) + 0.5) / (1 << 16), 1 - (1 + x) * np.exp(-x), x)
    assert np.array_equal(value, want.astype("float32"))
    assert np.array_equal(inverse, (1 / want).astype("float32"))
    assert np.array_equal(log_value, np.log(want).astype("float32"))


def test_workers_hold_few_bytes_of_long_texts(spark, monkeypatch):
    """Batches are bounded in bytes, and nothing starts workers for rows made by the driver."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    rows = [(k, " ".join(f"t{k // 2}w{n}" for n in range(1000 + k % 2))) for k in range(200)]
    docs = stored(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), "long-texts")

    def checked(batch, column, most):
        assert batch.nbytes < 200_000
        yield batch

    def refused(*_, **__):
        raise AssertionError("rows from Python")

    monkeypatch.setattr(nd, "slices", checked)
    monkeypatch.setattr(nd, "BATCH_BYTES", 100_000, raising=False)
    monkeypatch.setattr(type(spark), "createDataFrame", refused)
    got = {r["doc_id"]: r["class_id"] for r in nd.classes(docs).rows.collect()}
    assert got == {k: k // 2 * 2 for k in range(200)}
    assert spark.conf.get(name) == before
