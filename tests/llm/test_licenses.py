"""Licence texts beside an alignment of every template with every text."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from bazaarline.llm import licenses as lc
from bazaarline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _best(template: list[str], text: list[str]) -> float:
    """The best share of equal columns over all alignments of the template with a run of the text."""
    best = [(0, 0)] * (len(text) + 1)  # score, columns
    for word in template:
        row = [(best[0][0] - 1, best[0][1] + 1)]
        for j, other in enumerate(text, 1):
            options = [
                (best[j - 1][0] + (1 if word == other else -1), best[j - 1][1] + 1),
                (best[j][0] - 1, best[j][1] + 1),
                (row[j - 1][0] - 1, row[j - 1][1] + 1),
            ]
            row.append(max(options, key=lambda o: (o[0], -o[1])))
        best = row
    score, columns = max(best, key=lambda o: (o[0], -o[1]))
    return (score + columns) / 2 / columns


def test_changed_notices_beside_full_alignment():
    rng = random.Random(4)
    index = lc.index_of(lc.TEMPLATES)
    texts, want = [], []
    for name, template in sorted(lc.TEMPLATES.items()) * 3:
        words = lc.WORD.findall(template.lower())
        for at in rng.sample(range(len(words)), len(words) // 12):
            words[at] = "changed"
        pad = [f"pad{rng.random()}".replace(".", "") for _ in range(30)]
        texts.append(" ".join(pad[:15] + words + pad[15:]))
        want.append(name)
    found = lc.scan_batch(index, pa.array(texts))
    for text, name, got in zip(texts, want, found, strict=True):
        words = text.split()
        shares = {n: _best(lc.WORD.findall(t.lower()), words) for n, t in lc.TEMPLATES.items()}
        names = {index.names[m[0]] for m in got}
        assert all(shares[n] >= lc.MIN_IDENTITY for n in names)
        assert name in names or any(shares[n] >= shares[name] for n in names), (name, names)


def test_clean_texts_are_left_alone(sample):
    texts = [r["text"] for r in sample("documents").collect()]
    found = lc.scan_batch(lc.index_of(lc.TEMPLATES), pa.array(texts))
    for text, got in zip(texts, found, strict=True):
        marks = ("MIT License", "Apache License", "General Public License", "CC BY")
        assert bool(got) == any(m in text for m in marks)


def test_spans_and_places(spark):
    notice = "Released under the MIT License."
    text = f"İxİ é. {notice} and more {notice}\nLicensed under CC BY-NC 4.0."
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    got = sorted(lc.scan(docs).collect(), key=lambda r: r["span_start"])
    assert [(r["license"], text[r["span_start"] : r["span_end"]], r["coverage"]) for r in got] == [
        ("MIT", notice[:-1], 1.0),
        ("MIT", notice[:-1], 1.0),
        ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0", 1.0),
    ]


def test_parts_of_templates(spark):
    words = lc.TEMPLATES["MIT-text"].split()
    added = " ".join(f"other{k}" for k in range(12))
    texts = [
        "x y " + " ".join(words[-70:]) + " z",  # the end of the warranty
        "x " + " ".join(words[:90]) + f" {added} " + " ".join(words[90:]),
        "x THE SOFTWARE IS PROVIDED here",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = sorted((r for r in lc.scan(docs).collect() if r["license"] == "MIT-text"), key=lambda r: (r["doc_id"], r["span_start"]))
    assert [r["doc_id"] for r in got] == [0, 1, 1] and not any(r["whole"] for r in got)
    assert texts[0][got[0]["span_start"] : got[0]["span_end"]] == " ".join(words[-70:])[:-1]
    assert got[1]["coverage"] + got[2]["coverage"] == 1


def test_more_templates_take_more_passes(spark, monkeypatch, rows):
    docs = spark.createDataFrame([(k, f"a b c {t} d") for k, t in enumerate(lc.TEMPLATES.values())], "doc_id bigint, text string")
    whole = rows(lc.scan(docs), "doc_id", "license", "matched_words")
    monkeypatch.setattr(lc, "PASS_WORDS", 20)
    assert set(whole) <= set(rows(lc.scan(docs), "doc_id", "license", "matched_words"))
    assert len({w[0] for w in whole}) == len(lc.TEMPLATES)


def test_odd_tables(spark, odd_docs, odd_rows):
    line = odd_rows[0][1]
    got = lc.scan(odd_docs, {"line": line, "brief": "fox jumps", "none": "", "pear": "pommes pour Marie"}).collect()
    where = [r[0] for r in odd_rows for _ in range((r[1] or "").count(line))]
    assert sorted(map(repr, (r["doc_id"] for r in got if r["license"] == "line"))) == sorted(map(repr, where))
    assert [r["doc_id"] for r in got if r["license"] == "pear"].count(6) == 2
    assert lc.scan(odd_docs.limit(0)).count() == 0
    assert lc.scan(odd_docs, {}).count() == 0


def test_winnowing_shares_a_fingerprint():
    rng = np.random.default_rng(2)
    for _ in range(200):
        common = rng.integers(0, 50, lc.GRAM + lc.WINNOW - 1, dtype="uint64")
        texts = [np.concatenate([rng.integers(50, 99, 9, dtype="uint64"), common, rng.integers(50, 99, 9, dtype="uint64")]) for _ in "ab"]
        prints = [set(lc.grams(t)[lc.winnowed(lc.grams(t))].tolist()) for t in texts]
        assert prints[0] & prints[1]


def test_sample(spark):
    assert {r["license"] for r in QUERIES["op10_licenses"](spark, SF).collect()} <= set(lc.TEMPLATES)
