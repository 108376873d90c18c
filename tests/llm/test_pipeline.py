"""The stages one after the other, each beside what its operator says of its own input."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from bazaarline.llm import decontaminate as dc
from bazaarline.llm import mixing as mx
from bazaarline.llm import near_dedup as nd
from bazaarline.llm import quality
from bazaarline.llm.queries import END_ID, FILE_VOCABULARY, vocabulary
from bazaarline.llm.shared import stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, sample):
    docs = [sample("documents")]
    for _, stage in cp.STAGES:
        docs.append(stored(stage(spark, docs[-1], SF), "step"))
    return docs


def test_stages_keep_the_columns(steps):
    assert [name for name, _ in cp.STAGES] == [
        "quality rules",
        "MinHash near-dedup",
        "benchmark decontamination",
        "mixing sources to target weights",
        "token-ID / binary output",
    ]
    for step in steps[1:-1]:
        assert step.columns == steps[0].columns


def test_each_stage_does_what_its_operator_says(spark, sample, steps):
    def ids(df):
        return sorted(r["doc_id"] for r in df.select("doc_id").collect())

    assert ids(steps[1]) == ids(quality.judge_documents(steps[0]).where("kept")) and len(ids(steps[1])) < 200
    classes = {r["class_id"] for r in nd.classes(steps[1]).rows.collect()}
    assert ids(steps[2]) == sorted(classes)
    leaked = {r["doc_id"] for r in dc.leaked(steps[2], sample("benchmark")).collect()}
    assert ids(steps[3]) == sorted(classes - leaked) and leaked
    taken = {r["doc_id"]: r["taken"] for r in mx.taken_words(steps[3]).collect()}
    mixed = steps[4].collect()
    words = dict.fromkeys(taken, 0)
    for r in mixed:
        words[r["doc_id"]] += len(mx.WORDS.findall(r["text"]))
    assert words == taken
    library = Tokenizer.from_file(vocabulary(FILE_VOCABULARY))
    want = []
    for r in mixed:
        found = np.array([*library.encode(r["text"], add_special_tokens=False).ids, END_ID], "<u4")
        want.append((r["doc_id"], len(found), zlib.crc32(found.tobytes())))
    got = steps[5].collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(want)
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])] == sorted(w[0] for w in want)


def test_run_is_the_stages(spark, steps, rows):
    assert rows(cp.run(spark, SF), "doc_id", "start", "n_tokens", "ids_crc32") == rows(
        steps[-1], "doc_id", "start", "n_tokens", "ids_crc32"
    )


def test_odd_documents_pass_all_stages(spark, odd_docs):
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars", "kept", "row")
    for _, stage in cp.STAGES:
        docs = stored(stage(spark, docs, SF), "step")
    assert docs.count() >= 1
    empty = odd_docs.limit(0).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in cp.STAGES:
        empty = stored(stage(spark, empty, SF), "step")
    assert empty.count() == 0
