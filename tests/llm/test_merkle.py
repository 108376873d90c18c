"""The Merkle manifest beside trees built one digest after the other."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from bazaarline.llm import merkle as m
from bazaarline.llm.oracles import ORACLES
from bazaarline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more: int = 0) -> str:
    values = (row["doc_id"], row["source"], row["lang"], None if row["n_chars"] is None else row["n_chars"] + more, row["text"])
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes: list[str], arity: int) -> list[list[str]]:
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([H(*found[-1][k : k + arity]) for k in range(0, len(found[-1]), arity)])
    return found


def steps(tree: list[list[str]], at: int, arity: int) -> list[list[tuple[bool, str]]]:
    found = []
    for nodes in tree[:-1]:
        first = at // arity * arity
        found.append([(k < at, nodes[k]) for k in range(first, min(first + arity, len(nodes))) if k != at])
        at //= arity
    return found


def brute(rows, arity: int = 2, every: int = 7) -> list[tuple]:
    by_lang: dict = {}
    for row in rows:
        by_lang.setdefault(row["lang"], []).append(row)
    langs = sorted(by_lang, key=lambda name: (name is not None, (name or "").encode()))
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {lang: levels([leaf(r) for r in by_lang[lang]], arity) for lang in langs}
    top = levels([trees[lang][-1][0] for lang in langs], arity)
    found = []
    for place, lang in enumerate(langs):
        for k, row in enumerate(by_lang[lang]):
            path = steps(trees[lang], k, arity) + steps(top, place, arity)
            node = leaf(row, int(row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % every == 0))
            for run in path:
                node = H(*[d for before, d in run if before], node, *[d for before, d in run if not before])
            root = top[-1][0]
            proof = H(*[d for run in path for _, d in run])
            found.append((row["doc_id"], leaf(row), trees[lang][-1][0], root, proof, node, node == root))
    return sorted(found, key=repr)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def tampered():
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 0


def test_query(spark, sample, answers, result):
    query = QUERIES["op12_merkle"](spark, SF)
    assert rows_of(query) == brute(sample("documents").collect())
    assert result(query) == answers(ORACLES["op12_merkle"], documents=sample("documents").toPandas())


def test_odd_documents(odd_docs):
    got = m.manifest(odd_docs, tampered())
    assert rows_of(got) == brute(odd_docs.collect())
    assert m.manifest(odd_docs.limit(0), tampered()).count() == 0


@pytest.mark.parametrize(("arity", "depth"), [(2, 3), (3, 2)])
def test_other_shapes(spark, arity, depth):
    """Trees of one to 40 leaves, whose ends fall inside, at and behind the ends of buckets."""
    sizes = [1, 2, 3, 4, 8, 9, 16, 17, 27, 40]
    rows = [(k * 100 + i, f"t{i}", f"l{k:02d}" if k else None, "s", i) for k, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert rows_of(m.manifest(docs, tampered(), arity, depth)) == brute(docs.collect(), arity)


def test_one_document_and_one_language(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    one = spark.createDataFrame([(1, "x", None, None, None)], schema)
    assert rows_of(m.manifest(one)) == brute(one.collect(), every=10**12)
    same = spark.createDataFrame([(1, "x", "en", "s", 1)] * 5, schema)
    assert rows_of(m.manifest(same)) == brute(same.collect(), every=10**12)


def test_ranks_over_many_partitions(spark):
    docs = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("id"), (F.col("id") % 3 == 0).cast("string").alias("tree"))
    ranked = m.ranked(docs.repartition(13), "tree", "id").collect()
    for tree in ("true", "false"):
        ordered = sorted((r["id"], r["rank"], r["n"]) for r in ranked if r["tree"] == tree)
        assert [r[1] for r in ordered] == list(range(len(ordered)))
        assert {r[2] for r in ordered} == {len(ordered)}
