"""Vector codes beside rounds that compare every part with every entry."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarline.llm import vector_codes as vc
from bazaarline.llm.oracles import ORACLES
from bazaarline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(rows, spec: vc.CodeSpec):
    """Plain rounds in Python's integers: codes, errors and the last codebooks."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    length = max(-(-max((len(r[1]) for r in kept), default=0) // spec.parts), 1)
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = []
    for _, vector, _ in kept:
        flat = [math.floor(int(x) * spec.scale if x == int(x) else x * spec.scale) for x in vector]
        flat += [0] * (length * spec.parts - len(flat))
        ints.append([flat[p * length : (p + 1) * length] for p in range(spec.parts)])
    books = [[list(v[p]) for v in ints[: spec.entries]] for p in range(spec.parts)]

    def nearest(part, piece):
        return min((sum((a - b) ** 2 for a, b in zip(piece, e, strict=True)), k) for k, e in enumerate(books[part]))

    for _ in range(spec.rounds):
        for part in range(spec.parts):
            of: dict[int, list] = {}
            for v in ints:
                of.setdefault(nearest(part, v[part])[1], []).append(v[part])
            for k, pieces in of.items():
                books[part][k] = [sum(c) // len(pieces) for c in zip(*pieces, strict=True)]
    found = []
    for (vec_id, _, label), v in zip(kept, ints, strict=True):
        told = [nearest(p, v[p]) for p in range(spec.parts)]
        found.append((vec_id, label, "".join(f"{k:02x}" for _, k in told), sum(d for d, _ in told)))
    return sorted(found, key=repr), books


def rows_of(codes: vc.Codes) -> list[tuple]:
    rows = codes.rows.select("vec_id", "label", "code", "error").collect()
    return sorted(((r[0], r[1], r[2], None if r[3] is None else int(r[3])) for r in rows), key=repr)


SCHEMA = "vec_id bigint, embedding array<float>, label int"


def test_query(spark, sample, answers, result):
    query = QUERIES["op11_vector_codes"](spark, SF)
    table = sample("embeddings")
    assert result(query) == answers(ORACLES["op11_vector_codes"], embeddings=table.toArrow())
    rows = [tuple(r) for r in table.select("vec_id", "embedding", "label").collect()]
    want, books = brute(rows, vc.CodeSpec())
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in query.collect()) == sorted((w[0], w[2], w[3]) for w in want)
    assert {r["codebooks_sha256"] for r in query.collect()} == {vc.books_digest(books)}


ODD = [
    (1, [1.0, 2.0, 3.0, 4.0], 1),
    (1, [1.0, 2.0, 3.0, 4.0], 1),
    (2, None, 1),
    (3, [1.0, None, 3.0, 4.0], None),
    (4, [float("nan"), 0.0, 0.0, 0.0], 2),
    (5, [float("inf"), 0.0, 0.0, 0.0], 2),
    (6, [], 2),
    (7, [-0.001, 0.5, -3.25], None),
    (None, [0.1, 0.2, 0.3, 0.4], None),
    (None, [0.1, 0.2, 0.3, 0.4, 0.5], 3),
]


def test_odd_vectors(spark):
    spec = vc.CodeSpec(parts=2, entries=3, rounds=4, scale=4096)
    clashing = [c for c in ("code", "ints", "state", "note", "error", "part", "label_")]
    table = spark.createDataFrame(ODD, SCHEMA).select("*", *[F.lit("?").alias(c) for c in clashing]).repartition(3)
    codes = vc.compress(table, spec)
    want, books = brute(ODD, spec)
    assert rows_of(codes) == want
    assert codes.codebooks == books
    errors = {}
    for _, label, _, error in want:
        errors[label] = errors.get(label, 0) + error
    assert all(r["label_error"] == errors[r["label"]] for r in vc.with_label_error(codes.rows).collect())
    empty = vc.compress(table.limit(0), spec)
    assert empty.rows.count() == 0 and vc.with_label_error(empty.rows).count() == 0


@pytest.mark.parametrize("size", [1e9, 1e30])
def test_large_components(spark, size):
    """Beyond what doubles hold exactly, Python's integers count."""
    random = np.random.default_rng(1)
    rows = [(k, [float(x) for x in (random.normal(size=4) * size).astype("float32")], k % 3) for k in range(60)]
    spec = vc.CodeSpec(parts=2, entries=4, rounds=3)
    codes = vc.compress(spark.createDataFrame(rows, SCHEMA), spec)
    want, books = brute(rows, spec)
    assert codes.codebooks == books
    most = 10**38
    assert rows_of(codes) == sorted(((*w[:3], w[3] if w[3] < most else None) for w in want), key=repr)


def test_bounds_spare_rescans_and_change_nothing(spark):
    """Well parted groups: after the first rounds most parts keep their entry by the bounds alone."""
    random = np.random.default_rng(2)
    centres = random.normal(size=(16, 16))
    rows = [(k, [float(x) for x in centres[k % 16] + 0.02 * random.normal(size=16)], 0) for k in range(1500)]
    spec = vc.CodeSpec(parts=4, entries=16, rounds=6)
    codes = vc.compress(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"), spec)
    want, books = brute(rows, spec)
    assert rows_of(codes) == want and codes.codebooks == books
    assert codes.rescans[0] == 1500 * 4
    assert codes.rescans[-1] < 1500 * 4 // 10


def test_net_displacement_is_tighter_than_drifts():
    """An entry that went away and came back has not moved since the first round."""
    there = [[[0, 0], [9, 9]]]
    away = [[[5, 0], [9, 9]]]
    book = vc.Book([there, away, there], exact=True)
    assert book.moved[0, 0, 0] == 0 and book.moved[1, 0, 0] == 5
    drifts = 5 + 5
    assert book.moved[0, 0, 0] < drifts


def test_ties_go_to_the_lower_entry():
    book = vc.Book([[[[0], [2], [2]]]], exact=True)
    state, _ = vc.assign(book, np.array([[[1.0]], [[2.0]]]), None)
    assert state["code"].ravel().tolist() == [0, 1]
    again, _ = vc.assign(book, np.array([[[1.0]], [[2.0]]]), state)
    assert again["code"].ravel().tolist() == [0, 1]


def test_reconstruct(spark):
    spec = vc.CodeSpec(parts=2, entries=2, rounds=1, scale=4)
    rows = [(k, [k * 1.0, 1.0, 2.0, k * 2.0], 0) for k in range(2)]
    codes = vc.compress(spark.createDataFrame(rows, SCHEMA), spec)
    back = codes.rows.select("vec_id", vc.reconstruct(F.col("code"), codes.codebooks, spec).alias("v")).collect()
    assert sorted((r["vec_id"], r["v"]) for r in back) == [(0, [0.0, 1.0, 2.0, 0.0]), (1, [1.0, 1.0, 2.0, 2.0])]
