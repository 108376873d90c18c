"""Benchmark items in texts, whole, changed and at the borders of chunks."""

from __future__ import annotations

from bazaarline.llm import decontaminate as dc
from bazaarline.llm.decontaminate import leaked, without_leaks
from bazaarline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ITEM = "If Tom has 5 kg of apples and gives Mary 2 kg of them, how much does Tom have left to sell?"


def _items(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")


def _docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_sample_beside_brute_force(spark, sample):
    items = {r["item_id"]: r["text"].lower().split() for r in sample("benchmark").collect()}
    windows: dict[tuple, set] = {}
    for item, words in items.items():
        for k in range(len(words) - 7):
            windows.setdefault(tuple(words[k : k + 8]), set()).add(item)
    want = set()
    for r in sample("documents").collect():
        words = r["text"].lower().split()
        for k in range(len(words) - 7):
            want |= {(r["doc_id"], i) for i in windows.get(tuple(words[k : k + 8]), ())}
    got = QUERIES["op5_decontamination"](spark, SF).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and want
    assert not any(r["changed"] for r in got)


def test_main_path_has_no_python(spark):
    plan = QUERIES["op5_decontamination"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_changed_values_must_agree(spark, rows):
    docs = _docs(
        spark,
        f"Before it. {ITEM} After it.",
        "x. If Bob has 7 lb of apples and gives Ann 3 lb of them, how much does Bob have left to sell?",
        "x. If Bob has 7 lb of apples and gives Ann 3 lb of them, how much does Joe have left to sell?",
        "x. If Bob has 7 lb of apples and gives Bob 3 lb of them, how much does Bob have left to sell?",
        ITEM.lower().replace(",", " ,").replace(" ", "\n"),
        "Other words are here that no item of any list has, and none of them will ever be found.",
    )
    got = rows(dc.leaked(docs, _items(spark, ITEM)), "doc_id", "changed")
    assert [g for g in got if g[0] != 4] == [(0, False), (1, True)]


def test_item_across_chunks(spark, rows, monkeypatch):
    monkeypatch.setattr(dc, "CHUNK", 10)
    docs = _docs(spark, *[" ".join(f"pad{k}" for k in range(n)) + f". {ITEM} end" for n in range(0, 23)])
    got = {r["doc_id"]: r["matched_tokens"] for r in dc.leaked(docs, _items(spark, ITEM)).collect()}
    assert got == {n: 22 for n in range(23)}


def test_many_items_are_joined_by_a_shuffle(spark, rows, monkeypatch):
    docs = _docs(spark, ITEM, "nothing", ITEM.replace("5", "9"))
    want = rows(dc.leaked(docs, _items(spark, ITEM, "x")), "doc_id", "item_id", "changed")
    monkeypatch.setattr(dc, "BROADCAST_WINDOWS", 0)
    monkeypatch.setattr(dc, "BROADCAST_DOCS", 0)
    assert rows(dc.leaked(docs, _items(spark, ITEM, "x")), "doc_id", "item_id", "changed") == want
    assert [r["doc_id"] for r in dc.without_leaks(docs, _items(spark, ITEM)).collect()] == [1]


def test_items_that_differ_in_values_count_once(spark, rows):
    items = _items(spark, ITEM, ITEM.replace("5", "6").replace("Tom", "Jim"))
    assert rows(dc.leaked(_docs(spark, ITEM), items), "doc_id", "item_id") == [(0, 0)]


def test_items_of_one_shape_with_other_equal_values(spark, rows):
    equal, other = ITEM.replace("2", "5"), ITEM.replace("Mary", "Tom")
    items = _items(spark, equal, ITEM, other, ITEM.replace("5", "6"))
    got = rows(dc.leaked(_docs(spark, f"a. {ITEM} b", f"a. {equal} b", f"a. {other} b"), items), "doc_id", "item_id", "changed")
    assert {(0, 1, False), (1, 0, False), (2, 2, False)} <= set(got)
    assert rows(dc.item_groups(items), "item_id", "group_item") == [(0, 0), (1, 1), (2, 2), (3, 1)]


def test_copies_in_other_case_and_of_numbers_only(spark, rows):
    title = "Green River Summer Fair Opens Near Old Stone Bridge"
    items = _items(spark, ITEM, title, "3 5 8 13 21 34 55 89", "seven plus two", ITEM.replace("5", "6"))
    docs = _docs(
        spark,
        ITEM.lower(),
        f"x {ITEM.upper()} y",
        ITEM.replace(" ", "\n"),
        f"so {title.lower()} and",
        f"so {title} and",
        "count 3 5 8 13 21 34 55 89 on",
        "it is Seven plus\ntwo now",
        "it is Seven plus one now",
        ITEM.replace("5", "6").upper(),
    )
    got = rows(dc.leaked(docs, items), "doc_id", "item_id", "group_item", "changed")
    assert got == [(0, 0, 0, False), (1, 0, 0, False), (2, 0, 0, False), (3, 1, 1, False), (4, 1, 1, False), (5, 2, 2, False), (6, 3, 3, False), (8, 4, 0, False)]


def test_one_altered_value_in_a_long_copy(spark, rows):
    middle = "the baker then counts every loaf on the long shelf and writes the number down in a small red book"
    item = f"On a day in May the baker Tom sells 5 loaves and {middle} while Tom keeps 5 loaves for the poor of the town"
    docs = _docs(
        spark,
        item.replace("keeps 5", "keeps 7"),
        item.replace("while Tom", "while Jim"),
        "On a day in May the baker Tom sells 5 loaves and none is left, Tom keeps 7 loaves",
    )
    got = rows(dc.leaked(docs, _items(spark, item)), "doc_id", "matched_tokens")
    assert [g[0] for g in got] == [0, 1] and all(g[1] >= 30 for g in got)
    # Two places of one value filled differently do not fit, but all other windows are equal.
    both = item.replace("sells 5", "sells 6").replace("keeps 5", "keeps 7")
    assert rows(dc.leaked(_docs(spark, both), _items(spark, item)), "doc_id", "changed") == [(0, False)]


def test_odd_tables(spark, odd_docs, odd_rows):
    from pyspark.sql import functions as F

    line = odd_rows[0][1]
    items = spark.createDataFrame([(1, line), (None, line), (2, None), (3, ""), (4, "too short")], "item_id bigint, text string")
    items = items.withColumn("hash", F.lit("?"))
    kept = dc.without_leaks(odd_docs, items)
    assert kept.columns == odd_docs.columns
    with_line = [r for r in odd_rows if r[1] and line in r[1]]
    assert kept.count() == len(odd_rows) - len(with_line)
    assert {r["item_id"] for r in dc.leaked(odd_docs, items).collect()} == {1}
    assert dc.leaked(odd_docs.limit(0), items).count() == 0
    assert dc.without_leaks(odd_docs, items.limit(0)).count() == len(odd_rows)


def test_common_phrases_are_no_evidence(spark):
    """Essays that hold a stem of 50 items stay; texts with an item of them go, whole, typed or in part."""
    stem = "which of the following statements is correct about the"
    names = [f"alpha{k} beta{k} gamma{k} delta{k} epsilon{k} zeta{k} eta{k} theta{k} iota{k}" for k in range(50)]
    items = [(k, f"{stem} {own}") for k, own in enumerate(names)]
    essays = [(k, " ".join(f"w{k}x{i}" for i in range(150)) + f" {stem} " + " ".join(f"v{k}x{i}" for i in range(150))) for k in range(20)]
    # The word behind the stem is the item's, too.
    essays += [(20, f"some words here {stem} alpha7 and other words that follow it")]
    copies = [(100 + k, f"before it {stem} {names[k]} and after it") for k in (0, 7, 49)]
    copies += [(200, f"only the own part {names[3]} without its stem")]
    docs = spark.createDataFrame(essays + copies, "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = sorted((r["doc_id"], r["item_id"], r["similar_items"]) for r in leaked(docs, benchmark).collect())
    assert found == [(100, 0, 1), (107, 7, 1), (149, 49, 1), (200, 3, 1)]
    kept = {r["doc_id"] for r in without_leaks(docs, benchmark).collect()}
    assert kept == set(range(21))


def test_items_without_own_tokens_give_one_row(spark):
    """Items made of the same sentences in another order: a text with one of them has one row."""
    from itertools import permutations

    parts = [" ".join(f"{c}{i}" for i in range(12)) for c in "abcd"]
    every = ["  ".join(p) for p in permutations(parts)]
    items = [(k, text) for k, text in enumerate(every)]
    docs = spark.createDataFrame([(1, f"x y {every[5]} z"), (2, f"only {parts[0]} and no more"), (3, None)], "doc_id bigint, text string")
    rows = leaked(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert [(r["doc_id"], r["item_id"]) for r in rows if r["doc_id"] == 1] == [(1, 5)]
    assert {r["doc_id"] for r in rows} <= {1, 2} and sum(r["doc_id"] == 1 for r in rows) == 1


def test_columns_with_inner_names_stay(spark):
    docs = spark.createDataFrame([(1, "plain words", "q", "r")], "doc_id bigint, text string, _leaked_id string, `_leaked_tag` string")
    benchmark = spark.createDataFrame([(1, "other things that nobody says at all")], "item_id bigint, text string")
    assert without_leaks(docs, benchmark).columns == docs.columns
    assert without_leaks(docs, benchmark).count() == 1


def test_windows_are_hashed_in_compiled_code(spark):
    """Hashes of windows are made with the rows of the places, not by interpreted lambdas; words are made once."""
    found = dc.some_windows(_docs(spark, ITEM), ["doc_id"], [6], 6)
    lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
    hashed = [line for line in lines if "xxhash64(" in line]
    assert hashed and all("*(" in line and "lambda" not in line for line in hashed)
    assert sum(line.count("translate(") for line in lines) == 1


def test_first_pass_has_the_windows_of_the_second(spark, monkeypatch):
    monkeypatch.setattr(dc, "CHUNK", 10)
    texts = [" ".join(f"pad{k}" for k in range(n)) + f". {ITEM} Then 7 km, 8 days" for n in range(0, 23)]
    docs = _docs(spark, *texts, "plain words only are in this text of some more than ten words", "one two", "", "5 kg", "Now Ann has 5\nkg and is gone")
    plain = {23, 24, 25}
    for sizes in ([6], [2, 4, 6], [3]):
        first = {tuple(r) for r in dc.some_windows(docs, ["doc_id"], sizes, 6).where("hash is not null").collect()}
        second = set()
        for size in sizes:
            for r in dc.windows(docs, ["doc_id"], size).collect():
                second |= {(r["doc_id"], r["plain"]), *([(r["doc_id"], r["hash"])] if size == 6 else [])}
        # Texts with numbers or names have windows over the edge between both kinds of tokens, too.
        assert second <= first and all(r in second for r in first if r[0] in plain)
