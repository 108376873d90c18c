"""Operators that SQL can express, on odd rows and on samples, beside their SQL."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from bazaarline.llm import line_dedup, quality, url_rules, warc
from bazaarline.llm.oracles import ORACLES
from bazaarline.llm.queries import LINE_MIN_DOCS, QUERIES, URL_RULES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sample_beside_sql(spark, sample, answers, result, name):
    tables = {t: sample(t).toArrow() for t in ("documents", "pages", "embeddings")}
    assert result(QUERIES[name](spark, SF)) == answers(ORACLES[name], **tables)


def test_odd_quality(odd_docs, answers, result):
    plain = odd_docs.select("doc_id", "text", "source")
    got = quality.judge_documents(plain, without=("text",)).drop("source")
    assert result(got) == answers(ORACLES["op9_quality_rules"], documents=plain.toArrow())
    whole = quality.judge_documents(odd_docs)
    assert whole.count() == odd_docs.count()
    assert "kept" in whole.columns and len(set(whole.columns)) == len(whole.columns)
    assert quality.judge_documents(odd_docs.limit(0)).count() == 0


def test_quality_plan_has_no_python(spark):
    plan = QUERIES["op9_quality_rules"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_host_rates_are_shrunk(spark):
    rows = [("bad", f, 0) for f in [True] * 90 + [False] * 10] + [("tiny", True, 0)]
    rows += [(f"good{h}", k < 5, 0) for h in range(30) for k in range(100)]
    scored = spark.createDataFrame(rows, "source string, base_failed boolean, x int")
    told = dict(quality.host_verdicts(scored, "source", quality.QualityRules(max_host_rate=0.5)).collect())
    # One failing document says little about its host; ninety of a hundred do.
    assert told.pop("bad") and not any(told.values())


def _hosts(spark, failing: dict):
    rows = [(host, k < bad) for host, (bad, n) in failing.items() for k in range(n)]
    return dict(quality.host_verdicts(spark.createDataFrame(rows, "source string, base_failed boolean"), "source", quality.QualityRules()).collect())


def test_the_limit_of_the_query_rejects_hosts_just_over_it(spark):
    good = {f"good{h}": (h % 4, 200) for h in range(40)}
    told = _hosts(spark, good | {"over": (190, 200), "under": (178, 200), "tiny": (1, 1)})
    assert [host for host, rejected in told.items() if rejected] == ["over"]


def test_rates_of_single_documents_say_nothing_about_hosts(spark):
    assert not any(_hosts(spark, {f"h{h}": (h % 2, 1) for h in range(100)}).values())
    # Rates that differ no more than by chance: every host has the mean.
    assert not any(_hosts(spark, {f"h{h}": (1 + h % 2, 2) for h in range(100)}).values())
    assert all(_hosts(spark, {f"h{h}": (5, 5) for h in range(3)}).values())


def test_a_rejected_host_takes_its_documents_along(spark):
    fine = " ".join(f"word{k}" for k in range(60))
    rows = [(n, "junk", fine if n % 50 == 0 else "short") for n in range(200)] + [(1000 + n, f"s{n % 9}", fine) for n in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    judged = quality.judge_documents(docs).collect()
    assert {r["doc_id"] for r in judged if not r["base_failed"] and not r["kept"]} == {0, 50, 100, 150}
    assert all(r["kept"] for r in judged if r["source"] != "junk")


def test_quality_with_clashing_names(odd_docs):
    names = ["_host", "_rejected", "a.b", "_words", "__lines", "Kept", "n`x"]
    clashing = odd_docs.selectExpr("doc_id", "text", "source", *[f"{k} as `{n.replace('`', '``')}`" for k, n in enumerate(names)])
    judged = quality.judge_documents(clashing)
    assert judged.count() == odd_docs.count()
    first = judged.first()
    assert [first[n] for n in names if n != "Kept"] == [0, 1, 2, 3, 4, 6]


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("partitions", ["1", "7"])
def test_lines_beside_brute_force(spark, settings, odd_docs, keep_first, partitions):
    settings(spark__sql__shuffle__partitions=partitions, spark__sql__adaptive__enabled="false")
    rng = random.Random(3)
    rows = [(k, "\n".join(rng.choice(["Hot ", "\thot", "warm", "cold", f"own {k}", "", " "]) for _ in range(rng.randrange(9))))
            for k in range(60)]
    rows += [(5, "hot\nother text of the same id"), (None, "warm\nhot"), (None, None), (61, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("hash", F.lit("?")).repartition(5)
    seen: dict[bytes, set] = {}
    for doc_id, text in rows:
        for key in line_dedup.line_keys(text or ""):
            seen.setdefault(key, set()).add(doc_id)
    often = {k for k, ids in seen.items() if k and len(ids) >= 12}
    assert 1 <= len(often) < len(seen)
    got = line_dedup.kept_texts(docs, 12, keep_first).collect()
    want = []
    first: set[bytes] = set()
    # The first line is that of the least document, null first, then the least position.
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    for k in order:
        doc_id, text = rows[k]
        lines = (text or "").split("\n")
        kept = []
        for line, key in zip(lines, line_dedup.line_keys(text or ""), strict=True):
            if key in often and not (keep_first and key not in first):
                continue
            first.add(key)
            kept.append(line)
        want.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    if keep_first:  # rows of one id tie, so their total is compared
        assert sum(r["n_dropped"] for r in got) == sum(w[2] for w in want)
        got, want = [r for r in got if r[0] not in (5, None)], [w for w in want if w[0] not in (5, None)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_odd_lines(odd_docs, answers, result):
    got = line_dedup.kept_texts(odd_docs, LINE_MIN_DOCS, keep_first=False)
    got = got.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
    plain = odd_docs.select("doc_id", "text").toArrow()
    assert result(got) == answers(ORACLES["op3_line_dedup"], documents=plain)
    assert line_dedup.kept_texts(odd_docs.limit(0)).count() == 0


def test_bitmaps_cover_whole_bytes():
    for n in (1, 7, 8, 9):
        bits = line_dedup.keep_bits(None, n)
        assert bits.all() and len(bits) == n


def _fits(host: str, path: str, rule: tuple) -> bool:
    return (host == rule[0] or host.endswith("." + rule[0])) and path.startswith(rule[1])


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_urls_beside_brute_force(spark, settings, threshold):
    settings(spark__sql__autoBroadcastJoinThreshold=threshold)
    rng = random.Random(5)
    labels, parts = ["net", "example", "org", "a", "B", ""], ["/en/", "/", "/e", "en", "//", "/en/x"]
    urls = [None, "", "no mark", "http://", "://", "http://NET", "http://net/", "x://a.net:80/en", "http://u@net/en/?q=://z#f"]
    urls += [
        f"{rng.choice(['http', ''])}://{'.'.join(rng.choice(labels) for _ in range(rng.randrange(1, 4)))}"
        f"{''.join(rng.choice(parts) for _ in range(rng.randrange(4)))}{rng.choice(['', '?a=/en/', '#x'])}"
        for _ in range(300)
    ]
    rules = [*URL_RULES, ("example.net", "/e", "block"), ("b.net", "/en/x", "allow"), ("net", "/", "allow"), (None, "/", "block"), ("org", "", "block")]
    pages = spark.createDataFrame([(k if k % 7 else None, u) for k, u in enumerate(urls)], "page_id bigint, url string")
    pages = pages.withColumn("host", F.lit("?")).withColumn("rule", F.lit("?"))
    got = url_rules.judge_urls(pages, spark.createDataFrame(rules, url_rules.RULE_SCHEMA), "allow").collect()
    want = []
    for k, u in enumerate(urls):
        rest = u.partition("://")[2] if u and "://" in u else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:cut].lower(), rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        found = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if h is not None and _fits(host, path, (h, p))]
        best = max(found, default=None)
        want.append((k if k % 7 else None, host, path, best[3] if best else None, best[4] if best else "allow"))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert any(w[4] == "block" for w in want) and any(w[3] and w[4] == "allow" for w in want)


def test_no_rules_and_no_pages(spark, sample):
    none = spark.createDataFrame([], url_rules.RULE_SCHEMA)
    pages = sample("pages")
    assert {r["verdict"] for r in url_rules.judge_urls(pages, none, "block").collect()} == {"block"}
    assert url_rules.judge_urls(pages.limit(0), none).count() == 0


def test_odd_pages(spark, answers, result):
    text = "x" * 100
    rows = [(5, "http://a", text), (3, None, text), (3, "b", text), (None, "c\r\nd", text), (None, "e", "y" * 200), (None, None, None),
            (7, "f", "é" * 50), (8, "g", "é" * 50), (9, "h", "short"), (10, "i", "short"), (11, "j", "WARC/1.1\r\n\r\nHTTP/1.1\r\n\r\n" * 9)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit("?"))
    assert result(warc.round_trip(pages, 100)) == answers(ORACLES["op6_warc"], pages=pages.toArrow())
    assert warc.round_trip(pages.limit(0), 100).count() == 0


def test_archives_of_any_members_are_split():
    import gzip
    import io

    records = [warc.record_bytes(f"urn:page:{k}", "u", b"\r\n\r\n" * k + b"z" * 100_000 * k, "00", None) for k in range(9)]
    whole = gzip.compress(b"".join(records))
    apart = b"".join(map(gzip.compress, records))
    for packed in (whole, apart, gzip.compress(b"".join(records[:4])) + gzip.compress(b"".join(records[4:]))):
        assert [data for _, data in warc.split_records(warc.inflated(io.BytesIO(packed)))] == records
    with pytest.raises(ValueError):
        list(warc.split_records(warc.inflated(io.BytesIO(gzip.compress(records[3][:-5])))))
    # Zero bytes between members and at the end are padding; a cut anywhere is an error.
    padded = gzip.compress(records[0]) + bytes(700) + gzip.compress(records[1]) + bytes(1 << 21)
    assert [data for _, data in warc.split_records(warc.inflated(io.BytesIO(padded)))] == records[:2]
    assert list(warc.inflated(io.BytesIO(b""))) == []
    for cut in (1, 4, 8, 9, 100):
        with pytest.raises(ValueError):
            list(warc.split_records(warc.inflated(io.BytesIO(whole[:-cut]))))
