"""Quality rules with verdicts on whole hosts, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarline.llm.shared import SPACE, let, stored, text_or_empty

SYMBOLS = "#*$%&|<>"
WINDOW = 3


@dataclass(frozen=True)
class QualityRules:
    """Limits of a document, and of a host's share of failing documents after shrinkage: a host
    goes only if nearly all it has is junk, so clean documents of a mixed host stay."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_host_rate: float = 0.9


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def repeat_words(words: Column) -> Column:
    """Words inside a three-word window that the text has at least twice, the first included.

    Windows are compared by a 64-bit hash. Sorting puts equal windows side by side; a text
    without any skips the sort.
    """

    def grams(w: Column) -> Column:
        return F.transform(
            F.slice(w, 1, F.greatest(F.size(w) - (WINDOW - 1), F.lit(0))),
            lambda first, i: F.xxhash64(first, F.get(w, i + 1), F.get(w, i + 2)),
        )

    def same(ordered: Column, x: Column, k: Column) -> Column:
        return (x["h"] == F.get(ordered, k - 1)["h"]) | (x["h"] == F.get(ordered, k + 1)["h"])

    def covered(g: Column) -> Column:
        at = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        found = let(at, lambda ordered: F.filter(ordered, lambda x, k: same(ordered, x, k)))
        spread = F.flatten(F.transform(found, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
        return F.size(F.array_distinct(spread))

    return let(
        let(words, grams),
        lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(covered(g)),
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _mark(names: list[str]) -> str:
    """A beginning that no name has."""
    mark = "_"
    while any(name.startswith(mark) for name in names):
        mark += "_"
    return mark


def with_features(docs: DataFrame, text: str, rules: QualityRules) -> DataFrame:
    """The measures of every text beside the columns of ``docs``."""
    t = text_or_empty(_quoted(text))
    lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    mark = _mark(docs.columns)
    w, by_line = F.col(f"{mark}words"), F.col(f"{mark}lines")
    return (
        docs.withColumn(f"{mark}words", words_of(t))
        .withColumn(f"{mark}lines", lines)
        .select(
            *map(_quoted, docs.columns),
            F.size(w).cast("long").alias("n_words"),
            F.length(F.regexp_replace(t, f"[{SPACE}]+", "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(t, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
            (F.size(by_line) - F.size(F.array_distinct(by_line))).cast("long").alias("n_dup_lines"),
            repeat_words(w).cast("long").alias("n_repeat_words"),
        )
        .withColumn(
            "base_failed",
            (F.col("n_words") < rules.min_words)
            | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")),
        )
    )


def host_verdicts(scored: DataFrame, host: str, rules: QualityRules) -> DataFrame:
    """Hosts and whether their shrunk rate of failing documents is over the limit.

    Failures of a host are beta-binomial: the prior's mean is that of all documents, and its
    weight follows from how much more the hosts' rates differ than rates of so many documents
    differ by chance. Where they do not, or where no host has two documents, every host has the
    mean.
    """
    hosts = (
        scored.where(F.col(_quoted(host)).isNotNull())
        .groupBy(F.col(_quoted(host)).alias("host"))
        .agg(F.count("*").alias("n"), F.count_if("base_failed").alias("failed"))
    )
    hosts = stored(hosts, "hosts")
    n, failed = F.col("n").cast("double"), F.col("failed").cast("double")
    totals = hosts.agg(
        F.count("*").alias("hosts"),
        F.sum(n).alias("n"),
        F.sum(n * n).alias("n_squares"),
        F.sum(failed).alias("failed"),
        F.sum(failed * failed / n).alias("squares"),
    ).first()
    if not totals["n"]:
        return hosts.select("host", F.lit(False).alias("rejected"))
    mean = totals["failed"] / totals["n"]
    by_chance = totals["hosts"] - 1
    spread = totals["n"] - totals["n_squares"] / totals["n"] - by_chance
    share = 0.0  # of the variance of one document's outcome that lies between hosts
    if 0 < mean < 1 and spread > 1e-9:
        between = (totals["squares"] - totals["n"] * mean * mean) / (mean * (1 - mean))
        share = min(max((between - by_chance) / spread, 0.0), 1.0)
    if share < 1e-9:
        shrunk = F.lit(mean)
    else:
        weight = 1 / share - 1
        shrunk = (failed + mean * weight) / (n + weight)
    return hosts.select("host", (shrunk > rules.max_host_rate).alias("rejected"))


def judge_documents(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    rules: QualityRules = QualityRules(),
    without: tuple[str, ...] = (),
) -> DataFrame:
    """The columns of ``docs`` with measures of the text, ``base_failed`` and ``kept``.

    A document fails by itself with too few words or too many in repeated three-word windows.
    Failures are counted by host, the rates are shrunk towards a beta prior fitted to all
    hosts, and documents of a host over the limit go with it. A row for each row of ``docs``:
    repeated rows and null ids stay rows. Null and empty texts have no words and fail. A null
    host has no verdict of its own. An empty table gives an empty table. The new columns
    (``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``)
    replace columns of the same name; all other columns stay, whatever their names. Columns named in ``without`` are left out.

    The measures are computed in one pass and stored, so the counts by host and the join back
    read a table; verdicts are one row per host.
    """
    new = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"}
    # Names are compared as Spark does, without regard to case.
    wanted = [c for c in docs.columns if c.lower() not in new or c in (text, host)]
    scored = stored(with_features(docs.select(*map(_quoted, wanted)), text, rules).drop(*without), "quality")
    verdicts = stored(host_verdicts(scored, host, rules), "host-verdicts")
    mark = _mark(scored.columns)
    judged = scored.join(
        verdicts.select(F.col("host").alias(f"{mark}host"), F.col("rejected").alias(f"{mark}rejected")),
        F.col(_quoted(host)) == F.col(f"{mark}host"),
        "left",
    )
    kept = ~F.col("base_failed") & ~F.coalesce(f"{mark}rejected", F.lit(False))
    return judged.withColumn("kept", kept).drop(f"{mark}host", f"{mark}rejected")
