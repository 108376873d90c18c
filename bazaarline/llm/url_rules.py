"""URL filters by host-suffix and path-prefix expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarline.llm.shared import lower_ascii

# Hex digits of the digest that the join uses; the whole digest is compared afterwards.
SHORT = 8
RULE_SCHEMA = "rule_host string, rule_path string, rule_verdict string"
URL = "(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def url_path(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def _parts(value: Column, mark: str) -> Column:
    return F.split(value, mark)


def rule_table(rules: DataFrame) -> DataFrame:
    """One row per rule text with the expression it is looked up by.

    The expression is the host and the path up to its last slash, so that a URL only needs the
    prefixes that end at a slash; the rest of the rule's path is compared after the join. Rules
    without host or path are dropped; of equal rules with two verdicts ``block`` stays.
    """
    path = F.col("rule_path")
    folder = F.regexp_extract(path, "(?s)^(.*/)?", 0)
    return (
        rules.select(
            lower_ascii(F.col("rule_host")).alias("rule_host"), path.alias("rule_path"), "rule_verdict"
        )
        .where("rule_host is not null and rule_path is not null and rule_verdict is not null")
        .groupBy("rule_host", "rule_path")
        .agg(F.max_by("rule_verdict", F.col("rule_verdict") == "block").alias("rule_verdict"))
        .select(
            "*",
            F.concat("rule_host", "rule_path").alias("rule"),
            F.sha2(F.concat("rule_host", folder), 256).alias("rule_digest"),
            F.size(_parts(F.col("rule_host"), "\\.")).alias("labels"),
            (F.size(_parts(folder, "/")) - 1).alias("slashes"),
        )
        .withColumn("rule_short", F.substring("rule_digest", 1, SHORT))
    )


def judge_urls(pages: DataFrame, rules: DataFrame, otherwise: str = "allow") -> DataFrame:
    """Verdict of the longest rule that fits each page's URL.

    A rule ``(host, path)`` fits a URL whose host is the rule's or below it and whose path
    starts with the rule's. Each distinct (host, path) is expanded into its host suffixes times
    its path prefixes, no deeper than the deepest rule; the short digests of these expressions
    are joined with the rules' by equality, and the full digest and the rest of the path decide.
    The longest rule text wins, then the longer host, then ``block``, then the text order.

    ``pages`` needs ``page_id`` and ``url``; ``rules`` has ``RULE_SCHEMA``. The rules are small
    beside the pages and have no assumed size: the optimizer broadcasts them by their size or
    joins by the short digest, where adaptive execution splits a frequent expression.
    Result: ``page_id, host, path, rule, verdict``, a row for each row of ``pages``. A null URL
    or one without ``://`` has an empty host and path and is looked up like any other; without
    a fitting rule ``rule`` is null and the verdict is ``otherwise``. Null and repeated page
    ids keep their rows. Other columns of the inputs are ignored. No rules: every page gets
    ``otherwise``.
    """
    ruled = rule_table(rules)
    depth = ruled.agg(F.max("labels"), F.max("slashes")).first()
    labels, slashes = depth[0] or 0, depth[1] or 0

    judged = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    host_parts = _parts(F.col("host"), "\\.")
    # The last 1 to `labels` labels; the whole host is among them if it has no more.
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(host_parts), F.lit(max(labels, 1)))),
        lambda n: F.concat_ws(".", F.slice(host_parts, -n, n)),
    )
    folders = F.slice(_parts(F.col("path"), "/"), 1, slashes + 1)
    prefixes = F.transform(
        F.sequence(F.lit(0), F.least(F.size(_parts(F.col("path"), "/")) - 1, F.lit(slashes))),
        lambda n: F.when(n == 0, F.lit("")).otherwise(
            F.concat(F.concat_ws("/", F.slice(folders, 1, n)), F.lit("/"))
        ),
    )
    expressions = F.flatten(
        F.transform("suffixes", lambda s: F.transform("prefixes", lambda p: F.concat(s, p)))
    )
    found = (
        judged.select("host", "path")
        .distinct()
        .select("host", "path", suffixes.alias("suffixes"), prefixes.alias("prefixes"))
        .select("host", "path", F.explode(expressions).alias("expression"))
        .select("host", "path", F.sha2("expression", 256).alias("digest"))
        .withColumn("short", F.substring("digest", 1, SHORT))
        .join(ruled, F.col("short") == F.col("rule_short"))
        .where((F.col("digest") == F.col("rule_digest")) & F.startswith("path", "rule_path"))
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    F.length("rule").alias("length"),
                    F.length("rule_host").alias("host_length"),
                    (F.col("rule_verdict") == "block").alias("blocks"),
                    "rule",
                    "rule_verdict",
                )
            ).alias("best")
        )
    )
    return judged.join(found, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(otherwise)).alias("verdict"),
    )
