"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarline.llm.decontaminate import leaked
from bazaarline.llm.licenses import scan
from bazaarline.llm.line_dedup import kept_texts
from bazaarline.llm.merkle import manifest
from bazaarline.llm.mixing import taken_words
from bazaarline.llm.near_dedup import classes
from bazaarline.llm.prefix_bpe import encode
from bazaarline.llm.quality import judge_documents
from bazaarline.llm.shared import table
from bazaarline.llm.token_counts import token_counts
from bazaarline.llm.token_files import documents_of
from bazaarline.llm.url_rules import RULE_SCHEMA, judge_urls
from bazaarline.llm.vector_codes import CodeSpec, books_digest, compress, with_label_error
from bazaarline.llm.warc import round_trip

URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
LINE_MIN_DOCS = 10
REVISIT_BYTES = 100
COUNT_VOCABULARY, COUNT_LIMIT = "byte_bpe_50k.json", 512
FILE_VOCABULARY, END_ID = "word_bpe_49k.json", 2
CODES = CodeSpec(parts=8, entries=16, rounds=6, scale=4096)
TAMPERED_EVERY = 7
BYTE_VOCABULARY = "byte_bpe_50k.tiktoken"


def vocabulary(name: str) -> str:
    """Path of a vocabulary file, the same on every node."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, RULE_SCHEMA)
    return judge_urls(table(spark, sf_dir, "pages"), rules)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).rows.select("doc_id", "class_id", "class_rows")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = kept_texts(table(spark, sf_dir, "documents"), LINE_MIN_DOCS, keep_first=False)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("tag")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"), REVISIT_BYTES)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns come from the table of prefixes; its packed size stands for it."""
    counted = token_counts(table(spark, sf_dir, "documents"), vocabulary(COUNT_VOCABULARY), COUNT_LIMIT)
    return counted.withColumn("packed_prefix_bytes", F.octet_length("prefix_counts")).drop("prefix_counts")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = documents_of(table(spark, sf_dir, "documents"), vocabulary(FILE_VOCABULARY), END_ID)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    judged = judge_documents(docs, without=("text",))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = compress(table(spark, sf_dir, "embeddings"), CODES)
    return with_label_error(codes.rows).select(
        "vec_id",
        "code",
        F.col("error").cast("bigint").alias("error"),
        F.col("label_error").cast("bigint").alias("label_error"),
        F.lit(books_digest(codes.codebooks)).alias("codebooks_sha256"),
    )


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % TAMPERED_EVERY == 0
    return manifest(table(spark, sf_dir, "documents"), tampered).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


def op13_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = encode(table(spark, sf_dir, "documents"), vocabulary(BYTE_VOCABULARY), decoded=True)
    return read.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.octet_length("last_tokens").alias("packed_prefix_bytes"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_rules": op1_url_rules,
    "op2_near_dedup": op2_near_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_mixing": op4_mixing,
    "op5_decontamination": op5_decontamination,
    "op6_warc": op6_warc,
    "op7_token_counts": op7_token_counts,
    "op8_token_files": op8_token_files,
    "op9_quality_rules": op9_quality_rules,
    "op10_licenses": op10_licenses,
    "op11_vector_codes": op11_vector_codes,
    "op12_merkle": op12_merkle,
    "op13_prefix_bpe": op13_prefix_bpe,
}
