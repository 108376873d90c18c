"""Documents made into token files: each stage works on all that the one before kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarline.llm.decontaminate import without_leaks
from bazaarline.llm.mixing import mixed_texts
from bazaarline.llm.near_dedup import one_of_each
from bazaarline.llm.quality import judge_documents
from bazaarline.llm.queries import END_ID, FILE_VOCABULARY, vocabulary
from bazaarline.llm.shared import step, stored, table
from bazaarline.llm.token_files import documents_of

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules on their text and the verdict on their source keep.

    Null and empty texts have no words and go; a null source has no verdict. Repeated rows stay
    or go together, null ids stay ids; no documents give none. Other columns stay as they are,
    but for those with the names of the measures, which then hold the measures.
    """
    judged = judge_documents(docs).where("kept")
    return judged.select(*["`" + name.replace("`", "``") + "`" for name in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that with the least id.

    Equal texts are one class, null and empty ones too; of repeated rows one stays. No documents
    give none.
    """
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in whose text no benchmark item was found.

    Nothing is found in null and empty texts, so they stay, as do all documents beside an empty
    benchmark. Repeated rows stay or go together.
    """
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a row per document and turn.

    A null source is a source, the last. Texts without words give nothing; ties in the order
    of a source's words are resolved by id and text. No documents give none.
    """
    return mixed_texts(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mix, written to files and read back: place, number and checksum.

    A row for each row of the mix, in the order of the ids; rows of one id follow each other. A
    null or empty text has the end id only; no documents give no rows.
    """
    read = documents_of(docs, vocabulary(FILE_VOCABULARY), END_ID)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def _in_turn(stage: Stage) -> Stage:
    """The stage as one of a row, each of whose results is written before the next begins: the
    working tables of the stage before are deleted."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with step(spark, "stages"):
            return stage(spark, docs, sf_dir)

    return run_stage


PARTS: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token-ID / binary output", token_files),
]
STAGES: list[tuple[str, Stage]] = [(name, _in_turn(stage)) for name, stage in PARTS]

# Consistent samples, pseudorandom permutations and a tokenizer are not SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage keeps is stored before the next begins.

    An empty table passes through all stages and gives no rows.
    """
    docs, turn = table(spark, sf_dir, "documents"), uuid.uuid4().hex
    for name, stage in PARTS:
        with step(spark, turn):
            result = stage(spark, docs, sf_dir)
        # The last result still reads its tables; nothing is deleted after it.
        docs = result if stage is token_files else stored(result, name.split(" ")[0].lower())
    return docs
