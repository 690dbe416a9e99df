"""A corpus pipeline: five stages over ``documents``, each a training-data operator whose decisions take effect.

Columns that ``docs`` has besides those of documents are dropped at once, whatever they are named.  Each stage is a function (spark, docs, sf_dir) -> DataFrame; `run` writes each result as Parquet to the
shared folder and rereads it as the next stage's docs.  All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curblake.llm import op3_bpe, op4_language, op6_mixing, op8_near_dedup, op9_pii
from curblake.llm.common import spool

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the language found into lang; documents in which none is found (no letter, or a null text) go.

    lang may be null before; rows with a null lang are no training rows.  An empty table stays empty, and with no
    lang at all nothing is learned, so no document stays.  Repeated rows and null ids are judged by their texts.
    """
    docs = docs.select(*COLUMNS)
    found = op4_language.predict(docs, op4_language.train(op4_language.training_rows(docs)))
    return found.where(F.col("lang_pred") != op4_language.UND).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies: the one with the smallest doc_id, null ids last.

    Rows with one id and different texts are judged each by its text; repeated rows are copies, of which the
    smallest in all columns stays.  Texts without a word (null, empty) have no copies and all stay.
    """
    return op8_near_dedup.one_of_each(docs.select(*COLUMNS))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the kind in brackets in place of each span of personal data, and counts the characters anew.

    Null and empty texts stay as they are; repeated rows, and rows of one id, are each changed by their text.
    """
    return op9_pii.redact(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source's documents to its target, some more than once, in training order.

    A null source is a source of its own.  Null and empty texts have no words and take part while their source's
    target isn't reached.  Repeated rows and null ids are documents like any other; ties of position go by doc_id.
    """
    return op6_mixing.in_order(docs.select(*COLUMNS))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text, by row; a null text counts as empty."""
    return op3_bpe.digests(docs.select(*COLUMNS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("mixing", mixing),
    ("bpe", bpe),
]

#: SQL can express neither the language model nor the tokenizer; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = spool(stage(spark, docs, sf_dir), name)
    return docs
