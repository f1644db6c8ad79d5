"""A corpus pipeline: known languages, no near duplicates, no secrets, mixed sources, tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from odflow.llm import langid, mixing, neardup, secrets, sentencepiece
from odflow.llm.common import placed, shared_folder, table

# A language is rejected below this posterior probability.
MIN_LANGUAGE_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model learned, from the documents' own labels, and is sure of.

    Texts without a letter, NULL ones included, are rejected.
    """
    return langid.known(docs, langid.train(docs), MIN_LANGUAGE_SCORE)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of texts that share 80 % of their word shingles."""
    return neardup.deduplicate(docs, percent=80)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced."""
    return secrets.redact(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in an order that interleaves the sources by the square root of their sizes.

    The order is that of the files written, and the last stage makes it a column.
    """
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the ids of their texts, their number, whether they decode to the text, and ``position`` in the mixture."""
    model = sentencepiece.PieceModel.from_file(sentencepiece.MODEL_PATH)
    return sentencepiece.encode(placed(docs, "position"), model)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("near_dedup", without_near_duplicates),
    ("secret_scan", without_secrets),
    ("mixing", mixed_sources),
    ("sentencepiece", tokens),
]

# Language ID and SentencePiece are no SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
