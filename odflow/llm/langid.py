"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language inside the tasks and adds the counts up in Spark; only the
table languages x buckets, whose size is fixed by parameters and checked, comes to the driver.
Scoring broadcasts the matrix of log probabilities and multiplies each text's sparse row of n-gram
counts with it in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflow.llm.common import hashed_ngrams, packed

ORDERS = (1, 2, 3)
BITS = 15
SMOOTHING = 0.5
# The matrix is broadcast: 512 languages x 32,768 buckets of 4 bytes are 64 MB. More is an error.
MAX_LANGUAGES = 512
UNKNOWN = "und"


@dataclass(frozen=True)
class LangModel:
    """``weights[lang]`` holds a log probability per bucket; ``prior`` that of the language."""

    langs: list[str]
    weights: np.ndarray
    prior: np.ndarray
    orders: tuple[int, ...] = ORDERS
    bits: int = BITS


def _counter(orders: tuple[int, ...], bits: int):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        documents: dict[str, int] = {}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"], strict=True):
                if lang not in totals:
                    totals[lang], documents[lang] = np.zeros(1 << bits, dtype=np.int64), 0
                documents[lang] += 1
                for buckets in hashed_ngrams(text.lower(), orders, bits):
                    totals[lang] += np.bincount(buckets, minlength=1 << bits)
        for lang, counts in totals.items():
            used = np.flatnonzero(counts)
            # Bucket -1 counts the documents.
            yield pd.DataFrame({"lang": lang, "bucket": np.append(used, -1),
                                "n": np.append(counts[used], documents[lang])})
    return count


def train(labelled: DataFrame, orders: tuple[int, ...] = ORDERS, bits: int = BITS) -> LangModel:
    """Learn from all rows (text, lang); rows with a NULL in either teach nothing."""
    rows = labelled.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    counts = (rows.mapInPandas(_counter(orders, bits), "lang string, bucket long, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
              .groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts")))
    learned = counts.limit(MAX_LANGUAGES + 1).collect()
    if len(learned) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the matrix would not fit its broadcast bound")
    learned.sort(key=lambda row: row["lang"])
    weights = np.full((len(learned), 1 << bits), SMOOTHING)
    documents = np.zeros(len(learned))
    for k, row in enumerate(learned):
        for bucket, n in row["counts"]:
            if bucket < 0:
                documents[k] = n
            else:
                weights[k, bucket] += n
    weights = np.log(weights / weights.sum(axis=1, keepdims=True)).astype(np.float32)
    prior = np.log(documents / max(1.0, documents.sum()))
    return LangModel([row["lang"] for row in learned], weights, prior, orders, bits)


def score_text(text: str, model: LangModel) -> tuple[str, float]:
    """The likeliest language and its posterior probability; equal ones go to the first in order."""
    total = model.prior.astype(np.float64).copy()
    for buckets in hashed_ngrams(text.lower(), model.orders, model.bits):
        if len(buckets) > 4096:
            counts = np.bincount(buckets, minlength=1 << model.bits)
            used = np.flatnonzero(counts)
            total += model.weights[:, used] @ counts[used].astype(np.float64)
        else:
            total += model.weights[:, buckets].sum(axis=1, dtype=np.float64)
    best = int(np.argmax(total))
    return model.langs[best], float(1.0 / np.exp(total - total[best]).sum())


def identify(docs: DataFrame, model: LangModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, of the same rows and in the same partitions.

    The text alone decides. NULL text, a text without a letter, and any text under a model that
    learned nothing get ``und`` with score 0. Columns of ``docs`` named like the two are replaced.
    """
    row = packed(docs, but=("lang_pred", "score"))
    return docs.select(row, _prediction(docs, model)).select("row.*", "found.lang_pred", "found.score")


def known(docs: DataFrame, model: LangModel, min_score: float) -> DataFrame:
    """The rows of ``docs`` whose language is not ``und`` and has a score of ``min_score`` or more."""
    found = docs.select(packed(docs), _prediction(docs, model))
    return found.filter((F.col("found.lang_pred") != UNKNOWN) & (F.col("found.score") >= min_score)).select("row.*")


def _prediction(docs: DataFrame, model: LangModel) -> Column:
    """The struct ``found`` (lang_pred, score) of a text."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred string, score double>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        model = held.value
        found = [(UNKNOWN, 0.0) if text is None else score_text(text, model) for text in texts]
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    if not model.langs:
        return F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")).alias("found")
    # Texts without a letter reach the function as NULL.
    return predict(F.when(F.col("text").rlike(r"\p{L}"), F.col("text"))).alias("found")
