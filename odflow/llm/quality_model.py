"""Quality classifier: naive Bayes support vectors.

A text is the set of its hashed character n-grams. Indicators are scaled by the log ratio of how
often the two classes show the n-gram, and a linear hinge-loss model is fitted on them by dual
coordinate descent. The fit uses at most ``max_sample`` labelled rows (the ones with the smallest
hash of their id); scoring reads every whole text where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflow.llm.common import hashed_ngrams

ORDERS = (1, 2, 3)
BITS = 16
# Documented bound of the fit: labelled rows that are brought together, some 3 KB each.
MAX_SAMPLE = 12_000
EPOCHS = 8
COST = 1.0
# Of the sample, one row in this many sets the scale of the scores and is not fitted on.
CALIBRATE_ONE_IN = 5


@dataclass(frozen=True)
class QualityModel:
    """``ratio`` scales the indicators, ``weight`` and ``bias`` give the margin, ``slope`` and ``offset`` the score."""

    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    offset: float


def features(text: str, orders: tuple[int, ...] = ORDERS, bits: int = BITS) -> np.ndarray:
    """Buckets of the n-grams that a whole text has."""
    seen = np.zeros(1 << bits, dtype=bool)
    for buckets in hashed_ngrams(text, orders, bits):
        seen[buckets] = True
    return np.flatnonzero(seen).astype(np.int32)


def _scaled(buckets: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    values = ratio[buckets]
    return values / max(1e-9, float(np.sqrt(values @ values)))


def margin(buckets: np.ndarray, model: QualityModel) -> float:
    return float(model.weight[buckets] @ _scaled(buckets, model.ratio)) + model.bias


def score_text(text: str, model: QualityModel) -> float:
    z = model.slope * margin(features(text), model) + model.offset
    return float(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))


def _log_ratio(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    seen = np.ones((2, 1 << BITS))
    for buckets, label in zip(rows, good, strict=True):
        seen[int(label > 0), buckets] += 1
    seen /= seen.sum(axis=1, keepdims=True)
    return np.log(seen[1] / seen[0])


def _descend(rows: list[np.ndarray], values: list[np.ndarray], sign: np.ndarray) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss; the bias is the weight of a constant feature."""
    weight, bias, alpha = np.zeros(1 << BITS), 0.0, np.zeros(len(rows))
    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            slack = 1.0 - sign[i] * (float(weight[rows[i]] @ values[i]) + bias)
            # A scaled row has length one, and the constant feature adds one.
            step = min(max(alpha[i] + slack / 2.0, 0.0), COST) - alpha[i]
            if step:
                alpha[i] += step
                weight[rows[i]] += step * sign[i] * values[i]
                bias += step * sign[i]
    return weight, bias


def _calibrate(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Logistic slope and offset by Newton steps, with a prior that keeps separable rows finite."""
    slope, offset = 1.0, 0.0
    x = np.stack([margins, np.ones_like(margins)])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(slope * margins + offset, -500, 500)))
        gradient = x @ (good - p) - 0.01 * np.array([slope, offset])
        curve = (x * (p * (1 - p))) @ x.T + 0.01 * np.eye(2)
        change = np.linalg.solve(curve, gradient)
        slope, offset = slope + change[0], offset + change[1]
        if np.abs(change).max() < 1e-9:
            break
    return float(slope), float(offset)


def fit(rows: list[np.ndarray], good: np.ndarray) -> QualityModel:
    """Fit on rows of buckets and labels 0 or 1.

    Without rows every score is 0.5; with one class only it is the smoothed share of that class.
    """
    good = np.asarray(good, dtype=float)
    nothing = np.zeros(1 << BITS)
    if len(rows) == 0 or good.min() == good.max():
        share = (good.sum() + 1) / (len(good) + 2)
        return QualityModel(nothing, nothing, 0.0, 1.0, float(np.log(share / (1 - share))))
    apart = np.arange(len(rows)) % CALIBRATE_ONE_IN == 0
    if len(set(good[~apart])) < 2 or len(set(good[apart])) < 2:
        apart = np.zeros(len(rows), dtype=bool)
    kept = np.flatnonzero(~apart)
    ratio = _log_ratio([rows[i] for i in kept], good[kept])
    weight, bias = _descend([rows[i] for i in kept], [_scaled(rows[i], ratio) for i in kept], 2 * good[kept] - 1)
    model = QualityModel(ratio, weight, bias, 1.0, 0.0)
    scale = np.flatnonzero(apart) if apart.any() else kept
    slope, offset = _calibrate(np.array([margin(rows[i], model) for i in scale]), good[scale])
    return QualityModel(ratio, weight, bias, max(slope, 1e-6), offset)


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, max_sample: int = MAX_SAMPLE) -> QualityModel:
    """Learn from documents (doc_id, text) with labels (doc_id, quality) whose id satisfies ``may_learn``.

    Labels other than 0 and 1 and NULL ids teach nothing. The sample is bounded, so it is joined by
    broadcast and its features fit the driver.
    """
    sample = (labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").filter(may_learn)
              .select("doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_sample))
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "quality": batch["quality"],
                                "found": [features(text or "").tobytes() for text in batch["text"]]})

    found = (rows.mapInPandas(extract, "doc_id long, quality int, found binary")
             .orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "found").limit(max_sample).collect())
    return fit([np.frombuffer(row["found"], dtype=np.int32) for row in found],
               np.array([row["quality"] for row in found]))


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs`` with ``score`` (higher: label 1 likelier), of the same rows; NULL text counts as empty."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def rate(texts: pd.Series) -> pd.Series:
        model = held.value
        return pd.Series([score_text(text or "", model) for text in texts], dtype=float)

    return docs.withColumn("score", rate(F.col("text")))
