"""Quality classifier: naive Bayes support vectors (log-count ratios, then a hinge-loss model).

The features are n-gram indicators (word uni- and bigrams, uni- to trigrams of token shapes such
as upper-case word or punctuation run) hashed into ``2**BITS`` slots. With p and q the smoothed
counts of a slot among good and bad training rows, ``r = log((p/|p|) / (q/|q|))`` scales the
indicators, and a linear model with hinge loss is fitted on the scaled, length-normalised rows by
dual coordinate descent. Margins become scores by a logistic curve fitted on training rows the
model has not seen (Platt).

The model is fitted on a bounded sample: at most ``MAX_TRAIN_ROWS`` labelled ids outside the
held-out fold, in hash order. Scoring reads every row and its whole text; the weights are the
only broadcast (2**BITS floats).

Defined results: null and empty texts score as a text without features; null ids are in the
held-out fold; labels that are null are ignored; with no labelled rows, or with one class only,
every score is 1 (nothing is known to be bad) or the smoothed share of good rows; empty tables
give empty results; extra columns pass through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgsift.llm._features import collected, fold, labelled_sample, ngram_indicators

BITS = 20
MAX_TRAIN_ROWS = 8_000
THRESHOLD = 0.3


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, size: int, alpha: float = 1.0) -> np.ndarray:
    p, q = np.full(size, alpha), np.full(size, alpha)
    for x, good in zip(rows, y, strict=True):
        (p if good else q)[x] += 1
    return np.log((p / p.sum()) / (q / q.sum()))


def dual_coordinate_descent(rows: list[np.ndarray], values, y: np.ndarray, size: int, c: np.ndarray,
                            epochs: int = 20, seed: int = 0, tol: float = 1e-3) -> tuple[np.ndarray, float]:
    """L1-loss linear SVM: min |w|^2/2 + sum c_i max(0, 1 - y_i (w x_i + b)); b as a constant feature.

    ``rows`` are the slots of each row and ``values(i)`` the row's entries there.
    """
    w, b = np.zeros(size), 0.0
    a = np.zeros(len(rows))
    norm = np.array([values(i) @ values(i) + 1.0 for i in range(len(rows))])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            x, v = rows[i], values(i)
            g = y[i] * (w[x] @ v + b) - 1.0
            step = min(max(a[i] - g / norm[i], 0.0), c[i]) - a[i]
            if step:
                a[i] += step
                w[x] += step * y[i] * v
                b += step * y[i]
                worst = max(worst, abs(step) * norm[i] ** 0.5)
        if worst < tol:
            break
    return w, b


def platt(margins: np.ndarray, y: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Logistic curve score = 1 / (1 + exp(-(a m + b))) by Newton steps with smoothed targets."""
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    x = np.stack([margins, np.ones(len(margins))])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -35, 35)))
        grad = x @ (p - target) + 1e-6 * np.array([a, b])
        hess = (x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        size = np.abs(step).max()
        a, b = a - step[0] / max(1, size), b - step[1] / max(1, size)
        if size < 1e-8:
            break
    return float(a), float(b)


class QualityModel:
    """weights over the slots (float32), bias and the calibration (a, b)."""

    def __init__(self, weights: np.ndarray, bias: float, a: float, b: float, bits: int = BITS):
        self.weights, self.bias, self.a, self.b, self.bits = weights.astype(np.float32), bias, a, b, bits

    def margin(self, x: np.ndarray) -> float:
        return float(self.weights[x].sum(dtype=np.float64) / np.sqrt(max(len(x), 1)) + self.bias)

    def score(self, text: str | None) -> float:
        z = self.a * self.margin(ngram_indicators(text, self.bits)) + self.b
        return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def train(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, c: float = 1.0, seed: int = 0) -> QualityModel:
    """Fit on four fifths of the rows, calibrate on the rest."""
    size = 1 << bits
    labels = np.asarray(labels, int)
    if len(labels) == 0 or labels.min() == labels.max():
        share = (labels.sum() + 1) / (len(labels) + 2) if len(labels) else 1.0
        z = float(np.log(share / (1 - share))) if 0 < share < 1 else 35.0
        return QualityModel(np.zeros(size), 0.0, 0.0, z, bits)
    order = np.random.default_rng(seed).permutation(len(rows))
    held = order[: len(rows) // 5]
    if len(rows) < 50 or labels[held].min() == labels[held].max():
        held, used = order, order
    else:
        used = order[len(rows) // 5:]
    r = log_count_ratios([rows[i] for i in used], labels[used], size)
    fitted = [rows[i] for i in used]
    y = np.where(labels[used] > 0, 1.0, -1.0)
    # Classes weigh the same in total.
    weight = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))
    w, bias = dual_coordinate_descent(fitted, lambda i: r[fitted[i]] / np.sqrt(max(len(fitted[i]), 1)), y, size, c * weight, seed=seed)
    model = QualityModel(w * r, bias, 1.0, 0.0, bits)
    model.a, model.b = platt(np.array([model.margin(rows[i]) for i in held]), labels[held])
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_TRAIN_ROWS,
        id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> QualityModel:
    """Fit from the bounded labelled sample; only its hashed features reach the driver."""
    sample = labelled_sample(docs, labels, label, max_rows, id_col, text_col)
    rows = collected(sample, lambda t: (ngram_indicators(t, bits).astype("<i4").tobytes(), b""))
    return train([np.frombuffer(x, "<i4") for _, x, _ in rows], np.array([y for y, _, _ in rows], int), bits)


def score_udf(model: QualityModel, spark):
    shared = spark.sparkContext.broadcast((model.weights, model.bias, model.a, model.b, model.bits))

    def scores(texts: pd.Series) -> pd.Series:
        m = QualityModel(*shared.value)
        return pd.Series([m.score(t) for t in texts], dtype="float64")

    return F.pandas_udf(scores, "double")


def scored(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    out = docs.select(F.col(id_col).alias("doc_id"), (fold(F.col(id_col)) == 0).alias("held_out"),
                      score_udf(model, docs.sparkSession)(F.col(text_col)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, score: Column, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score reaches the threshold; same columns."""
    return docs.where(score >= threshold)
