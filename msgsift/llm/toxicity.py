"""Toxicity severity by cumulative-link ordinal regression on sparse word features.

``labels.toxic`` marks rows as toxic or not; severity grades come from the training rows
themselves: words that are much more frequent in toxic rows (signed G-squared over document
counts) are the marker words, and a toxic row's grade grows with how often they occur in it
(grade 1 up to the lower tercile of toxic rows, 2 up to the upper, 3 above; not toxic is 0).

The model is ``P(grade <= k) = sigmoid(theta_k - w . x)``: one weight vector is shared by all
ordered thresholds theta_0 < theta_1 < theta_2, x is log(1 + count) of the selected hashed
words. It is fitted by accelerated proximal steps on the penalised likelihood; thresholds are
kept ordered by their parametrisation. A row's severity is the expected grade, the sum of
``P(grade > k)``.

The fit uses a bounded sample (``MAX_TRAIN_ROWS`` labelled ids in hash order, outside the
held-out fold); the ``FEATURES`` strongest slots are the model and the only broadcast. Scoring
reads every row and its whole text.

Defined results: null and empty texts have no features and the severity of the thresholds
alone; rows without a label are scored like all others; null labels are ignored; without toxic
training rows every severity is 0; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgsift.llm._features import collected, fold, labelled_sample, word_counts

BITS = 22
MAX_TRAIN_ROWS = 20_000
FEATURES = 2_000
MIN_ROWS = 5
GRADES = 4
#: A row is called toxic from this P(grade > 0) on.
TOXIC_AT = 0.2


def association(df_pos: np.ndarray, df_neg: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    """Signed G-squared of each slot's document counts against the classes."""
    a, b = df_pos.astype(float), df_neg.astype(float)
    n = n_pos + n_neg
    total = a + b

    def part(o, e):
        return np.where(o > 0, o * np.log(np.maximum(o, 1e-12) / np.maximum(e, 1e-12)), 0.0)

    g = part(a, total * n_pos / n) + part(b, total * n_neg / n)
    g += part(n_pos - a, (n - total) * n_pos / n) + part(n_neg - b, (n - total) * n_neg / n)
    return np.sign(a / max(n_pos, 1) - b / max(n_neg, 1)) * 2 * g


def grade_rows(marker_counts: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grades 0..3 and the two cuts between the toxic grades."""
    hits = marker_counts[toxic > 0]
    cuts = np.quantile(hits, [1 / 3, 2 / 3]) if len(hits) else np.array([1.0, 2.0])
    return np.where(toxic > 0, 1 + (marker_counts > cuts[0]) + (marker_counts > cuts[1]), 0), cuts


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_ordinal(indptr: np.ndarray, cols: np.ndarray, vals: np.ndarray, grades: np.ndarray, size: int,
                weight: np.ndarray, l2: float = 0.3, rounds: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """(w, theta): penalised cumulative-link fit on a CSR matrix by Adam on the full likelihood.

    theta_0 is free and theta_k = theta_{k-1} + exp(d_k), so the thresholds stay ordered.
    """
    n, k = len(grades), GRADES - 1
    row = np.repeat(np.arange(n), np.diff(indptr))
    share = np.array([(grades <= j).mean() for j in range(k)]).clip(1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    p = np.concatenate([np.zeros(size), [start[0]], np.log(np.maximum(np.diff(start), 1e-2))])
    m1, m2 = np.zeros(len(p)), np.zeros(len(p))
    low, high = grades - 1, grades
    for t in range(1, rounds + 1):
        theta = p[size] + np.concatenate([[0.0], np.cumsum(np.exp(p[size + 1:]))])
        eta = np.bincount(row, vals * p[cols], minlength=n)
        up = np.where(high < k, _sigmoid(theta[np.minimum(high, k - 1)] - eta), 1.0)
        down = np.where(low >= 0, _sigmoid(theta[np.maximum(low, 0)] - eta), 0.0)
        prob = np.maximum(up - down, 1e-9)
        du, dd = up * (1 - up), down * (1 - down)
        g_eta = weight * (du - dd) / prob
        g_theta = np.zeros(k)
        np.add.at(g_theta, high[high < k], (-weight * du / prob)[high < k])
        np.add.at(g_theta, low[low >= 0], (weight * dd / prob)[low >= 0])
        g = np.empty(len(p))
        g[:size] = np.bincount(cols, vals * g_eta[row], minlength=size) + l2 * p[:size]
        g[size] = g_theta.sum()
        for j in range(1, k):
            g[size + j] = g_theta[j:].sum() * np.exp(p[size + j])
        m1 = 0.9 * m1 + 0.1 * g
        m2 = 0.999 * m2 + 0.001 * g * g
        rate = 0.1 * min(1.0, 3 * (1 - t / (rounds + 1)))
        p = p - rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
    return p[:size], p[size] + np.concatenate([[0.0], np.cumsum(np.exp(p[size + 1:]))])


class ToxicityModel:
    """Sorted slots with one weight each, the ordered thresholds, and the number of hash bits."""

    def __init__(self, slots: np.ndarray, weights: np.ndarray, theta: np.ndarray, bits: int = BITS):
        self.slots, self.weights, self.theta, self.bits = slots, weights, theta, bits

    def exceed(self, text: str | None) -> np.ndarray:
        """P(grade > k) for k = 0, 1, 2."""
        slots, counts = word_counts(text, self.bits)
        eta = 0.0
        if len(self.slots) and len(slots):
            at = np.minimum(np.searchsorted(self.slots, slots), len(self.slots) - 1)
            hit = self.slots[at] == slots
            eta = float(self.weights[at[hit]] @ np.log1p(counts[hit]))
        return 1 - _sigmoid(self.theta - eta)


def train(rows: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, bits: int = BITS) -> ToxicityModel:
    toxic = np.asarray(toxic, int)
    n_pos, n_neg = int(toxic.sum()), int(len(toxic) - toxic.sum())
    if not n_pos:
        return ToxicityModel(np.empty(0, np.int64), np.empty(0), np.full(GRADES - 1, 35.0), bits)
    slots = np.unique(np.concatenate([x for x, _ in rows])) if rows else np.empty(0, np.int64)
    pos, neg = np.zeros(len(slots)), np.zeros(len(slots))
    for (x, _), y in zip(rows, toxic, strict=True):
        (pos if y else neg)[np.searchsorted(slots, x)] += 1
    strength = np.where(pos + neg >= MIN_ROWS, association(pos, neg, n_pos, n_neg), 0.0)
    chosen = np.sort(np.argsort(-np.abs(strength), kind="stable")[:FEATURES])
    chosen = chosen[strength[chosen] != 0]
    # 1 in 10,000 by chance, and at least twice as common among toxic rows.
    markers = set(slots[(strength > 15.1) & (pos * n_neg > 2 * neg * n_pos)].tolist())
    hits = np.array([sum(int(c) for s, c in zip(x.tolist(), k, strict=True) if s in markers) for x, k in rows])
    grades, _ = grade_rows(hits, toxic)
    slots = slots[chosen]
    indptr, cols, vals = [0], [], []
    for x, k in rows:
        at = np.minimum(np.searchsorted(slots, x), max(len(slots) - 1, 0))
        keep = slots[at] == x if len(slots) else np.zeros(len(x), bool)
        cols.append(at[keep])
        vals.append(np.log1p(k[keep]))
        indptr.append(indptr[-1] + int(keep.sum()))
    w, theta = fit_ordinal(np.array(indptr), np.concatenate(cols), np.concatenate(vals), grades, len(slots),
                           np.ones(len(rows)))
    return ToxicityModel(slots, w, theta, bits)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_TRAIN_ROWS,
        id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> ToxicityModel:
    """Fit from the bounded labelled sample; only its hashed word counts reach the driver."""
    sample = labelled_sample(docs, labels, label, max_rows, id_col, text_col)

    def pack(text):
        slots, counts = word_counts(text, bits)
        return slots.astype("<i4").tobytes(), counts.astype("<i4").tobytes()

    rows = collected(sample, pack)
    return train([(np.frombuffer(x, "<i4"), np.frombuffer(k, "<i4")) for _, x, k in rows], np.array([y for y, _, _ in rows], int), bits)


def scored(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, severity, p_toxic, grade (most likely), toxic."""
    shared = docs.sparkSession.sparkContext.broadcast((model.slots, model.weights, model.theta, model.bits))

    def exceed(texts: pd.Series) -> pd.DataFrame:
        m = ToxicityModel(*shared.value)
        rows = np.array([m.exceed(t) for t in texts]).reshape(-1, GRADES - 1)
        each = -np.diff(np.concatenate([np.ones((len(rows), 1)), rows, np.zeros((len(rows), 1))], axis=1), axis=1)
        return pd.DataFrame({"severity": rows.sum(axis=1), "p_toxic": rows[:, 0], "grade": each.argmax(axis=1).astype(np.int32)})

    s = F.pandas_udf(exceed, "severity double, p_toxic double, grade int")(F.col(text_col))
    out = docs.select(F.col(id_col).alias("doc_id"), (fold(F.col(id_col)) == 0).alias("held_out"), s.alias("s"))
    return out.select("doc_id", "held_out", "s.severity", "s.p_toxic", "s.grade", (F.col("s.p_toxic") >= TOXIC_AT).alias("toxic"))
