"""Quality classifier: naive Bayes support vectors over n-gram indicators."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.frames import crc_of_id
from riskloom.llm.linear import runs_and_pairs, sample_terms, score_rows, sigmoid

# Bound of the training sample, in labelled rows.
TRAIN_ROWS = 8_000
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7


@dataclass
class QualityModel:
    """Score: sigmoid(slope * margin + shift), margin from unit vectors of scaled indicators."""

    keys: np.ndarray
    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms of at least two rows, and the log ratio of their smoothed shares in both classes."""
    flat = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    of = np.repeat(good, [len(r) for r in rows])
    keys, place = np.unique(flat, return_inverse=True)
    high = np.bincount(place, of, len(keys))
    low = np.bincount(place, ~of, len(keys))
    kept = high + low >= 2
    keys, high, low = keys[kept], high[kept] + 1, low[kept] + 1
    return keys, np.log(high / high.sum()) - np.log(low / low.sum())


def descend(vectors: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, cost: float, epochs: int) -> tuple[np.ndarray, float]:
    """Hinge loss with L2 term by dual coordinate descent; the bias is a constant feature of value 1."""
    weight, bias, dual = np.zeros(size), 0.0, np.zeros(len(y))
    order = np.random.default_rng(0)
    # Both classes weigh alike, whatever their shares.
    limit = cost * np.where(y > 0, len(y) / 2 / max(1, (y > 0).sum()), len(y) / 2 / max(1, (y < 0).sum()))
    square = np.array([float(v @ v) + 1 for _, v in vectors])
    for _ in range(epochs):
        for i in order.permutation(len(y)):
            at, value = vectors[i]
            slope = y[i] * (float(weight[at] @ value) + bias) - 1
            new = min(max(dual[i] - slope / square[i], 0.0), limit[i])
            if new != dual[i]:
                step = (new - dual[i]) * y[i]
                weight[at] += step * value
                bias += step
                dual[i] = new
    return weight, bias


def _vectors(rows: list[np.ndarray], keys: np.ndarray, ratios: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for terms in rows:
        at = np.minimum(np.searchsorted(keys, terms), max(0, len(keys) - 1))
        at = at[keys[at] == terms] if len(keys) else at[:0]
        value = ratios[at]
        out.append((at, value / (np.sqrt(value @ value) or 1.0)))
    return out


def _platt(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through the margins, by Newton steps; slopes stay positive."""
    target = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))
    slope, shift = 1.0, 0.0
    for _ in range(100):
        p = sigmoid(slope * margin + shift)
        w, d = p * (1 - p) + 1e-9, p - target
        hessian = np.array([[w @ margin**2 + 1e-6, w @ margin], [w @ margin, w.sum() + 1e-6]])
        move = np.linalg.solve(hessian, [d @ margin, d.sum()])
        move *= min(1.0, 2 / (np.abs(move).max() + 1e-12))
        slope, shift = max(slope - move[0], 1e-3), shift - move[1]
    return float(slope), float(shift)


def fit_nbsvm(rows: list[tuple[int, np.ndarray]], cost: float = 1.0, epochs: int = 12, blend: float = 0.25) -> QualityModel:
    """Model from rows (label 0 or 1, distinct terms). A fifth of them, left out first, sets the score's curve."""
    good, terms = np.array([y == 1 for y, _ in rows], bool), [t for _, t in rows]
    if not len(rows) or good.all() or not good.any():
        share = (good.sum() + 0.5) / (len(rows) + 1)
        return QualityModel(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), 0.0, 1.0, float(np.log(share / (1 - share))))

    def fit(at: np.ndarray):
        keys, ratios = log_count_ratios([terms[i] for i in at], good[at])
        vectors = _vectors([terms[i] for i in at], keys, ratios)
        weight, bias = descend(vectors, np.where(good[at], 1.0, -1.0), len(keys), cost, epochs)
        mean = np.abs(weight).mean() if len(weight) else 0.0
        return keys, ratios, (1 - blend) * mean + blend * weight, blend * bias

    aside = np.arange(len(rows)) % 5 == 0
    if good[aside].any() and not good[aside].all() and good[~aside].any() and not good[~aside].all():
        keys, ratios, weight, bias = fit(np.flatnonzero(~aside))
        margin = np.array([weight[a] @ v + bias for a, v in _vectors([terms[i] for i in np.flatnonzero(aside)], keys, ratios)])
        slope, shift = _platt(margin, good[aside])
    else:
        slope, shift = 1.0, 0.0
    return QualityModel(*fit(np.arange(len(rows))), slope, shift)


def train_quality(
    documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = TRAIN_ROWS, seed: int = 7
) -> QualityModel:
    """Model from the labelled rows of the training fold, those of least seeded hash of their id if over `rows`.

    Null labels are none. With labels of one class only, each row's score is that class's smoothed share.
    """
    marked = labels.select(F.col(doc_id).alias("id"), F.col("quality").cast("int").alias("label"))
    marked = marked.filter("id IS NOT NULL AND label IS NOT NULL").filter(crc_of_id("id") % FOLDS != HELD_OUT).distinct()
    chosen = marked.orderBy(F.xxhash64("id", F.lit(seed)), "id", "label").limit(rows)
    return fit_nbsvm(sample_terms(documents, doc_id, text, chosen, runs_and_pairs))


def score_quality(documents: DataFrame, model: QualityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, of its whole text; `predicted` is 1 from THRESHOLD.

    A null or empty text, and one without known terms, has the score of the bias alone. Repeated rows
    are scored each; no other column plays a part.
    """
    ratios, weights, bias, slope, shift = model.ratios, model.weights, model.bias, model.slope, model.shift

    def score(rows, columns, n):
        value = ratios[columns]
        norm = np.sqrt(np.bincount(rows, value**2, n))
        margin = np.bincount(rows, weights[columns] * value, n) / np.where(norm > 0, norm, 1) + bias
        return sigmoid(slope * margin + shift)

    scored = score_rows(documents, doc_id, text, runs_and_pairs, model.keys, score)
    return scored.select(
        "doc_id",
        (crc_of_id("doc_id") % FOLDS == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
