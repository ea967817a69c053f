"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.frames import crc_of_id
from riskloom.llm.linear import sample_terms, score_rows, sigmoid, sparse, words

# Bounds of the training sample, in rows.
POSITIVE_ROWS = 3_000
UNLABELLED_ROWS = 9_000
# Words kept as features: of those that confirmed rows hold so many times as often as unlabelled ones, or
# the other way round, and by so many standard errors, the most different ones.
FEATURES = 4_000
RATIO, APART = 2.5, 3.0
FOLDS, HELD_OUT = 5, 0
# Share of toxic rows assumed where the labels hold no negative to tell it.
PRIOR = 0.1


@dataclass
class ToxicityModel:
    """Scores are sigmoid(bias + sum of the weights of the known words present)."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float


def fit_nnpu(rows: list[tuple[int, np.ndarray]], prior: float, features: int = FEATURES, rounds: int = 400) -> ToxicityModel:
    """Linear model from rows (1 confirmed, 0 unlabelled; distinct words), by Adam on the whole sample.

    The risk is prior * P[loss(+)] + max(0, U[loss(-)] - prior * P[loss(-)]) with the logistic loss;
    where the second term turns negative, its gradient is followed upwards instead.
    """
    known, free = [t for y, t in rows if y == 1], [t for y, t in rows if y == 0]
    if not known or not free:
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))), prior)
    keys, count = np.unique(np.concatenate(known), return_counts=True)
    keys, count = keys[count >= 2], count[count >= 2]
    _, columns = sparse(free, keys)
    p = (count + 0.5) / (len(known) + 1)
    u = (np.bincount(columns, minlength=len(keys)) + 0.5) / (len(free) + 1)
    apart = (p - u) / np.sqrt(p * (1 - p) / len(known) + u * (1 - u) / len(free))
    order = np.argsort(-np.abs(apart), kind="stable")[:features]
    telling = (np.abs(apart) >= APART) & (np.maximum(p / u, u / p) >= RATIO)
    keys = np.sort(keys[order[telling[order]]])

    n, (row, column) = len(known) + len(free), sparse(known + free, keys)
    confirmed = np.arange(n) < len(known)
    weight, bias = np.zeros(len(keys)), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(len(keys) + 1), np.zeros(len(keys) + 1)
    for step in range(1, rounds + 1):
        margin = bias + np.bincount(row, weight[column], n)
        high = sigmoid(margin)
        loss_minus = np.logaddexp(0, margin)
        negative_risk = loss_minus[~confirmed].mean() - prior * loss_minus[confirmed].mean()
        minus = np.where(confirmed, -prior * high / len(known), high / len(free))
        plus = np.where(confirmed, -prior * (1 - high) / len(known), 0.0)
        slope = plus + minus if negative_risk >= 0 else -minus
        gradient = np.append(np.bincount(column, slope[row], len(keys)) + 1e-5 * weight, slope.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weight, bias = weight - move[:-1], bias - move[-1]
    return ToxicityModel(keys, weight, float(bias), prior)


def train_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    positive_rows: int = POSITIVE_ROWS,
    unlabelled_rows: int = UNLABELLED_ROWS,
    seed: int = 7,
) -> ToxicityModel:
    """Model from the confirmed toxic rows of the training fold and a sample of all its rows.

    Both samples are the rows of least seeded hash of their id, within the given bounds. The class
    prior is the share of toxic ones among all labelled rows of the fold. Null labels are none. With
    no toxic label the model scores each row with the prior.
    """
    fold = crc_of_id("id") % FOLDS != HELD_OUT
    marked = labels.select(F.col(doc_id).alias("id"), F.col("toxic").cast("int").alias("label")).filter(fold)
    marked = marked.filter("id IS NOT NULL AND label IS NOT NULL").distinct()
    share = marked.agg(F.avg("label"), F.min("label")).first()
    prior = min(max(float(share[0]), 1e-3), 0.5) if share[0] is not None and share[1] == 0 else PRIOR
    draw = F.xxhash64("id", F.lit(seed))
    ids = documents.select(F.col(doc_id).alias("id")).filter(fold).filter("id IS NOT NULL")
    known = marked.filter("label = 1").join(ids.distinct(), "id", "left_semi").orderBy(draw, "id").limit(positive_rows)
    free = ids.withColumn("label", F.lit(0)).orderBy(draw, "id").limit(unlabelled_rows)
    return fit_nnpu(sample_terms(documents, doc_id, text, known.union(free.distinct()), words), prior)


def score_toxicity(documents: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, of its whole text.

    `predicted` is 1 from a score of 0.5. A null or empty text, and one without known words, has the
    score of the bias alone. Repeated rows are scored each; no other column plays a part.
    """
    weights, bias = model.weights, model.bias

    def score(rows, columns, n):
        return sigmoid(bias + np.bincount(rows, weights[columns], n))

    scored = score_rows(documents, doc_id, text, words, model.keys, score)
    return scored.select(
        "doc_id",
        (crc_of_id("doc_id") % FOLDS == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(documents: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """The rows, with all columns, whose text scores below 0.5; decided row by row, without a join."""
    from riskloom.llm.frames import small_batches
    from riskloom.llm.linear import Lookup

    small_batches(documents.sparkSession)
    place, weights, bias = documents.columns.index(text), model.weights, model.bias
    sent = documents.sparkSession.sparkContext.broadcast(model.keys)

    def keep(batches):
        lookup = Lookup(sent.value)
        for batch in batches:
            rows, columns = lookup(*words(batch.column(place).cast("string")))
            margin = bias + np.bincount(rows, weights[columns], batch.num_rows)
            yield batch.filter(margin < 0)

    return documents.mapInArrow(keep, documents.schema)
