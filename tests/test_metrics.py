import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import metrics

# Published fold matrices (tn, fp, fn, tp) with their accuracy, precision, recall and f1.
FOLDS = [
    ((3801, 1750, 126, 323), (0.6873333333333334, 0.155812831644959, 0.7193763919821826, 0.25614591593973035)),
    ((3894, 1656, 143, 307), (0.7001666666666667, 0.1563932755985736, 0.6822222222222222, 0.25445503522585994)),
    ((3887, 1663, 129, 321), (0.7013333333333334, 0.1617943548387097, 0.7133333333333334, 0.2637633525061627)),
    ((3823, 1727, 127, 323), (0.691, 0.1575609756097561, 0.7177777777777777, 0.2584)),
    ((3809, 1741, 110, 340), (0.6915, 0.16338298894762135, 0.7555555555555555, 0.2686685104701699)),
]
FOLD_PR_AUC = [0.19095809134522765, 0.17595413459160547, 0.17975569134006045, 0.19711677605191819, 0.21930100346603867]


def brute(rows, threshold):
    tp = sum(1 for y, p in rows if y and p >= threshold)
    fp = sum(1 for y, p in rows if not y and p >= threshold)
    fn = sum(1 for y, p in rows if y and p < threshold)
    tn = sum(1 for y, p in rows if not y and p < threshold)
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    auc = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    ap, recall = 0.0, 0.0
    for t in sorted({p for _, p in rows}, reverse=True):
        hit = [y for y, p in rows if p >= t]
        ap += (sum(hit) / len(pos) - recall) * sum(hit) / len(hit)
        recall = sum(hit) / len(pos)
    return tn, fp, fn, tp, auc, ap


def sample(n=400, digits=2, seed=11):
    rng = random.Random(seed)
    return [(int(rng.random() < 0.2), round(rng.random(), digits)) for _ in range(n)]


@pytest.mark.parametrize("cells,expected", FOLDS)
def test_published_fold_rates(spark, cells, expected):
    names = ["tn", "fp", "fn", "tp"]
    df = spark.createDataFrame([cells], names)
    found = metrics.rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    assert list(df.select(*[c.alias(n) for n, c in found.items()]).first()) == pytest.approx(list(expected))


def test_published_cv_summary(spark):
    df = spark.createDataFrame([(v,) for v in FOLD_PR_AUC], "pr_auc double")
    row = metrics.cv_summary(df).first()
    assert row.cv_pr_auc_mean == pytest.approx(0.19261713935897007)
    assert row.cv_pr_auc_std == pytest.approx(0.015349920829667242)


@pytest.mark.parametrize("buckets", [False, True])
def test_evaluate(spark, request, buckets):
    if buckets:
        request.getfixturevalue("many_buckets")
    groups = {g: sample(seed=g) for g in (1, 2)}
    df = spark.createDataFrame([(g, y, p) for g, rows in groups.items() for y, p in rows], "g int, y int, p double")
    for r in metrics.evaluate(df, "y", "p", 0.5, ["g"]).collect():
        tn, fp, fn, tp, auc, ap = brute(groups[r.g], 0.5)
        assert r.confusion_matrix == [[tn, fp], [fn, tp]]
        assert (r.roc_auc, r.pr_auc) == (pytest.approx(auc), pytest.approx(ap))
        assert r.accuracy == pytest.approx((tn + tp) / 400)


def test_average_precision_is_a_step_sum(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.5), (0, 0.5), (1, 0.1)], "y int, p double")
    assert metrics.pr_auc(df, "y", "p").first().pr_auc == pytest.approx(brute([(r.y, r.p) for r in df.collect()], 0.5)[5])


def test_one_class_and_nothing_predicted(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "y int, p double")
    row = metrics.evaluate(df, "y", "p", 0.5).first()
    assert row.roc_auc is None and row.pr_auc == 0.0
    assert (row.accuracy, row.precision, row.recall, row.f1) == (1.0, 0.0, 0.0, 0.0)
    matrix = {r.actual: (r.Pred_0, r.Pred_1) for r in metrics.confusion_matrix(df, "y", "p", 0.5).collect()}
    assert matrix == {"Actual_0": (2, 0), "Actual_1": (0, 0)}
    assert [tuple(r)[1:] for r in metrics.confusion_matrix(df.limit(0), "y", "p", 0.5).collect()] == [(0, 0), (0, 0)]


def test_missing_score_is_the_lowest(spark):
    df = spark.createDataFrame([(1, None), (0, 0.2), (1, 0.7)], "y int, p double")
    row = metrics.evaluate(df, "y", "p", 0.5).first()
    assert row.confusion_matrix == [[1, 0], [1, 1]] and row.roc_auc == 0.5


def test_sweep_compares_exactly(spark):
    """Scores equal to a threshold, one step of precision beside it, and out of range."""
    edges = [i / 100 for i in range(101)]
    scores = [s for t in edges for s in (np.nextafter(t, -1), t, np.nextafter(t, 2))] + [-3.0, 7.0]
    rows = [(i % 2, float(p)) for i, p in enumerate(scores)]
    df = spark.createDataFrame(rows, "y int, p double")
    found = metrics.threshold_sweep(df, "y", "p").orderBy("threshold").collect()
    assert [r.threshold for r in found] == [i / 100 for i in range(5, 96)]
    for r in found:
        tn, fp, fn, tp, *_ = brute(rows, r.threshold)
        assert r.precision == pytest.approx(tp / (tp + fp)) and r.recall == pytest.approx(tp / (tp + fn))


def sweep(spark, *rows):
    return spark.createDataFrame(rows, "threshold double, precision double, recall double, f1 double")


def test_select_threshold(spark):
    enough = sweep(spark, (0.1, 0.2, 0.9, 0.3), (0.2, 0.3, 0.8, 0.4), (0.3, 0.3, 0.8, 0.4), (0.4, 0.9, 0.1, 0.9))
    assert metrics.select_threshold(enough, 0.75).first().threshold == 0.3
    too_little = sweep(spark, (0.1, 0.2, 0.5, 0.3), (0.2, 0.4, 0.4, 0.4), (0.3, 0.4, 0.4, 0.4), (0.4, 0.3, 0.4, 0.4))
    assert metrics.select_threshold(too_little, 0.75).first().threshold == 0.2


def test_model_comparison_order(spark):
    rows = sample()
    df = spark.createDataFrame([(m, y, p if m == "good" else 1 - p) for m in ("bad", "good") for y, p in
                                [(y, (p + y) / 2) for y, p in rows]], "model string, y int, p double")
    assert [r.model for r in metrics.model_comparison(df, "y", "p").collect()] == ["good", "bad"]
