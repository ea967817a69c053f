"""Classification metrics as aggregates; `by` adds group columns such as a fold or a model name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ordering import LOWEST, cumulate
from riskloom.schema import MIN_RECALL
from riskloom.session import materialize

# The sweep runs from 0.05 to 0.95 in steps of 0.01.
SWEEP_FIRST, SWEEP_LAST, SWEEP_STEPS = 5, 95, 100


def claim_rate(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col(label)).cast("long").alias("n_claims"),
        F.avg(F.col(label)).alias("claim_rate"),
    )


def score(p: str) -> Column:
    """A missing score or NaN ranks below every other."""
    return F.coalesce(F.nullif(F.col(p).cast("double"), F.lit(float("nan"))), F.lit(LOWEST))


def score_histogram(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score: all that ranking metrics need, computed once.

    Rows of one score collapse before the shuffle, so a score shared by a third of the rows is cheap.
    """
    positive = (F.col(y) == 1).cast("long")
    return materialize(
        df.groupBy(*by, score(p).alias("score")).agg(
            F.sum(positive).alias("pos"), F.sum(F.lit(1) - positive).alias("neg")
        )
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def rates(tp: Column, fp: Column, fn: Column, tn: Column | None = None) -> dict[str, Column]:
    found = {
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
    }
    if tn is not None:
        found = {"accuracy": F.try_divide((tp + tn).cast("double"), tp + fp + fn + tn), **found}
    return found


def confusion_counts(df: DataFrame, y: str, p: str, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn in one pass; without groups exactly one row, also for no input."""
    actual, predicted = F.col(y) == 1, score(p) >= threshold

    def cell(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    return df.groupBy(*by).agg(
        cell(actual & predicted).alias("tp"),
        cell(~actual & predicted).alias("fp"),
        cell(actual & ~predicted).alias("fn"),
        cell(~actual & ~predicted).alias("tn"),
    )


def confusion_matrix(df: DataFrame, y: str, p: str, threshold: float) -> DataFrame:
    """Two rows, Actual_0 and Actual_1, zero cells included."""
    rows = F.array(
        F.struct(F.lit("Actual_0").alias("actual"), F.col("tn").alias("Pred_0"), F.col("fp").alias("Pred_1")),
        F.struct(F.lit("Actual_1").alias("actual"), F.col("fn").alias("Pred_0"), F.col("tp").alias("Pred_1")),
    )
    return confusion_counts(df, y, p, threshold).select(F.inline(rows))


def _rate(name: str, df, y, p, threshold, by) -> DataFrame:
    c = F.col
    value = rates(c("tp"), c("fp"), c("fn"), c("tn"))[name]
    return confusion_counts(df, y, p, threshold, by).select(*by, value.alias(name))


def accuracy(df: DataFrame, y: str, p: str, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    return _rate("accuracy", df, y, p, threshold, by)


def precision(df: DataFrame, y: str, p: str, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    return _rate("precision", df, y, p, threshold, by)


def recall(df: DataFrame, y: str, p: str, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    return _rate("recall", df, y, p, threshold, by)


def f1(df: DataFrame, y: str, p: str, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    return _rate("f1", df, y, p, threshold, by)


def _ranking(histogram: DataFrame, by: Sequence[str], *extra: Column) -> DataFrame:
    """ROC-AUC (ties count half) and average precision from one walk down the scores."""
    c = F.col
    walked = cumulate(histogram, "score", ["pos", "neg"], by=by, descending=True)
    above = (c("cum_pos") - c("pos")).cast("double")
    concordant = F.sum(c("neg") * (above + c("pos") / F.lit(2.0)))
    stepped = F.sum(c("pos") * c("cum_pos").cast("double") / (c("cum_pos") + c("cum_neg")))
    all_pos, all_neg = F.sum("pos"), F.sum("neg")
    return walked.groupBy(*by).agg(
        F.try_divide(concordant, all_pos.cast("double") * all_neg).alias("roc_auc"),
        F.coalesce(F.try_divide(stepped, all_pos.cast("double")), F.lit(0.0)).alias("pr_auc"),
        *extra,
    )


def roc_auc(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """NULL where only one class is present."""
    return _ranking(score_histogram(df, y, p, by), by).select(*by, "roc_auc")


def pr_auc(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Average precision: the step sum over distinct scores, 0 without positives."""
    return _ranking(score_histogram(df, y, p, by), by).select(*by, "pr_auc")


def evaluate(df: DataFrame, y: str, p: str, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """Threshold metrics, ranking metrics and the confusion matrix from one score histogram."""
    c = F.col
    hit = c("score") >= threshold

    def total(count: str, condition: Column) -> Column:
        return F.sum(F.when(condition, c(count)).otherwise(F.lit(0)))

    cells = [
        total("pos", hit).alias("tp"),
        total("neg", hit).alias("fp"),
        total("pos", ~hit).alias("fn"),
        total("neg", ~hit).alias("tn"),
    ]
    found = _ranking(score_histogram(df, y, p, by), by, *cells)
    matrix = F.array(F.array("tn", "fp"), F.array("fn", "tp"))
    return found.select(
        *by,
        F.lit(float(threshold)).alias("threshold"),
        *[col.alias(name) for name, col in rates(c("tp"), c("fp"), c("fn"), c("tn")).items()],
        "roc_auc",
        "pr_auc",
        matrix.alias("confusion_matrix"),
    )


def threshold_sweep(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 at the 91 thresholds, from one pass over the rows.

    Each row goes to the highest threshold it reaches; at most 92 counts per group are left, and
    only those are spread over the thresholds below them.
    """
    c = F.col
    s, steps = score(p), F.lit(float(SWEEP_STEPS))
    # p * 100 rounds, so the guess can be one step off the exact comparison with i / 100.
    guess = F.floor(F.greatest(F.least(s, F.lit(2.0)), F.lit(-1.0)) * steps)
    reached = guess + F.when(s >= (guess + 1) / steps, 1).when(s < guess / steps, -1).otherwise(0)
    reached = F.greatest(F.least(reached, F.lit(SWEEP_LAST)), F.lit(SWEEP_FIRST - 1))
    positive = (c(y) == 1).cast("long")
    counts = df.groupBy(*by, reached.alias("__reached")).agg(
        F.sum(positive).alias("__pos"), F.sum(F.lit(1) - positive).alias("__neg")
    )
    steps_list = F.explode(F.sequence(F.lit(SWEEP_FIRST), F.lit(SWEEP_LAST)))
    hit = c("__reached") >= c("__step")
    cells = (
        counts.withColumn("__step", steps_list)
        .groupBy(*by, "__step")
        .agg(
            F.sum(F.when(hit, c("__pos")).otherwise(0)).alias("tp"),
            F.sum(F.when(hit, c("__neg")).otherwise(0)).alias("fp"),
            F.sum(F.when(~hit, c("__pos")).otherwise(0)).alias("fn"),
        )
    )
    return cells.select(
        *by,
        (c("__step") / steps).alias("threshold"),
        *[col.alias(name) for name, col in rates(c("tp"), c("fp"), c("fn")).items()],
    )


def select_threshold(sweep: DataFrame, min_recall: float = MIN_RECALL) -> DataFrame:
    """The sweep row with the best precision among those with enough recall, else with the best F1."""
    enough = F.col("recall") >= min_recall

    def only_if(condition: Column, value: Column) -> Column:
        return F.when(condition, value)

    return sweep.orderBy(
        enough.desc(),
        only_if(enough, F.col("precision")).desc(),
        F.col("f1").desc(),
        only_if(enough, F.col("threshold")).desc(),
        only_if(~enough, F.col("precision")).desc(),
        F.col("threshold").asc(),
    ).limit(1)


def cv_summary(folds: DataFrame, metric: str = "pr_auc") -> DataFrame:
    """Mean and population standard deviation over the folds."""
    return folds.agg(F.avg(metric).alias(f"cv_{metric}_mean"), F.stddev_pop(metric).alias(f"cv_{metric}_std"))


def model_comparison(df: DataFrame, y: str, p: str, model: str = "model", threshold: float = 0.5) -> DataFrame:
    """One row per model, best average precision first, then best F1."""
    found = evaluate(df, y, p, threshold, [model])
    at_threshold = [F.col(m).alias(f"{m}_0_5") for m in ("accuracy", "precision", "recall", "f1")]
    return found.select(F.col(model).alias("model"), *at_threshold, "roc_auc", "pr_auc").orderBy(
        F.desc("pr_auc"), F.desc("f1_0_5"), F.asc("model")
    )


def prediction_summary(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    label = F.when(F.col(prediction) == 1, "CLAIM").otherwise("NO_CLAIM")
    return df.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"))
