"""From raw policies to a stored model, its threshold and its reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.boosting import PROBABILITY, BoostParams, cross_validate, predict_probability, train_boosted, tune
from riskloom.operators.cleaning import dedup, with_claim_label
from riskloom.operators.features import policy_features, select_features
from riskloom.operators.metrics import claim_rate, cv_summary, evaluate, model_comparison, select_threshold, threshold_sweep
from riskloom.operators.ordering import row_key
from riskloom.operators.sampling import stratified_fit_split, stratified_kfold, stratified_sample, stratified_split
from riskloom.schema import CV_FOLDS, CV_ROWS_MAX, LABEL, MIN_RECALL, SEED, TEST_FRACTION, TRAIN_ROWS_MAX
from riskloom.session import materialize, store
from riskloom.sources.models import save_model
from riskloom.sources.policies import write_table_csv
from riskloom.sources.reports import REPORT_SCHEMA, write_report

KEY = "row_key"
MODEL_NAME = "boosted_trees_tuned"


@dataclass(frozen=True)
class Training:
    model: PipelineModel
    threshold: float
    sweep: DataFrame
    comparison: DataFrame
    confusion: DataFrame
    report: DataFrame


def prepare_policies(raw: DataFrame, seed: int = SEED) -> DataFrame:
    """Distinct policies with their key, label and the 24 features, computed once and kept."""
    policies = dedup(raw)
    keyed = with_claim_label(policies.withColumn(KEY, row_key(policies, seed=seed)))
    return store(select_features(policy_features(keyed), KEY, LABEL))


def train_and_evaluate(
    raw: DataFrame,
    grid: Sequence[BoostParams] = (BoostParams(),),
    max_rows: int | None = TRAIN_ROWS_MAX,
    min_recall: float = MIN_RECALL,
    folds: int = CV_FOLDS,
    seed: int = SEED,
    cv_max_rows: int | None = CV_ROWS_MAX,
    parallelism: int = CV_FOLDS,
) -> Training:
    """Holdout split, bounded fit rows, tuning, threshold, holdout metrics, cross-validation.

    The threshold comes from validation scores of a model that has not seen the validation rows; the
    winner is then fit again on a sample of both. `max_rows` bounds the rows that a model is fit on
    (None: all train rows), `cv_max_rows` those of each fold's model. Validation takes every other train
    row, cross-validation scores all of them. `parallelism` candidates or folds are fit at a time.
    """
    key = F.col(KEY)
    policies = stratified_split(prepare_policies(raw, seed), LABEL, TEST_FRACTION, seed, key)
    train, test = (policies.filter(F.col("split") == part).drop("split") for part in ("train", "test"))
    order = _again(seed, "fit")
    parts = stratified_fit_split(train, LABEL, max_rows, TEST_FRACTION, seed, order)
    fit_rows = materialize(parts.filter("part = 'fit'").drop("part"))
    valid_rows = parts.filter("part = 'valid'").drop("part")

    candidate, params, _ = tune(fit_rows, valid_rows, grid, parallelism=parallelism)
    valid = materialize(predict_probability(candidate, valid_rows).select(LABEL, PROBABILITY))
    sweep = materialize(threshold_sweep(valid, LABEL, PROBABILITY))
    threshold = select_threshold(sweep, min_recall).first().threshold
    comparison = model_comparison(valid.withColumn("model", F.lit(MODEL_NAME)), LABEL, PROBABILITY)

    sample = train if max_rows is None else materialize(stratified_sample(train, LABEL, max_rows, seed, order))
    model = train_boosted(sample, params)
    scored = predict_probability(model, test).select(LABEL, PROBABILITY)
    holdout = materialize(evaluate(scored, LABEL, PROBABILITY, threshold))

    cv_rows = store(stratified_kfold(train, LABEL, folds, seed, _again(seed, "folds")))
    cv = materialize(
        cross_validate(cv_rows, threshold, params, folds, max_rows=cv_max_rows, key=_again(seed, "cv"), parallelism=parallelism)
    )

    report = _report(params, min_recall, threshold, holdout, cv, claim_rate(policies, LABEL, ["split"]))
    cells = F.transform("confusion_matrix", lambda r: F.struct(r[0].alias("Pred_0"), r[1].alias("Pred_1")))
    confusion = holdout.select(F.posexplode(cells).alias("i", "cell")).select(
        F.format_string("Actual_%d", "i").alias("actual"), "cell.*"
    )
    return Training(model, threshold, sweep.orderBy("threshold"), comparison, confusion, report)


def _again(seed: int, use: str):
    """A new order for every further draw, or each would take the same end of the first one."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(use), F.col(KEY)))


def _report(params, min_recall, threshold, holdout, cv, split_rates) -> DataFrame:
    """One nested row, put together from aggregates of one row per fold or split."""
    folds = [row.asDict() for row in cv.orderBy("fold").collect()]
    rates = {row.split: row for row in split_rates.collect()}
    document = {
        "best_model": MODEL_NAME,
        "best_params": asdict(params),
        "target_min_recall": float(min_recall),
        "selected_threshold": threshold,
        "holdout": holdout.first().asDict(),
        **cv_summary(cv).first().asDict(),
        "cv_threshold_metrics": folds,
        **{f"rows_{split}": rates[split].n_rows for split in ("train", "test")},
        **{f"claim_rate_{split}": rates[split].claim_rate for split in ("train", "test")},
    }
    return holdout.sparkSession.createDataFrame([document], REPORT_SCHEMA)


def write_training(training: Training, folder: str) -> None:
    """Model, threshold, report and tables as the scoring side expects them."""
    save_model(training.model, f"{folder}/model")
    write_report(training.report, f"{folder}/report")
    write_report(training.report.select(F.col("selected_threshold").alias("threshold")), f"{folder}/threshold")
    write_table_csv(training.sweep, f"{folder}/threshold_sweep")
    write_table_csv(training.comparison, f"{folder}/model_comparison")
    write_table_csv(training.confusion, f"{folder}/confusion_matrix")
