import json

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskloom.operators.boosting import PROBABILITY, BoostParams, class_weight, feature_importance, predict_probability, train_boosted
from riskloom.operators.cleaning import dedup
from riskloom.operators.features import policy_features, select_features
from riskloom.operators.metrics import roc_auc
from riskloom.operators.preparation import ONE_HOT, align_width, impute_median, impute_mode, modes, one_hot_stages
from riskloom.plans.scoring import SAMPLE_POLICY, score_batch, score_cutoff, score_policies
from riskloom.plans.training import train_and_evaluate, write_training
from riskloom.schema import LABEL, POLICY_COLUMNS
from riskloom.session import materialize, scratch_path
from riskloom.sources.models import load_model
from riskloom.sources.order_policies import order_policies
from riskloom.sources.policies import read_policies, write_table_csv
from riskloom.sources.reports import read_report, read_threshold, write_report
from riskloom.streaming.scoring import score_uploads


def test_imputation(spark):
    df = spark.createDataFrame([(1.0, "b", 1202), (2.0, "b", 1201), (3.0, "a", 1202), (10.0, "a", 1201), (None, None, None)],
                               "n double, s string, k int")
    assert impute_median(df, ["n"]).filter("s is null").first().n == 2.5
    assert modes(df, ["s", "k"]) == {"s": "a", "k": "1201"}
    filled = impute_mode(df, ["s", "k"]).filter("n is null").first()
    assert (filled.s, filled.k) == ("a", 1201)


def test_numeric_mode_ties_go_by_value(spark):
    df = spark.createDataFrame([(10, "10"), (9, "9")], "k int, s string")
    assert modes(df, ["k", "s"]) == {"k": "9", "s": "10"}


def test_one_hot_of_unseen_and_missing(spark):
    seen = spark.createDataFrame([("b",), ("a",), ("c",)], "s string")
    model = Pipeline(stages=one_hot_stages(["s"])).fit(seen)
    rows = spark.createDataFrame([("a",), ("c",), ("zzz",), (None,)], "s string")
    found = [list(r[0]) for r in model.transform(rows).select(vector_to_array("s" + ONE_HOT)).collect()]
    assert found == [[1, 0, 0], [0, 0, 1], [0, 0, 0], [0, 0, 0]]


@pytest.mark.parametrize("width,expected", [(2, [1, 0]), (3, [1, 0, 2]), (5, [1, 0, 2, 0, 0])])
def test_align_width(spark, width, expected):
    df = spark.createDataFrame([(Vectors.sparse(3, {0: 1.0, 2: 2.0}),)], ["v"])
    assert list(align_width(df, "v", width, "w").select(vector_to_array("w")).first()[0]) == expected


def test_class_weight(spark):
    df = spark.createDataFrame([(0,)] * 22201 + [(1,)] * 1799, f"{LABEL} int")
    assert class_weight(df).first().class_weight == pytest.approx(12.340744858254586)
    assert class_weight(df.filter(f"{LABEL} = 0")).first().class_weight == 22201


@pytest.fixture(scope="module")
def learnable(spark, folder):
    """Policies whose claims depend on the premium per day and the vehicle type."""
    raw = dedup(order_policies(spark, folder).select(*POLICY_COLUMNS))
    risky = (F.coalesce(F.col("PREMIUM"), F.lit(0.0)) > 3000) & (F.col("MAKE").isin("Brand#1", "Brand#2", "Brand#3") | (F.col("SEATS_NUM") > 4))
    return materialize(raw.withColumn("CLAIM_PAID", F.when(risky, 100.0)))


def test_training_learns_writes_and_scores(spark, learnable):
    training = train_and_evaluate(learnable, [BoostParams(n_estimators=5, learning_rate=0.3)], folds=2)
    folder = scratch_path(spark, "training")
    write_training(training, folder)

    report = read_report(spark, f"{folder}/report").first()
    assert report.rows_train + report.rows_test == learnable.count()
    assert report.holdout.roc_auc > 0.8 and report.holdout_pr_auc == report.holdout.pr_auc
    assert len(report.cv_threshold_metrics) == 2
    (tn, fp), (fn, tp) = report.holdout.confusion_matrix
    assert tn + fp + fn + tp == report.rows_test
    assert report.best_params.n_estimators == 5
    assert read_threshold(spark, f"{folder}/threshold") == training.threshold == report.selected_threshold
    assert spark.read.option("header", True).csv(f"{folder}/threshold_sweep").count() == 91
    cells = {r.actual: [int(r.Pred_0), int(r.Pred_1)] for r in spark.read.option("header", True).csv(f"{folder}/confusion_matrix").collect()}
    assert cells == {"Actual_0": [tn, fp], "Actual_1": [fn, tp]}

    model = load_model(f"{folder}/model")
    scored = score_batch(learnable, model, training.threshold)
    assert scored.columns == [*learnable.columns, PROBABILITY, "prediction", "risk_level", "actual_from_claim_paid", "prediction_match"]
    assert scored.drop(*scored.columns[-5:]).exceptAll(learnable).count() == 0
    assert roc_auc(scored, "actual_from_claim_paid", PROBABILITY).first().roc_auc > 0.8
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan

    top = score_batch(learnable, model, top_percent=7)
    assert top.filter("prediction = 1").count() == learnable.count() * 7 // 100
    assert "actual_from_claim_paid" not in score_batch(learnable.drop("CLAIM_PAID"), model).columns

    cutoff = score_cutoff(learnable, model, 10, n=1000)
    assert 0 < cutoff < 1
    late = {**SAMPLE_POLICY, "INSR_END": "2013-08-01"}
    rows = score_policies([SAMPLE_POLICY, late], model, cutoff, spark=spark).collect()
    good = next(r for r in rows if not r.reasons)
    bad = next(r for r in rows if r.reasons)
    assert good.prediction in (0, 1) and good.risk_level in ("LOW", "MEDIUM", "HIGH") and good.outcome_note
    assert bad.reasons == ["END_NOT_AFTER_BEGIN"] and bad.prediction is None and bad.risk_level is None

    uploads, out = scratch_path(spark, "uploads"), scratch_path(spark, "scored")
    write_table_csv(learnable, uploads)
    stream = score_uploads(spark, uploads, out, scratch_path(spark, "progress"), model, training.threshold)
    assert stream.awaitTermination(120)
    batch = score_batch(read_policies(spark, uploads), model, training.threshold)
    assert batch.exceptAll(spark.read.schema(batch.schema).parquet(out)).count() == 0

    ranked = feature_importance(model, select_features(policy_features(learnable))).collect()
    assert ranked[0].importance >= ranked[1].importance > 0
    assert {"PREMIUM", "PREMIUM_LOG", "SEATS_NUM"} & {r.feature.removesuffix("__filled") for r in ranked[:5]}


def test_unseen_category_scores(spark, learnable):
    rows = select_features(policy_features(learnable.withColumn(LABEL, (F.col("CLAIM_PAID") > 0).cast("int"))), LABEL)
    model = train_boosted(rows.fillna(0, [LABEL]), BoostParams(n_estimators=2))
    odd = learnable.limit(5).withColumn("MAKE", F.lit("never seen")).withColumn("USAGE", F.lit(None).cast("string"))
    found = predict_probability(model, select_features(policy_features(odd))).select(PROBABILITY).collect()
    assert all(0 <= r[0] <= 1 for r in found)


def test_dirty_policy_file(spark, tmp_path):
    header = ",".join(POLICY_COLUMNS)
    lines = [
        "0,08-AUG-13,07-AUG-14,1202,519755.22,7209.14,4.0,6.0,Pick-up,3153.0,NISSAN,Own Goods,2007.0,0.0",
        "x,bad,,1201.0,NaN,n/a,oops,,NA,None,null,,n/a,",
    ]
    (tmp_path / "p.csv").write_text("\n".join([header, *lines]) + "\n")
    good, bad = read_policies(spark, str(tmp_path)).collect()
    assert good.SEX == 0 and good.INSURED_VALUE == 519755.22 and good.PROD_YEAR == "2007.0"
    assert bad.asDict() == {**dict.fromkeys(POLICY_COLUMNS), "INSR_BEGIN": "bad", "INSR_TYPE": 1201}
    some = read_policies(spark, str(tmp_path), ["MAKE", "PREMIUM"])
    assert some.columns == ["MAKE", "PREMIUM"]
    assert "ReadSchema: struct<PREMIUM:string,MAKE:string>" in some._jdf.queryExecution().executedPlan().toString()


def test_reports_with_gaps(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"holdout": {"accuracy": 0.5}}, indent=2))
    row = read_report(spark, str(tmp_path / "r.json")).first()
    assert (row.best_model, row.holdout_accuracy, row.holdout_recall) == ("n/a", 0.5, 0.0)
    assert read_threshold(spark, str(tmp_path / "r.json")) == 0.5
    assert read_threshold(spark, str(tmp_path / "missing.json"), 0.4) == 0.4
    write_report(spark.createDataFrame([(0.25,)], "threshold double"), str(tmp_path / "t"))
    assert read_threshold(spark, str(tmp_path / "t")) == 0.25
