"""One Spark query per operator, each over whole tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import cache

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.decisions import decide_threshold, outcome_note, risk_label
from riskloom.functions.parsing import clamp_date, number_column, parse_policy_date
from riskloom.operators import boosting, cleaning, decisions, metrics, preparation, profiles, ranking, sampling
from riskloom.operators.features import policy_features, select_features
from riskloom.operators.ordering import row_key
from riskloom.operators.reference import extend_sample, read_sample, write_sample
from riskloom.plans.scoring import score_batch, score_cutoff, score_policies
from riskloom.schema import CATEGORICAL, LABEL, NUMERIC, POLICY_COLUMNS, TRAIN_ROWS_MAX
from riskloom.session import materialize, scratch_path, skew_safe, store
from riskloom.sources.models import load_model, save_model
from riskloom.sources.order_policies import ROW_IDS, order_policies, scored_policies
from riskloom.sources.policies import read_policies, write_table_csv
from riskloom.sources.reports import metrics_struct, read_report, read_top_x, top_x_document, write_report

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

THRESHOLD = 0.5
DIGITS = 6
# The tuned model: 200 rounds.
PARAMS = boosting.BoostParams()
CHECK_BOUNDS = {"prod_year_min": 1980, "prod_year_max": 1999, "policy_max_date": "2001-12-31"}


def query(name: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = lambda spark, folder: run(skew_safe(spark), folder)
        return run

    return register


def _rounded(df: DataFrame) -> DataFrame:
    doubles = {f.name: F.round(f.name, DIGITS) for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.withColumns(doubles)


def _key(df: DataFrame) -> Column:
    return row_key(df, ROW_IDS)


def _distinct(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.dedup(order_policies(spark, folder))


def _distinct_scored(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.dedup(scored_policies(spark, folder))


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return select_features(policy_features(order_policies(spark, folder)), *ROW_IDS)


def _policies(spark: SparkSession, folder: str) -> DataFrame:
    return order_policies(spark, folder).select(*ROW_IDS, *POLICY_COLUMNS)


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Claim rate, count and average premium by vehicle type over distinct, labelled policies."""
    policies = policy_features(cleaning.with_claim_label(_distinct(spark, folder)))
    return policies.groupBy("TYPE_VEHICLE").agg(
        F.count(F.lit(1)).alias("n_policies"),
        F.round(F.avg(LABEL), DIGITS).alias("claim_rate"),
        F.round(F.avg("PREMIUM"), 4).alias("avg_premium"),
        F.round(F.avg("VEHICLE_AGE_YEARS"), DIGITS).alias("avg_vehicle_age"),
    )


query("flagship_claim_rate_by_vehicle")(flagship)


# --- sources and sinks --------------------------------------------------------------------------


@query("a1_read_policies")
def _(spark, folder):
    path = scratch_path(spark, "policies")
    write_table_csv(order_policies(spark, folder).select(POLICY_COLUMNS), path)
    return read_policies(spark, path)


@query("a1_reconcile_files")
def _(spark, folder):
    """Files that differ in order, number and names of columns, and lines of the wrong width, read as one table."""
    policies = order_policies(spark, folder)
    lot = F.col("policy_id") % 3
    path = scratch_path(spark, "mixed")
    write_table_csv(policies.filter(lot == 0).select(POLICY_COLUMNS[::-1]), f"{path}/reordered")
    write_table_csv(policies.filter(lot == 1).select("line_k", *POLICY_COLUMNS, F.lit("a, b").alias("NOTE")), f"{path}/extra")
    write_table_csv(policies.filter(lot == 2).select([c for c in POLICY_COLUMNS if c != "CLAIM_PAID"]), f"{path}/missing")
    wrong = policies.filter((lot == 0) & (F.col("line_k") == 1)).select("policy_id", "sup_k", F.lit("x").alias("MAKE"))
    # The one column is named like a whole header, so its lines have three fields under fourteen names.
    line = F.concat_ws(",", "policy_id", "sup_k", "MAKE").alias(",".join(POLICY_COLUMNS))
    wrong.select(line).write.option("header", True).option("sep", "\u0001").csv(f"{path}/ragged")
    return read_policies(spark, [f"{path}/{part}" for part in ("reordered", "extra", "missing", "ragged")], corrupt="raw_line")


@query("a2_read_report")
def _(spark, folder):
    path = scratch_path(spark, "report")
    found = metrics.evaluate(scored_policies(spark, folder), "y", "p", THRESHOLD)
    write_report(found.select(F.lit(THRESHOLD).alias("selected_threshold"), metrics_struct().alias("holdout")), path)
    report = read_report(spark, path)
    return _rounded(report.select("best_model", "selected_threshold", *[c for c in report.columns if c.startswith("holdout_")]))


@query("a3_write_table_csv")
def _(spark, folder):
    path = scratch_path(spark, "sweep")
    write_table_csv(metrics.threshold_sweep(scored_policies(spark, folder), "y", "p"), path)
    schema = "threshold double, precision double, recall double, f1 double"
    columns = [c.split()[0] for c in schema.split(", ")]
    return _rounded(spark.read.schema(schema).option("header", True).csv(path).select(columns))


@query("a4_write_report")
def _(spark, folder):
    path = scratch_path(spark, "top-x")
    scored = _distinct_scored(spark, folder)
    top = ranking.top_x_report(scored, "y", "p", key=_key(scored))
    write_report(top_x_document(top, ranking.threshold_baseline(scored, "y", "p", THRESHOLD)), path)
    read = read_top_x(spark, path)
    return _rounded(
        read.select("baseline.n_positive", "baseline.n_total", F.inline("top_x_results")).select(
            "n_positive", "n_total", "top_pct", "k", "precision", "recall", "coverage"
        )
    )


@query("a5_save_load_model")
def _(spark, folder):
    path = scratch_path(spark, "model")
    save_model(_model(spark, folder), path)
    before = boosting.predict_probability(_model(spark, folder), _features(spark, folder), "before")
    scored = boosting.predict_probability(load_model(path), before, "after")
    return scored.select(*ROW_IDS, (F.col("before") == F.col("after")).alias("same"))


# --- cleaning, projections, validation ----------------------------------------------------------


@query("b1_dedup")
def _(spark, folder):
    return _distinct(spark, folder)


@query("b2_claim_label")
def _(spark, folder):
    return cleaning.with_claim_label(order_policies(spark, folder)).select(*ROW_IDS, LABEL)


@query("b3_parse_policy_date")
def _(spark, folder):
    begin, end = parse_policy_date(F.col("INSR_BEGIN")), parse_policy_date(F.col("INSR_END"))
    iso = parse_policy_date(F.date_format(begin, "yyyy-MM-dd"))
    return order_policies(spark, folder).select(
        *ROW_IDS, begin.alias("begin_date"), end.alias("end_date"), iso.alias("iso_date")
    )


@query("b4_parse_number")
def _(spark, folder):
    policies = order_policies(spark, folder)
    return policies.select(*ROW_IDS, number_column(policies, "PROD_YEAR").alias("prod_year"))


def _as_doubles(df: DataFrame, columns: list[str]) -> DataFrame:
    """Year, month and day counts as DOUBLE, the type the model reads, so that gaps compare alike."""
    return _rounded(df.withColumns({c: F.col(c).cast("double") for c in columns}))


@query("b5_select_features")
def _(spark, folder):
    return _as_doubles(_features(spark, folder), NUMERIC)


@query("b6_validate_policies")
def _(spark, folder):
    policies = order_policies(spark, folder)
    checked = cleaning.validate_policies(policies, CHECK_BOUNDS)
    return checked.select(*ROW_IDS, F.array_join("reasons", ",").alias("reasons"), "is_valid")


@query("b7_clamp_date")
def _(spark, folder):
    low, high = F.lit("1999-01-01").cast("date"), F.lit("2000-12-31").cast("date")
    day = clamp_date(parse_policy_date(F.col("INSR_BEGIN")), low, high)
    return order_policies(spark, folder).select(*ROW_IDS, day.alias("clamped"))


@query("b8_drop_blank")
def _(spark, folder):
    return cleaning.drop_blank(order_policies(spark, folder), "USAGE")


# --- derived features ---------------------------------------------------------------------------

DERIVED = [
    "EFFECTIVE_YEAR_DERIVED",
    "POLICY_DURATION_DAYS",
    "VEHICLE_AGE_YEARS",
    "POLICY_BEGIN_MONTH",
    "POLICY_BEGIN_QUARTER",
    "POLICY_END_MONTH",
    "POLICY_END_QUARTER",
    "POLICY_DURATION_MONTHS",
    "INSURED_VALUE_LOG",
    "PREMIUM_LOG",
    "VALUE_PER_PREMIUM",
    "VALUE_PER_SEAT",
    "CAPACITY_PER_SEAT",
    "PREMIUM_PER_DAY",
    "AGE_BY_VALUE",
]


def _derived(column: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _as_doubles(policy_features(order_policies(spark, folder)).select(*ROW_IDS, column), [column])

    return run


for _i, _column in enumerate(DERIVED, start=1):
    query(f"c{_i}_{_column.lower()}")(_derived(_column))


# --- splits and samples -------------------------------------------------------------------------


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Keys and labels of the distinct rows, kept: a split reads them three times."""
    return store(cleaning.with_claim_label(_distinct(spark, folder)).select(*ROW_IDS, LABEL))


@query("d1_stratified_split")
def _(spark, folder):
    policies = _labelled(spark, folder)
    return sampling.stratified_split(policies, LABEL, key=_key(policies))


@query("d2_stratified_sample")
def _(spark, folder):
    policies = _labelled(spark, folder)
    return sampling.stratified_sample(policies, LABEL, TRAIN_ROWS_MAX, key=_key(policies))


@query("d3_stratified_kfold")
def _(spark, folder):
    policies = _labelled(spark, folder)
    return sampling.stratified_kfold(policies, LABEL, key=_key(policies))


@query("d4_grown_sample")
def _(spark, folder):
    """A stored sample that takes the second half of the rows without reading the first again."""
    policies = order_policies(spark, folder)
    halves = [policies.filter(F.col("policy_id") % 2 == half) for half in (0, 1)]
    path = scratch_path(spark, "sample")
    write_sample(halves[0], path, 20_000, ROW_IDS, _key(halves[0]))
    extend_sample(halves[1], path, _key(halves[1]))
    return read_sample(spark, path)


@query("d4_sample_n")
def _(spark, folder):
    policies = order_policies(spark, folder)
    return sampling.sample_n(policies, 50_000, key=_key(policies)).select(ROW_IDS)


# --- model input --------------------------------------------------------------------------------


@query("e1_impute_median")
def _(spark, folder):
    rows = store(_features(spark, folder).select(*ROW_IDS, *NUMERIC))
    return _rounded(preparation.impute_median(rows, NUMERIC))


@query("e2_impute_mode")
def _(spark, folder):
    return preparation.impute_mode(_features(spark, folder), CATEGORICAL).select(*ROW_IDS, *CATEGORICAL)


@query("e3_one_hot")
def _(spark, folder):
    texts = _features(spark, folder).select(*ROW_IDS, *[F.col(c).cast("string") for c in CATEGORICAL])
    encoded = Pipeline(stages=preparation.one_hot_stages(CATEGORICAL)).fit(texts).transform(texts)
    slots = [
        (F.array_position(vector_to_array(c + preparation.ONE_HOT), 1.0) - 1).alias(f"{c}_slot") for c in CATEGORICAL
    ]
    return encoded.select(*ROW_IDS, *slots)


def _assembled(spark: SparkSession, folder: str) -> DataFrame:
    rows = store(_features(spark, folder))
    return Pipeline(stages=preparation.preparation_stages()).fit(rows).transform(rows)


def _vector_sums(df: DataFrame, column: str, suffix: str) -> list[Column]:
    values = vector_to_array(column)
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return [F.size(values).alias(f"width{suffix}"), F.round(total, 4).alias(f"total{suffix}")]


@query("e4_assemble")
def _(spark, folder):
    rows = _assembled(spark, folder)
    return rows.select(*ROW_IDS, *_vector_sums(rows, "features", ""))


@query("e5_fit_transform")
def _(spark, folder):
    """Preparation learned from the training rows only, applied to all rows."""
    rows = policy_features(_distinct(spark, folder))
    rows = store(select_features(cleaning.with_claim_label(rows), *ROW_IDS, LABEL))
    rows = store(sampling.stratified_split(rows, LABEL, key=_key(rows)))
    fitted = preparation.learn_preparation(rows.filter("split = 'train'"))[None]
    out = fitted.transform(rows)
    return out.select(*ROW_IDS, "split", *_vector_sums(out, "features", ""))


@query("e6_align_width")
def _(spark, folder):
    rows = _assembled(spark, folder).select(*ROW_IDS, "features")
    rows = preparation.align_width(rows, "features", 100, "wide")
    rows = preparation.align_width(rows, "features", len(NUMERIC), "narrow")
    return rows.select(*ROW_IDS, *_vector_sums(rows, "wide", "_wide"), *_vector_sums(rows, "narrow", "_narrow"))


# --- model --------------------------------------------------------------------------------------


# Order keys of the two splits, kept beside the rows: the passes of a split read them and don't hash the rows again.
SPLIT_KEY, FIT_KEY = "__split_key", "__fit_key"


@cache
def _train_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The train side of the distinct rows, with the order key of the next split."""
    rows = cleaning.with_claim_label(_distinct(spark, folder))
    rows = rows.withColumns({SPLIT_KEY: row_key(rows, ROW_IDS), FIT_KEY: row_key(rows, ROW_IDS, seed=1)})
    rows = store(select_features(policy_features(rows), *ROW_IDS, LABEL, SPLIT_KEY, FIT_KEY))
    split = sampling.stratified_split(rows, LABEL, key=F.col(SPLIT_KEY))
    return split.filter("split = 'train'").drop("split", SPLIT_KEY)


@cache
def _fit_rows(spark: SparkSession, folder: str, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """Fit rows, bounded by the training cap or drawn from the whole train side, and all other rows of that side."""
    max_rows = None if whole else TRAIN_ROWS_MAX
    parts = sampling.stratified_fit_split(_train_rows(spark, folder), LABEL, max_rows, key=F.col(FIT_KEY))
    fit, valid = (parts.filter(F.col("part") == part).drop("part", FIT_KEY) for part in ("fit", "valid"))
    # Fitting reads its rows many times, and should not look for them among all others.
    return store(fit) if whole else materialize(fit), valid


def _is_share(column: str) -> Column:
    return F.col(column).between(0, 1)


@cache
def _model(spark: SparkSession, folder: str):
    return boosting.train_boosted(_fit_rows(spark, folder)[0], PARAMS)


@cache
def _whole_model(spark: SparkSession, folder: str):
    """Fit on every row of the fit side, however many there are."""
    return boosting.train_boosted(_fit_rows(spark, folder, whole=True)[0], PARAMS)


@query("f1_class_weight")
def _(spark, folder):
    return _rounded(boosting.class_weight(cleaning.with_claim_label(_distinct(spark, folder))))


@query("f2_train_boosted")
def _(spark, folder):
    valid = _fit_rows(spark, folder, whole=True)[1]
    scored = boosting.predict_probability(_whole_model(spark, folder), valid)
    return scored.select(*ROW_IDS, LABEL, _is_share(boosting.PROBABILITY).alias("is_probability"))


@query("f3_tune")
def _(spark, folder):
    fit, valid = _fit_rows(spark, folder)
    grid = [replace(PARAMS, max_depth=depth) for depth in (3, 4)]
    _, params, value = boosting.tune(fit, valid, grid)
    sides = fit.select(F.lit("fit").alias("part"), LABEL).unionByName(valid.select(F.lit("valid").alias("part"), LABEL))
    counted = sides.groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(LABEL).alias("n_claims"))
    return counted.withColumn("found", F.lit(params in grid and 0 <= value <= 1))


@query("f4_predict_probability")
def _(spark, folder):
    scored = boosting.predict_probability(_model(spark, folder), _features(spark, folder))
    return scored.select(*ROW_IDS, _is_share(boosting.PROBABILITY).alias("is_probability"))


@query("f5_cross_validate")
def _(spark, folder):
    fit, valid = _fit_rows(spark, folder)
    rows = fit.unionByName(valid)
    folds = store(sampling.stratified_kfold(rows, LABEL, 5, key=_key(rows)))
    found = boosting.cross_validate(folds, THRESHOLD, PARAMS, 5, max_rows=TRAIN_ROWS_MAX, key=_key(rows))
    m = F.col("confusion_matrix")
    return found.select("fold", (m[0][0] + m[0][1]).alias("negatives"), (m[1][0] + m[1][1]).alias("positives"))


@query("f6_feature_importance")
def _(spark, folder):
    found = boosting.feature_importance(_whole_model(spark, folder), _features(spark, folder))
    return found.agg(F.count(F.lit(1)).alias("slots"), F.round(F.sum("importance"), DIGITS).alias("total"))


# --- aggregates and metrics ---------------------------------------------------------------------


@query("g1_claim_rate")
def _(spark, folder):
    policies = _labelled(spark, folder)
    return _rounded(metrics.claim_rate(sampling.stratified_split(policies, LABEL, key=_key(policies)), LABEL, ["split"]))


@query("g2_confusion_matrix")
def _(spark, folder):
    return metrics.confusion_matrix(scored_policies(spark, folder), "y", "p", THRESHOLD)


def _rate_by_sex(rate) -> Query:
    return lambda spark, folder: _rounded(rate(scored_policies(spark, folder), "y", "p", THRESHOLD, ["SEX"]))


for _name, _rate in [
    ("g3_accuracy", metrics.accuracy),
    ("g4_precision", metrics.precision),
    ("g5_recall", metrics.recall),
    ("g6_f1", metrics.f1),
]:
    query(_name)(_rate_by_sex(_rate))


@query("g7_roc_auc")
def _(spark, folder):
    return _rounded(metrics.roc_auc(scored_policies(spark, folder), "y", "p", ["SEX"]))


@query("g8_pr_auc")
def _(spark, folder):
    return _rounded(metrics.pr_auc(scored_policies(spark, folder), "y", "p", ["SEX"]))


@query("g9_evaluate")
def _(spark, folder):
    found = metrics.evaluate(scored_policies(spark, folder), "y", "p", THRESHOLD)
    m = F.col("confusion_matrix")
    cells = [m[i][j].alias(name) for i, j, name in [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]]
    return _rounded(found.select("*", *cells).drop("confusion_matrix"))


@query("g10_threshold_sweep")
def _(spark, folder):
    return _rounded(metrics.threshold_sweep(scored_policies(spark, folder), "y", "p"))


@query("g11_select_threshold")
def _(spark, folder):
    return _rounded(metrics.select_threshold(metrics.threshold_sweep(scored_policies(spark, folder), "y", "p")))


@query("g12_cv_summary")
def _(spark, folder):
    rows = store(_distinct_scored(spark, folder).select(*ROW_IDS, "y", "p"))
    folds = sampling.stratified_kfold(rows, "y", key=_key(rows))
    return _rounded(metrics.cv_summary(metrics.pr_auc(folds, "y", "p", ["fold"])))


@query("g13_model_comparison")
def _(spark, folder):
    models = F.array(
        F.struct(F.lit("leaning").alias("model"), F.col("p")), F.struct(F.lit("plain").alias("model"), F.col("u").alias("p"))
    )
    rows = scored_policies(spark, folder).select("y", F.inline(models))
    return _rounded(metrics.model_comparison(rows, "y", "p"))


@query("g14_percentile_cutoff")
def _(spark, folder):
    return _rounded(ranking.percentile_cutoff(scored_policies(spark, folder), "p", 15))


@query("g15_top_x_report")
def _(spark, folder):
    rows = _distinct_scored(spark, folder)
    return _rounded(ranking.top_x_report(rows, "y", "p", key=_key(rows)))


@query("g16_category_counts")
def _(spark, folder):
    return profiles.category_counts(order_policies(spark, folder), "MAKE")


@query("g17_distinct_codes")
def _(spark, folder):
    return profiles.distinct_codes(order_policies(spark, folder), "INSR_TYPE")


@query("g18_reference_profile")
def _(spark, folder):
    return profiles.reference_profile(order_policies(spark, folder))


@query("g19_prediction_summary")
def _(spark, folder):
    decided = scored_policies(spark, folder).select(decide_threshold(F.col("p"), THRESHOLD).alias("prediction"))
    return metrics.prediction_summary(decided)


@query("g20_all_policy_dates")
def _(spark, folder):
    return profiles.all_policy_dates(order_policies(spark, folder))


# --- decisions and scoring output ---------------------------------------------------------------


@query("h1_decide_threshold")
def _(spark, folder):
    rows = scored_policies(spark, folder)
    return rows.select(*ROW_IDS, decide_threshold(F.col("p"), THRESHOLD).alias("prediction"))


@query("h2_decide_top_pct")
def _(spark, folder):
    rows = scored_policies(spark, folder)
    return ranking.decide_top_pct(rows, "p", 10, key=_key(rows)).select(*ROW_IDS, "prediction")


@query("h3_decide_reference_cutoff")
def _(spark, folder):
    rows = scored_policies(spark, folder)
    decided = ranking.decide_reference_cutoff(rows, "p", rows, 10, key=_key(rows))
    return decided.select(*ROW_IDS, "prediction")


@query("h4_risk_label")
def _(spark, folder):
    return scored_policies(spark, folder).select(*ROW_IDS, risk_label(F.col("p")).alias("risk_level"))


def _decided(spark: SparkSession, folder: str) -> DataFrame:
    return scored_policies(spark, folder).withColumn("prediction", decide_threshold(F.col("p"), THRESHOLD))


@query("h5_actual_and_match")
def _(spark, folder):
    rows = decisions.actual_and_match(_decided(spark, folder))
    return rows.select(*ROW_IDS, "prediction", "actual_from_claim_paid", "prediction_match")


@query("h6_outcome_note")
def _(spark, folder):
    note = outcome_note(F.col("CLAIM_PAID"), F.col("prediction"))
    return _decided(spark, folder).select(*ROW_IDS, note.alias("outcome_note"))


@query("h7_preview")
def _(spark, folder):
    rows = _decided(spark, folder).select(*ROW_IDS, "prediction")
    return decisions.preview(rows, 20, [F.col(c) for c in ROW_IDS])


@query("h8_score_batch")
def _(spark, folder):
    scored = score_batch(_policies(spark, folder), _model(spark, folder), THRESHOLD)
    p, match = F.col(boosting.PROBABILITY), F.col("prediction") == F.col("actual_from_claim_paid")
    follows = (F.col("prediction") == (p >= THRESHOLD).cast("int")) & (F.col("risk_level") == risk_label(p)) & (F.col("prediction_match") == match)
    return scored.select(*ROW_IDS, *POLICY_COLUMNS, "actual_from_claim_paid", follows.alias("follows"))


@query("h8_score_batch_top_pct")
def _(spark, folder):
    rows = _policies(spark, folder)
    scored = score_batch(rows, _model(spark, folder), top_percent=10, key=_key(rows))
    p, flagged = F.col(boosting.PROBABILITY), F.col("prediction") == 1
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(flagged).alias("n_flagged"),
        (F.min(F.when(flagged, p)) >= F.max(F.when(~flagged, p))).alias("highest_flagged"),
    )


def _checked(scored: DataFrame) -> DataFrame:
    decided = F.col("prediction").isNotNull() & _is_share(boosting.PROBABILITY)
    return scored.select(*ROW_IDS, F.array_join("reasons", ",").alias("reasons"), decided.alias("decided"))


@query("h9_score_policies")
def _(spark, folder):
    rows = _policies(spark, folder)
    model = _whole_model(spark, folder)
    bounds = profiles.reference_profile(rows).first().asDict()
    return _checked(score_policies(rows, model, THRESHOLD, bounds))


@query("h9_score_policies_reference_cutoff")
def _(spark, folder):
    rows = _policies(spark, folder)
    model = _model(spark, folder)
    cutoff = score_cutoff(rows, model, 10, key=_key(rows))
    bounds = profiles.reference_profile(rows).first().asDict()
    return _checked(score_policies(rows, model, cutoff, bounds))
