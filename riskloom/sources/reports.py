"""JSON reports and thresholds."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.schema import DEFAULT_THRESHOLD

METRICS_TYPE = (
    "struct<threshold double, accuracy double, precision double, recall double, f1 double, "
    "roc_auc double, pr_auc double, confusion_matrix array<array<bigint>>>"
)
PARAMS_TYPE = (
    "struct<n_estimators int, max_depth int, learning_rate double, min_child_rows int, "
    "subsample double, feature_share double, seed int>"
)
REPORT_SCHEMA = (
    f"best_model string, best_params {PARAMS_TYPE}, target_min_recall double, selected_threshold double, "
    f"holdout {METRICS_TYPE}, cv_pr_auc_mean double, cv_pr_auc_std double, "
    f"cv_threshold_metrics array<{METRICS_TYPE}>, rows_train bigint, rows_test bigint, "
    "claim_rate_train double, claim_rate_test double"
)
TOP_X_SCHEMA = (
    "baseline struct<accuracy double, precision double, recall double, f1 double, threshold double, "
    "n_positive bigint, n_total bigint>, "
    "top_x_results array<struct<accuracy double, precision double, recall double, f1 double, top_pct double, "
    "k bigint, coverage double>>"
)


def _read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One report per file; no rows where there is no such path."""
    try:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A training report with the defaults a reader needs where a key is missing."""
    holdout = {
        m: F.coalesce(F.col(f"holdout.{m}"), F.lit(0.0)) for m in ("accuracy", "precision", "recall", "pr_auc")
    }
    report = _read_json(spark, path, REPORT_SCHEMA)
    return report.withColumns(
        {"best_model": F.coalesce("best_model", F.lit("n/a")), **{f"holdout_{m}": c for m, c in holdout.items()}}
    )


def read_top_x(spark: SparkSession, path: str) -> DataFrame:
    return _read_json(spark, path, TOP_X_SCHEMA)


def read_threshold(spark: SparkSession, path: str, default: float = DEFAULT_THRESHOLD) -> float:
    """The stored threshold; the default if the file, the key or the value is missing."""
    row = _read_json(spark, path, "threshold double").agg(F.max("threshold").alias("t")).first()
    return default if row.t is None else row.t


def write_report(df: DataFrame, path: str) -> None:
    """Nested rows as JSON, one object per line; a report is one row."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def metrics_struct():
    names = ["threshold", "accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc", "confusion_matrix"]
    return F.struct(*names)


def top_x_document(top_x: DataFrame, baseline: DataFrame) -> DataFrame:
    """One row: the fixed-threshold baseline and an array with one struct per percentage."""
    results = [{**row.asDict(), "top_pct": row.top_pct / 100} for row in top_x.orderBy("top_pct").collect()]
    document = {"baseline": baseline.first().asDict(), "top_x_results": results}
    return top_x.sparkSession.createDataFrame([document], TOP_X_SCHEMA)
