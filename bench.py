"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is computed to its last row without keeping the result. Batch scoring is also given in rows
per second and single-policy scoring in seconds, the two figures with a published baseline.
"""

from __future__ import annotations

import json
import os
import sys
import time

from riskloom.catalog.spark_queries import QUERIES
from riskloom.operators.boosting import BoostParams, train_boosted
from riskloom.operators.cleaning import dedup, with_claim_label
from riskloom.operators.features import policy_features, select_features
from riskloom.operators.sampling import stratified_sample
from riskloom.plans.scoring import SAMPLE_POLICY, score_batch, score_policies
from riskloom.schema import LABEL, POLICY_COLUMNS, TRAIN_ROWS_MAX
from riskloom.session import local_session, materialize, skew_safe
from riskloom.sources.order_policies import ROW_IDS, order_policies

HEADLINE = [
    "flagship_claim_rate_by_vehicle",
    "b1_dedup",
    "b5_select_features",
    "b6_validate_policies",
    "d1_stratified_split",
    "d2_stratified_sample",
    "d3_stratified_kfold",
    "e1_impute_median",
    "e2_impute_mode",
    "g9_evaluate",
    "g10_threshold_sweep",
    "g13_model_comparison",
    "g14_percentile_cutoff",
    "g15_top_x_report",
    "g16_category_counts",
    "g18_reference_profile",
    "h2_decide_top_pct",
    "h3_decide_reference_cutoff",
]
# The tuned model's number of rounds, as scoring time depends on it.
ROUNDS = int(os.environ.get("BENCH_ROUNDS", "200"))


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = skew_safe(local_session(os.environ.get("BENCH_CPUS", "8"), "bench"))
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["b2_claim_label"](spark, folder))  # starts the executor threads and the file cache

    seconds = {name: timed(lambda: run(QUERIES[name](spark, folder))) for name in HEADLINE}

    policies = order_policies(spark, folder).select(*ROW_IDS, *POLICY_COLUMNS)
    rows = select_features(policy_features(with_claim_label(dedup(policies))), LABEL)
    sample = materialize(stratified_sample(rows, LABEL, TRAIN_ROWS_MAX))
    fitted = []
    seconds["f2_train_boosted"] = timed(
        lambda: fitted.append(train_boosted(sample, BoostParams(n_estimators=ROUNDS)))
    )
    uploaded = materialize(policies)
    count = uploaded.count()
    seconds["h8_score_batch"] = timed(lambda: run(score_batch(uploaded, fitted[0])))
    single = min(timed(lambda: score_policies([SAMPLE_POLICY], fitted[0], spark=spark).collect()) for _ in range(5))
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "rounds": ROUNDS,
                "scored_rows": count,
                "scored_rows_per_sec": round(count / seconds["h8_score_batch"]),
                "single_policy_sec": single,
            }
        )
    )
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
