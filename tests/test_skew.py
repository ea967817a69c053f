"""Plans under a hot key: a third of all rows share it."""

import pytest
from pyspark.sql import functions as F

from riskloom.operators.cleaning import dedup
from riskloom.operators.metrics import evaluate, score_histogram, threshold_sweep
from riskloom.session import skew_safe

LOW_LIMITS = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def low_limits(spark):
    """Skew limits of a large cluster, scaled down to a small table."""
    skew_safe(spark)
    before = {k: spark.conf.get(k) for k in LOW_LIMITS}
    for k, v in LOW_LIMITS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_join_key_is_split_before_dedup(spark, low_limits):
    rows = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (F.col("id") % 9).alias("v")
    )
    keys = spark.range(300_000).select(F.col("id").alias("o"))
    distinct = dedup(rows.join(keys.hint("merge"), F.col("k") == F.col("o")))
    assert distinct.count() == 200_003
    assert "skew=true" in final_plan(distinct)


def test_hot_score_collapses_before_the_shuffle(spark):
    rows = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 90_000).alias("p"), (F.col("id") % 7 == 0).cast("int").alias("y")
    )
    hist = score_histogram(rows, "y", "p")
    assert hist.count() == 60_000 + 1
    assert hist.filter("score = 0.5").select(F.col("pos") + F.col("neg")).first()[0] >= 30_000
    plan = threshold_sweep(rows, "y", "p")._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Window" not in plan and "Join" not in plan
    found = evaluate(rows, "y", "p", 0.5).first()
    assert sum(map(sum, found.confusion_matrix)) == 90_000
