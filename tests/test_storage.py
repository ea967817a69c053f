"""Rows kept as columns, and shuffles cut by the size of the tables."""

import pytest
from pyspark.sql import functions as F

from riskloom import session
from riskloom.catalog import spark_queries
from riskloom.operators.preparation import learn_preparation
from riskloom.session import cut_for, skew_safe, store
from riskloom.sources.order_policies import order_policies

CUTS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
LEAST = "spark.sql.adaptive.coalescePartitions.minPartitionNum"


@pytest.fixture
def own_cuts(spark):
    yield
    spark.conf.unset(CUTS)


def test_stored_rows_are_whole_and_read_by_column(spark):
    odd = "id", "cast('NaN' as double) AS n", "-0.0D AS z", "cast(null as date) AS d", "'' AS empty", "array(id) AS many"
    rows = spark.range(7).selectExpr(*odd)
    kept = store(rows)
    assert kept.dtypes == rows.dtypes and list(map(str, kept.orderBy("id").collect())) == list(map(str, rows.orderBy("id").collect()))
    plan = kept.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan


def test_rows_that_parquet_refuses_are_kept_too(spark):
    assert store(spark.range(2).select("id", F.lit(None).alias("nothing"))).count() == 2
    assert store(spark.range(2).select("id", F.lit(1).alias("ID"))).count() == 2


def test_shuffles_are_cut_by_rows(spark, folder, own_cuts, monkeypatch):
    cut_for(spark, 1)
    assert spark.conf.get(CUTS) == spark.conf.get("spark.sql.shuffle.partitions")
    cut_for(spark, 400_000_001)
    assert spark.conf.get(CUTS) == "2001"
    monkeypatch.setattr(session, "ROWS_PER_CUT", 100)
    order_policies(skew_safe(spark), folder)
    assert int(spark.conf.get(CUTS)) == -(-spark.read.parquet(f"{folder}/lineitem.parquet").count() // 100)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_parts_put_together_hold_few_rows(spark, folder, own_cuts, monkeypatch):
    """However few bytes the rows take in a shuffle; before, 16 MB of them came together."""
    others = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1", CUTS: "400", "spark.sql.shuffle.partitions": "400"}
    before = {name: spark.conf.get(name, None) for name in others}
    try:
        for name, value in others.items():
            spark.conf.set(name, value)
        monkeypatch.setattr(session, "ROWS_PER_CUT", 100)
        rows = spark_queries._distinct(skew_safe(spark), folder)
        held = rows.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert held <= 500 < rows.count() / 8
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
        spark.conf.unset(LEAST)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_the_top_share_reads_scores_and_not_rows(spark, folder, monkeypatch):
    """Ranks are looked for in stored columns; before, each pass read whole checkpointed rows."""
    from riskloom.plans import scoring

    seen = []
    decide = scoring.decide_top_pct
    monkeypatch.setattr(scoring, "decide_top_pct", lambda df, *rest: seen.append(df) or decide(df, *rest))
    monkeypatch.setattr(scoring, "score_probability", lambda df, *_: df.withColumn(scoring.PROBABILITY, F.rand(1)))
    rows = order_policies(spark, folder).select(*spark_queries.ROW_IDS, *spark_queries.POLICY_COLUMNS)
    scored = scoring.score_batch(rows, None, top_percent=10, key=spark_queries._key(rows))
    assert scored.filter("prediction = 1").count() == rows.count() // 10
    plan = seen[0].select(scoring.PROBABILITY)._jdf.queryExecution().executedPlan().toString()
    assert f"ReadSchema: struct<{scoring.PROBABILITY}:double>" in plan


def test_preparation_learns_from_stored_splits_alike(spark, folder):
    """The fitted stages of `e5` equal those that fitting the pipeline gives."""
    from pyspark.ml import Pipeline

    from riskloom.operators.preparation import preparation_stages

    rows = store(spark_queries._features(spark, folder).limit(500))
    learned, fitted = learn_preparation(rows)[None], Pipeline(stages=preparation_stages()).fit(rows)
    a, b = (m.transform(rows).select(*spark_queries.ROW_IDS, "features").collect() for m in (learned, fitted))
    assert sorted(map(str, a)) == sorted(map(str, b))
