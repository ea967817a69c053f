import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import ordering
from riskloom.operators.ordering import assign_segments, cumulate, row_key
from riskloom.operators.ranking import decide_reference_cutoff, decide_top_pct, percentile_cutoff, top_segments, top_x_report
from riskloom.operators.sampling import (
    fold_quotas, sample_n, sample_quotas, split_quotas, stratified_fit_split, stratified_kfold, stratified_sample, stratified_split,
)
from riskloom.operators import selection
from riskloom.operators.selection import exact_quantiles
from riskloom.session import materialize


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_across_buckets(spark, many_buckets, descending):
    rng = random.Random(1)
    rows = [(g, v, rng.randrange(9)) for g in ("a", None) for v in rng.sample(range(1000), 60)]
    df = materialize(spark.createDataFrame([(g, float(v), n) for g, v, n in rows], "g string, v double, n long"))
    found = {(r.g, r.v): r.cum_n for r in cumulate(df, "v", ["n"], by=["g"], descending=descending).collect()}
    assert len(found) == len(rows)
    for g, v, _ in rows:
        before = [n for h, w, n in rows if h == g and (w >= v if descending else w <= v)]
        assert found[g, float(v)] == sum(before)


def test_no_window_over_all_rows(spark, many_buckets):
    """Beyond the size limit the running sum is partitioned by bucket."""
    df = materialize(spark.range(500).select(F.col("id").cast("double").alias("v"), F.lit(1).alias("n")))
    plan = cumulate(df, "v", ["n"])._jdf.queryExecution().optimizedPlan().toString()
    assert "__bucket" in plan and plan.count("Window") == 2


@pytest.mark.parametrize("buckets", [False, True])
@pytest.mark.parametrize("q", [Fraction(1, 2), Fraction(0), Fraction(1), Fraction(85, 100)])
def test_quantiles(spark, request, buckets, q):
    if buckets:
        request.getfixturevalue("many_buckets")
    rng = np.random.default_rng(3)
    plain, tied = rng.normal(size=301), rng.integers(0, 4, size=301).astype(float)
    rows = [(float(a), float(b) if i % 3 else None, None) for i, (a, b) in enumerate(zip(plain, tied))]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    found = exact_quantiles(df, {c: F.col(c) for c in "abc"}, q)
    assert found["a"] == pytest.approx(np.quantile(plain, float(q)))
    assert found["b"] == pytest.approx(np.quantile([r[1] for r in rows if r[1] is not None], float(q)))
    assert found["c"] is None


def test_median_takes_the_midpoint(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 10)], "v double")
    assert exact_quantiles(df, {"v": F.col("v")}, Fraction(1, 2)) == {"v": 2.5}


def test_quantile_outside_a_wrong_bracket(spark, monkeypatch):
    monkeypatch.setattr(selection, "_sketch", lambda c, levels: F.any_value(F.array(F.lit(1e6), F.lit(2e6))))
    df = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    assert exact_quantiles(df, {"v": F.col("v")}, Fraction(1, 2)) == {"v": 5.0}


def test_row_key_separates_rows(spark):
    rows = [("a", "b"), ("ab", ""), ("a", None), (None, "a"), ("a|b", "c"), ("a", "b|c"), ('a","y":"b', None)]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(row_key(df)).distinct().count() == len(rows)


def by_key(df, key, k):
    return [r[0] for r in df.select(key.alias("k")).orderBy("k").limit(k).collect()]


def test_segments_of_distinct_rows(spark, many_buckets):
    df = spark.range(5000).withColumn("g", (F.col("id") % 3).cast("string"))
    key = row_key(df, ["id"])
    out = assign_segments(df, key, F.col("g"), lambda sizes: {s: [0, 100, 100, n] for s, n in sizes.items()})
    rows = out.withColumn("k", key).collect()
    assert len(rows) == 5000
    for g in "012":
        inside = sorted((r.k, r.segment) for r in rows if r.g == g)
        assert [s for _, s in inside] == [1] * 100 + [3] * (len(inside) - 100)


def test_hot_copies_are_dealt_exactly(spark, monkeypatch):
    """A third of the rows is one row repeated; the slice ends fall within its copies."""
    monkeypatch.setattr(ordering, "COPIES_PER_TASK", 50)
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"), F.lit(None).cast("string").alias("w"))
    rank = by_key(df, row_key(df), 3000)
    hot = df.filter("v = 7").select(row_key(df)).first()[0]
    first = rank.index(hot)
    ends = [first + 10, first + 400]
    out = assign_segments(df, row_key(df), F.lit("all"), lambda sizes: {"all": ends})
    counts = Counter((r.segment, r.v == 7) for r in out.collect())
    assert [sum(n for (s, _), n in counts.items() if s == i) for i in range(3)] == [ends[0], 390, 3000 - ends[1]]
    assert counts[0, True] == 10 and counts[1, True] == 390
    assert Counter(r.v for r in out.collect()) == Counter(r.v for r in df.collect())


def test_shared_key_of_different_rows_is_refused(spark):
    df = spark.range(10).withColumn("g", F.lit(1))
    with pytest.raises(ValueError, match="not copies"):
        sample_n(df, 3, key=row_key(df, ["g"])).count()


def test_published_split_and_fold_sizes():
    """Row counts printed by the published training run follow from the quota rules."""
    negatives, positives = 801_838 - 60_104, 60_104
    assert split_quotas({"0": negatives, "1": positives}, 0.2) == {"0": 148_347, "1": 12_021}
    train = {"0": negatives - 148_347, "1": positives - 12_021}
    assert sample_quotas(train, 30_000) == {"0": 27_751, "1": 2_249}
    assert fold_quotas({"0": 27_751, "1": 2_249}, 5) == {"0": [5551, 5550, 5550, 5550, 5550], "1": [449, 450, 450, 450, 450]}
    fit = {s: n - t for (s, n), t in zip({"0": 27_751, "1": 2_249}.items(), split_quotas({"0": 27_751, "1": 2_249}, 0.2).values())}
    assert sum(fit.values()) == 24_000 and fit["0"] / fit["1"] == pytest.approx(12.340744858254586)


def test_split_sample_and_folds(spark):
    df = spark.range(1003).withColumn("CLAIM", (F.col("id") % 10 == 0).cast("int"))
    split = stratified_split(df, "CLAIM")
    counts = {(r.CLAIM, r.split): r["count"] for r in split.groupBy("CLAIM", "split").count().collect()}
    assert counts == {(0, "test"): 181, (0, "train"): 721, (1, "test"): 20, (1, "train"): 81}
    assert split.orderBy("id").collect() == stratified_split(df, "CLAIM").orderBy("id").collect()
    assert split.filter("split = 'test'").join(stratified_split(df, "CLAIM", seed=7).filter("split = 'test'"), "id").count() < 100
    sample = Counter(r.CLAIM for r in stratified_sample(df, "CLAIM", 100).collect())
    assert sample == {0: round(100 / 1003 * 902), 1: round(100 / 1003 * 101)}
    assert stratified_sample(df, "CLAIM", 2000).count() == 1003
    folds = Counter(r.fold for r in stratified_kfold(df, "CLAIM").collect())
    assert sorted(folds.values()) == [200, 200, 201, 201, 201] and set(folds) == set(range(5))


def test_single_class_and_empty_input(spark):
    df = spark.range(10).withColumn("CLAIM", F.lit(0))
    assert stratified_split(df, "CLAIM").filter("split = 'test'").count() == 2
    empty = df.limit(0)
    assert stratified_split(empty, "CLAIM").count() == 0
    assert sample_n(empty, 5).count() == 0
    assert decide_top_pct(empty.withColumn("p", F.lit(0.5)), "p", 10).count() == 0


@pytest.mark.parametrize("n", [0, 1, 99, 100, 500])
def test_sample_n(spark, n):
    df = spark.range(100)
    rows = [r.id for r in sample_n(df, n).collect()]
    assert len(rows) == len(set(rows)) == min(n, 100)


@pytest.mark.parametrize("percent", [1, 10, 33, 50])
def test_top_pct_is_exact_with_a_hot_score(spark, many_buckets, percent):
    """A third of the rows share one score."""
    df = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, 0.8).otherwise(F.col("id") / 600).alias("p"))
    out = decide_top_pct(df, "p", percent).collect()
    chosen = [r for r in out if r.prediction]
    assert len(out) == 600 and len(chosen) == 600 * percent // 100
    assert min(r.p for r in chosen) >= max(r.p for r in out if not r.prediction)


def test_top_pct_takes_at_least_one(spark):
    df = spark.createDataFrame([(1, 0.2), (2, 0.9), (3, None)], "id int, p double")
    assert [r.id for r in decide_top_pct(df, "p", 10).collect() if r.prediction] == [2]


def test_top_segments_with_copies(spark):
    df = spark.range(90).select(F.lit("x").alias("v"), F.lit(0.5).alias("p"))
    out = top_segments(df, "p", [11, 50], lambda n, percent: {11: 10, 50: 45}[percent])
    assert Counter(r.segment for r in out.collect()) == {0: 10, 1: 35, 2: 45}


def test_top_x_counts_published():
    assert [647_629 * x // 100 for x in (10, 15, 20)] == [64_762, 97_144, 129_525]


def test_top_x_report(spark):
    rng = random.Random(5)
    rows = [(i, round(rng.random(), 3), int(rng.random() < 0.1)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, p double, y int")
    ranked = sorted(rows, key=lambda r: -r[1])
    for r in top_x_report(df, "y", "p", [10, 20]).collect():
        k = 1000 * r.top_pct // 100
        least = ranked[k - 1][1]
        sure = sum(y for _, p, y in rows if p > least)
        most = sum(y for _, p, y in rows if p >= least)
        assert r.k == k and r.coverage == k / 1000
        assert sure <= round(r.precision * k) <= most


def test_percentile_cutoff(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 10.0)], "p double")
    assert percentile_cutoff(df, "p", 10).first().cutoff == pytest.approx(7.9)
    assert percentile_cutoff(df.limit(0), "p", 10).first().cutoff is None


def test_reference_cutoff_needs_scores(spark):
    df = spark.createDataFrame([(0.2,), (0.9,)], "p double")
    assert [r.prediction for r in decide_reference_cutoff(df, "p", df, 10).orderBy("p").collect()] == [0, 1]
    with pytest.raises(ValueError, match="no reference scores"):
        decide_reference_cutoff(df, "p", df.limit(0), 10)


@pytest.mark.parametrize("descending", [False, True])
def test_missing_values_rank_alike_at_every_size(spark, monkeypatch, descending):
    values = [(None, 3), (float("nan"), 5), *((float(v), 1) for v in range(40))]
    df = materialize(spark.createDataFrame(values, "v double, n long").repartition(3))
    found = []
    for size in (7, 1_000_000):
        monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", size)
        found.append(sorted((str(r.v), r.cum_n) for r in cumulate(df, "v", ["n"], descending=descending).collect()))
    assert found[0] == found[1]


def test_many_strata_and_fit_rows(spark):
    df = spark.range(3000).select("id", (F.col("id") % 150).alias("label"))
    split = stratified_split(df, "label", 0.2).groupBy("label").agg(F.count_if(F.col("split") == "test").alias("n")).collect()
    assert len(split) == 150 and {r.n for r in split} == {4}
    two = df.select("id", (F.col("id") % 2).alias("label"))
    parts = {r.part: r["count"] for r in stratified_fit_split(two, "label", 1000, 0.2).groupBy("part").count().collect()}
    assert parts == {"fit": 800, "valid": 2200}
    assert stratified_fit_split(two, "label", None, 0.2).filter("part = 'fit'").count() == 2400
    assert stratified_fit_split(two.limit(0), "label", 10).count() == 0
