"""Exact ranks by sketches and counts: all sizes of brackets, groups, ties; shared preparation; stored samples."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import boosting, selection
from riskloom.operators.boosting import PROBABILITY, BoostParams, cross_validate, predict_probability, train_boosted, tune
from riskloom.operators.ordering import row_key
from riskloom.operators.preparation import learn_preparation, medians, preparation_stages
from riskloom.operators.ranking import percentile_cutoff_value, top_segments
from riskloom.operators.reference import draw_sample, extend_sample, read_sample, write_sample
from riskloom.operators.sampling import sample_n, stratified_sample, stratified_split
from riskloom.operators.selection import Target, exact_quantiles, select_ranks
from riskloom.schema import CATEGORICAL, FEATURES, LABEL, NUMERIC
from riskloom.session import materialize


@pytest.fixture
def few_values(monkeypatch):
    """So few values may come to the driver that brackets are narrowed again and again."""
    monkeypatch.setattr(selection, "VALUES_KEPT", 3)


def _numbers(spark, n=4000):
    rng = np.random.default_rng(8)
    hot = np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n).round(2) * 10)
    rows = [(i % 3, float(a), float(b), None if i % 5 else float(i), float("nan")) for i, (a, b) in enumerate(zip(rng.exponential(size=n), hot))]
    return materialize(spark.createDataFrame(rows, "g int, a double, hot double, gaps double, no double")), rows


@pytest.mark.parametrize("q", [Fraction(0), Fraction(1, 2), Fraction(9, 10), Fraction(1)])
def test_quantiles_of_many_columns_in_narrow_brackets(spark, few_values, q):
    df, rows = _numbers(spark)
    found = exact_quantiles(df, {c: F.col(c) for c in ("a", "hot", "gaps", "no")}, q)
    for i, c in enumerate(("a", "hot", "gaps"), 1):
        assert found[c] == pytest.approx(np.quantile([r[i] for r in rows if r[i] is not None], float(q)))
    assert found["no"] is None


@pytest.mark.parametrize("kept", [3, 10_000])
def test_quantiles_by_group(spark, monkeypatch, kept):
    monkeypatch.setattr(selection, "VALUES_KEPT", kept)
    df, rows = _numbers(spark, 900)
    df = df.unionByName(spark.createDataFrame([(None, 4.0, None, None, None)], df.schema))
    found = exact_quantiles(df, {c: F.col(c) for c in ("a", "hot", "no")}, Fraction(1, 2), ["g"])
    assert set(found) == {(0,), (1,), (2,), (None,)}
    for g in range(3):
        for i, c in ((1, "a"), (2, "hot")):
            assert found[(g,)][c] == pytest.approx(np.median([r[i] for r in rows if r[0] == g]))
        assert found[(g,)]["no"] is None
    assert found[(None,)] == {"a": 4.0, "hot": None, "no": None}


def test_ranks_tell_how_many_are_less_and_equal(spark, few_values):
    df, rows = _numbers(spark, 1000)
    values = sorted(r[2] for r in rows)
    targets = [Target(x, lambda n, x=x: [int(n * x)]) for x in (0.1, 0.5, 0.8)]
    for search, x in zip(select_ranks(df, {"hot": F.col("hot")}, targets)[()]["hot"], (0.1, 0.5, 0.8)):
        at = search.found[int(1000 * x)]
        assert at.value == values[int(1000 * x)]
        assert (at.less, at.equal) == (sum(v < at.value for v in values), values.count(at.value))


def test_a_useless_sketch_is_an_error_not_a_wrong_value(spark, few_values, monkeypatch):
    monkeypatch.setattr(selection, "_sketch", lambda c, levels: F.any_value(F.array(*[F.lit(1e6)] * len(levels))))
    df, _ = _numbers(spark, 100)
    with pytest.raises(RuntimeError, match="misses ranks"):
        exact_quantiles(df, {"a": F.col("a")}, Fraction(1, 2))


def test_medians_take_no_row_a_cell(spark):
    """Every pass is one aggregate over the rows: nothing is expanded or generated."""
    df, _ = _numbers(spark, 50)
    plans = []
    real = type(df).groupBy

    def spy(self, *cols):
        grouped = real(self, *cols)
        agg = grouped.agg
        grouped.agg = lambda *a: (plans.append(made := agg(*a)), made)[1]
        return grouped

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(df), "groupBy", spy)
        medians(df, ["a", "hot", "gaps"])
    texts = [p._jdf.queryExecution().optimizedPlan().toString() for p in plans]
    assert texts and not any(node in t for t in texts for node in ("Expand", "Generate", "Join"))


def test_approximate_cutoff(spark):
    df = spark.range(100_000).select((F.col("id") / 100_000).alias("p"))
    assert percentile_cutoff_value(df, "p", 10, approximate=True) == pytest.approx(0.9, abs=0.002)
    assert percentile_cutoff_value(df.limit(0), "p", 10, approximate=True) is None


def test_top_scores_are_found_without_a_shuffle_of_scores(spark):
    df = spark.range(5000).select("id", F.rand(3).alias("p"))
    out = top_segments(materialize(df), "p", [10], lambda n, x: n * x // 100)
    assert "Exchange hashpartitioning(__score" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.filter("segment = 0").count() == 500


def test_a_hundred_strata_make_no_larger_plan_than_two(spark):
    sizes = []
    for k in (2, 100):
        df = spark.range(2000).select("id", (F.col("id") % k).alias("label"))
        plan = stratified_split(df, "label", 0.25)
        assert plan.filter("split = 'test'").count() == 500
        sizes.append(len(plan._jdf.queryExecution().analyzed().toString()))
    assert sizes[1] < sizes[0] * 1.2


def test_samples_by_group_are_those_of_each_group(spark):
    df = materialize(spark.range(3000).select("id", (F.col("id") % 3).alias("g"), (F.col("id") % 2).alias("label")))
    both = stratified_sample(df, "label", 101, key=row_key(df, ["id"]), by="g")
    for g in range(3):
        own = df.filter(F.col("g") == g)
        alone = {r.id for r in stratified_sample(own, "label", 101, key=row_key(own, ["id"])).collect()}
        assert {r.id for r in both.filter(F.col("g") == g).collect()} == alone


# --- stored samples ---------------------------------------------------------------------------------


def _ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize("n", [0, 1, 60, 3000])
def test_drawn_sample_equals_sample_n(spark, n):
    df = spark.range(2000).withColumn("more", F.lit("x"))
    drawn = draw_sample(df, n, ["id"], row_key(df, ["id"]))
    assert _ids(drawn) == _ids(sample_n(df, n, key=row_key(df, ["id"]))) and drawn.columns == ["id"]


def test_drawn_sample_of_hot_copies(spark):
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("id"))
    assert _ids(draw_sample(df, 500)) == _ids(sample_n(df, 500))
    assert draw_sample(df.limit(0), 5).count() == 0


def test_stored_sample_takes_new_rows_without_the_old_ones(spark, tmp_path):
    path, key = str(tmp_path / "sample"), lambda df: row_key(df, ["id"])
    parts = [spark.range(0, 30), spark.range(30, 1000), spark.range(1000, 1000), spark.range(1000, 1500)]
    write_sample(parts[0], path, 100, key=key(parts[0]))
    seen = parts[0]
    assert _ids(read_sample(spark, path)) == _ids(seen)
    for part in parts[1:]:
        extend_sample(part, path, key(part))
        seen = seen.union(part)
        assert _ids(read_sample(spark, path)) == _ids(sample_n(seen, 100, key=key(seen)))
    # A version without its state is not there yet.
    spark.range(3).write.parquet(f"{path}/{9:08d}/rows")
    assert _ids(read_sample(spark, path)) == _ids(sample_n(seen, 100, key=key(seen)))


# --- shared preparation -----------------------------------------------------------------------------


def _policies(spark, n=600):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(n):
        texts = [None if rng.random() < 0.1 else f"{c}{rng.integers(0, 4 + k)}" for k, c in enumerate(CATEGORICAL[2:])]
        numbers = [None if rng.random() < 0.1 else round(float(rng.normal()), 2) for _ in NUMERIC]
        rows.append((i, i % 3, int(numbers[0] is not None and numbers[0] > 0.5), int(i % 2), int(rng.integers(0, 3)), *texts, *numbers))
    columns = ", ".join([f"{c} string" for c in CATEGORICAL[2:]] + [f"{c} double" for c in NUMERIC])
    df = spark.createDataFrame(rows, f"id int, fold int, {LABEL} int, SEX int, INSR_TYPE int, {columns}")
    return materialize(df.select("id", "fold", LABEL, *FEATURES))


def _matrix(df):
    return df.select("id", vector_to_array("features").alias("v")).orderBy("id").collect()


def test_groups_learn_what_they_would_alone(spark):
    df = _policies(spark).withColumn("TYPE_VEHICLE", F.when(F.col("fold") != 2, F.col("TYPE_VEHICLE")))
    together = learn_preparation(df, "fold")
    assert set(together) == {0, 1, 2}
    for g, stages in together.items():
        own = df.filter(F.col("fold") == g)
        alone = Pipeline(stages=preparation_stages()).fit(own)
        assert _matrix(stages.transform(df)) == _matrix(alone.transform(df))
    whole = Pipeline(stages=preparation_stages()).fit(df)
    assert _matrix(learn_preparation(df)[None].transform(df)) == _matrix(whole.transform(df))


def test_candidates_share_one_preparation(spark, monkeypatch):
    learned = []
    real = boosting.learn_preparation
    monkeypatch.setattr(boosting, "learn_preparation", lambda *a: (learned.append(1), real(*a))[1])
    df = _policies(spark)
    fit, valid = df.filter("fold < 2"), df.filter("fold = 2")
    grid = [BoostParams(n_estimators=n, max_depth=2) for n in (1, 6, 6)]
    model, params, value = tune(fit, valid, grid)
    assert len(learned) == 1 and value > 0.8
    assert params is grid[1] or params is grid[0]
    alone = train_boosted(fit, params)
    assert alone.stages[-1].toDebugString.split("\n")[1:] == model.stages[-1].toDebugString.split("\n")[1:]


def test_candidates_score_validation_rows_in_one_pass(spark, monkeypatch):
    """Before, the vectors of all validation rows were kept and each candidate read them again."""
    kept, ranked = [], []
    keep, rank = boosting.materialize, boosting.pr_auc
    monkeypatch.setattr(boosting, "materialize", lambda df: (kept.append(df), keep(df))[1])
    monkeypatch.setattr(boosting, "pr_auc", lambda *a: (ranked.append(a), rank(*a))[1])
    df = _policies(spark)
    fit, valid = df.filter("fold < 2"), df.filter("fold = 2")
    grid = [BoostParams(n_estimators=n, max_depth=2) for n in (1, 6)]
    _, params, value = tune(fit, valid, grid)
    assert [rows.count() for rows in kept] == [fit.count()] and len(ranked) == 1
    alone = [rank(predict_probability(train_boosted(fit, p), valid), LABEL, PROBABILITY).first().pr_auc for p in grid]
    assert value == pytest.approx(max(alone)) and params is grid[alone.index(max(alone))]
    assert tune(fit, valid.limit(0), grid[:1])[2] == 0.0


def test_folds_learn_in_the_same_passes_and_score_every_row(spark, monkeypatch):
    learned = []
    real = boosting.learn_preparation
    monkeypatch.setattr(boosting, "learn_preparation", lambda *a: (learned.append(1), real(*a))[1])
    df = _policies(spark)
    params = BoostParams(n_estimators=5, max_depth=2)
    for max_rows in (None, 200):
        found = {r.fold: r for r in cross_validate(df, 0.5, params, 3, max_rows=max_rows, key=row_key(df, ["id"])).collect()}
        assert set(found) == {0, 1, 2}
        assert all(sum(map(sum, r.confusion_matrix)) == 200 and r.roc_auc > 0.8 for r in found.values())
    assert len(learned) == 2
