"""The trees as one expression: equal to the fitted stages, for any tree, and without a job for a few rows."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import boosting
from riskloom.operators.boosting import BoostParams, predict_probability, train_boosted
from riskloom.operators.features import policy_features, select_features
from riskloom.operators.forest import Forest, _margins, _masks, dense_vectors, forest_of, forest_probability
from riskloom.plans import scoring
from riskloom.plans.scoring import SAMPLE_POLICY, score_policies
from riskloom.schema import LABEL
from riskloom.session import materialize
from riskloom.sources.models import load_model, save_model
from riskloom.sources.order_policies import order_policies


@pytest.fixture(scope="module")
def rows(spark, folder):
    policies = order_policies(spark, folder)
    size = F.coalesce(F.col("PREMIUM"), F.lit(0.0)) + F.crc32(F.coalesce("MAKE", F.lit(""))) % 2000
    label = (size + F.coalesce(F.col("INSURED_VALUE"), F.lit(0.0)) % 900 > 2800).cast("int")
    return materialize(select_features(policy_features(policies.withColumn(LABEL, label)), LABEL).limit(3000))


@pytest.fixture(scope="module")
def model(rows):
    return train_boosted(rows, BoostParams(n_estimators=12, max_depth=5))


def test_expression_equals_the_stages(rows, model):
    odd = rows.withColumn("MAKE", F.when(F.rand(1) < 0.2, "never seen").when(F.rand(2) < 0.2, "").otherwise(F.col("MAKE")))
    scored = predict_probability(model, odd)
    both = scored.withColumn("again", forest_probability(forest_of(model), scored))
    gap = both.agg(F.max(F.abs(F.col("again") - F.col("probability_claim"))), F.count_if(F.col("again").isNull())).first()
    assert gap[0] < 1e-12 and gap[1] == 0
    assert both.select("again").distinct().count() > 10


def test_batches_equal_the_stages(rows, model):
    odd = rows.withColumn("MAKE", F.when(F.crc32("MAKE") % 3 == 0, "never seen").when(F.crc32("MAKE") % 3 == 1, "").otherwise(F.col("MAKE")))
    odd = odd.withColumn("PREMIUM", F.when(F.col("PREMIUM") > 1500, float("nan")).when(F.col("PREMIUM") < 500, float("inf")).otherwise(F.col("PREMIUM")))
    both = model.transform(predict_probability(model, materialize(odd)))
    gap = both.agg(F.max(F.abs(vector_to_array("probability")[1] - F.col("probability_claim"))), F.count("probability_claim")).first()
    assert gap[0] < 1e-12 and gap[1] == rows.count()


@pytest.mark.parametrize("slots", [0, 1000])
def test_dense_vectors_equal_the_stages(rows, model, monkeypatch, slots):
    """Rows' vectors have room for each slot; before, a tree's node searched a sparse one. Models of too many slots keep the stages."""
    odd = rows.withColumn("MAKE", F.when(F.crc32("MAKE") % 3 == 0, "never seen").when(F.crc32("MAKE") % 3 == 1, "").otherwise(F.col("MAKE")))
    odd = materialize(odd.withColumn("PREMIUM", F.when(F.col("PREMIUM") > 1500, float("nan")).otherwise(F.col("PREMIUM"))))
    monkeypatch.setattr(boosting, "DENSE_SLOTS", slots)
    made = []
    monkeypatch.setattr(boosting, "dense_vectors", lambda *a: (made.append(a), dense_vectors(*a))[1])
    scored = boosting.stage_probability(model, odd)
    assert scored.columns == [*odd.columns, "probability_claim"]
    assert len(made) == (slots > 0)
    both = model.transform(scored)
    assert both.filter(vector_to_array("probability")[1] == F.col("probability_claim")).count() == rows.count()


def test_dense_vectors_take_the_width_of_the_model(spark):
    forest = Forest(["p"], [7.0], ["m", "u"], ["b", "x"], [["a", "b"], ["x"]])
    df = spark.createDataFrame([(1.0, "a", "x"), (None, None, "zzz"), (2.0, "zzz", "")], "p double, m string, u string")
    whole = [[1.0, 1.0, 0.0, 1.0], [7.0, 0.0, 1.0, 0.0], [2.0, 0.0, 0.0, 1.0]]
    for width in (2, 4, 6):
        found = [list(r[0].toArray()) for r in dense_vectors(forest, df, width, "v").select("v").collect()]
        assert found == [(row + [0.0, 0.0])[:width] for row in whole]


def test_a_plan_walks_the_trees_once_a_row(spark, folder, model):
    scored = score_policies(order_policies(spark, folder), model, 0.4)
    checked = scored.select("prediction", F.col("probability_claim").between(0, 1), "risk_level", "outcome_note", "reasons")
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "UDF(UDF(" not in plan


def test_a_batch_plan_walks_the_trees_once_a_row(spark, folder, model):
    plan = scoring.score_batch(order_policies(spark, folder), model, 0.4)._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.count("UDF(UDF(") for line in plan.split("\n")) == 1


def test_single_leaf_and_stored_models(spark, rows, tmp_path):
    model = train_boosted(rows.withColumn(LABEL, F.lit(0)), BoostParams(n_estimators=2))
    scored = predict_probability(model, rows.limit(5))
    assert scored.select(F.abs(forest_probability(forest_of(model), scored) - F.col("probability_claim")).alias("d")).agg(F.max("d")).first()[0] < 1e-12
    save_model(model, str(tmp_path / "m"))
    assert forest_of(load_model(str(tmp_path / "m"))).value == forest_of(model).value


def test_a_split_it_cannot_read_is_refused():
    with pytest.raises(ValueError, match="unknown categories"):
        Forest([], [], [], [], []).add_tree(["If (feature 3 in {0.0,2.0})", "Predict: 1.0", "Else (x)", "Predict: 0.0"], 1.0)


def test_hand_entered_policies_score_alike_in_any_number(spark, model, monkeypatch):
    entered = [
        {**SAMPLE_POLICY, "PREMIUM": premium, "MAKE": make, "INSR_END": end, "CLAIM_PAID": paid}
        for premium in (10, "2000", None, float("nan"), "x")
        for make, end, paid in (("NISSAN", "2014-08-07", 0.0), (None, "2013-01-01", 5.0), ("Brand#11", None, None))
    ]
    few = score_policies(entered, model, 0.4, spark=spark)
    assert "LocalRelation" in few._jdf.queryExecution().optimizedPlan().toString().split("\n")[0]
    monkeypatch.setattr(scoring, "FEW_POLICIES", 0)
    many = score_policies(entered, model, 0.4, spark=spark)
    assert few.dtypes == many.dtypes
    for a, b in zip(few.collect(), many.collect(), strict=True):
        a, b = a.asDict(), b.asDict()
        p, q = a.pop("probability_claim"), b.pop("probability_claim")
        assert str(a) == str(b) and (p is None) == (q is None) and (p is None or abs(p - q) < 1e-12)
    assert score_policies([], model, spark=spark).count() == 0


@pytest.mark.parametrize("depth", [0, 1, 4, 6, 8, 10])
def test_open_leaves_lead_where_a_walk_leads(depth):
    """Each tree's value for a row, lopsided trees, slots that the vectors lack and more leaves than a word has bits included."""
    draw, labels = random.Random(depth), [["a", "b", "c"], ["x"]]
    forest = Forest(["p", "q"], [0.0, 0.0], ["m", "u"], ["a", "x"], labels)

    def lines(level: int) -> list[str]:
        if level == depth or level and draw.random() < 0.1:
            return [f"Predict: {draw.uniform(-1, 1)}"]
        slot = draw.randrange(8)  # two numbers, four categories, two that the vectors lack
        test = f"in {{{draw.choice(['0.0', '1.0'])}}}" if slot >= 2 else f"<= {draw.choice([-1.5, 0.0, 2.0])}"
        return [f"If (feature {slot} {test})", *lines(level + 1), "Else", *lines(level + 1)]

    for _ in range(4):
        forest.add_tree(lines(0), draw.random())
    rows = [(p, q, m, u) for p in (-1.5, -1.0, 0.0, 1.0, 2.0, 9.0, float("nan")) for q in (-2.0, 2.0, 3.0) for m in "abcd" for u in "xy"]

    def walk(row: tuple, node: int) -> float:
        while forest.left[node] >= 0:
            slots = [*row[:2], *[float(row[2] == c) for c in labels[0]], float(row[3] == "x"), 0.0, 0.0]
            node = forest.left[node] if slots[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
        return forest.value[node]

    wanted = [sum(weight * walk(row, root) for root, weight in zip(forest.roots, forest.weights)) for row in rows]
    columns = tuple(pa.array(of) for of in zip(*rows))
    none = tuple(c.slice(0, 0) for c in columns)
    got = list(_margins(forest, iter([columns, none])))
    assert np.abs(got[0] - wanted).max() < 1e-12 and len(got[1]) == 0


def test_leaves_are_told_without_room_for_unasked_categories():
    """A bin for each category that some node asks for and one for all others; before, one for every category a node."""
    forest = Forest(["p"], [0.0], ["m"], ["0"], [[str(i) for i in range(100_000)]])
    forest.add_tree(["If (feature 78 in {0.0})", "Predict: 1.0", "Else", "Predict: 2.0"], 1.0)
    _, names, open_, _ = _masks(forest)
    assert names == [["77"]] and [of.shape for of in open_] == [(1, 1), (2, 1)]


def test_features_run_in_methods_that_the_jvm_compiles(spark, folder):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    policy_features(order_policies(spark, folder))
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
