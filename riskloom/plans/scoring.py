"""Bulk and hand-entered scoring."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.decisions import decide_threshold, outcome_note, risk_label
from riskloom.functions.parsing import claim_label
from riskloom.operators.boosting import PROBABILITY, predict_probability, stage_probability
from riskloom.operators.cleaning import policy_violations
from riskloom.operators.decisions import actual_and_match, with_outcome_note, with_risk_level
from riskloom.operators.forest import NODE_COLUMNS, forest_of, forest_probability, node_arrays
from riskloom.operators.features import derived_columns, parsed_columns, policy_features, select_features
from riskloom.operators.ranking import decide_top_pct, percentile_cutoff_value
from riskloom.operators.reference import draw_sample
from riskloom.schema import DEFAULT_PROFILE, DEFAULT_THRESHOLD, FEATURES, POLICY_COLUMNS, REFERENCE_SAMPLE
from riskloom.session import materialize, store

# One hand-entered policy for a quick start.
SAMPLE_POLICY = {
    "SEX": 0,
    "INSR_BEGIN": "2013-08-08",
    "INSR_END": "2014-08-07",
    "INSR_TYPE": 1202,
    "INSURED_VALUE": 519755.22,
    "PREMIUM": 7209.14,
    "SEATS_NUM": 4.0,
    "CARRYING_CAPACITY": 6.0,
    "TYPE_VEHICLE": "Pick-up",
    "CCM_TON": 3153.0,
    "MAKE": "NISSAN",
    "USAGE": "Own Goods",
    "PROD_YEAR": "2007.0",
    "CLAIM_PAID": 0.0,
}
POLICY_SCHEMA = (
    "SEX int, INSR_BEGIN string, INSR_END string, INSR_TYPE int, INSURED_VALUE double, PREMIUM double, "
    "SEATS_NUM double, CARRYING_CAPACITY double, TYPE_VEHICLE string, CCM_TON double, MAKE string, "
    "USAGE string, PROD_YEAR string, CLAIM_PAID double"
)


# Hand-entered policies that carry the trees with them, about 250 KB a row; more go through the model stages.
FEW_POLICIES = 50
_FIELDS = [tuple(field.split()) for field in POLICY_SCHEMA.split(", ")]
_ARROW = {"int": pa.int32(), "double": pa.float64(), "string": pa.string()}


def score_probability(df: DataFrame, model: PipelineModel, predict: Callable = predict_probability) -> DataFrame:
    """All input columns as they came, plus the claim probability; narrow, no shuffle."""
    own = [F.col(c).alias(f"__in_{c}") for c in df.columns]
    features = select_features(policy_features(df).select("*", *own), *[f"__in_{c}" for c in df.columns])
    scored = predict(model, features).drop(*FEATURES)
    return scored.select(*[F.col(f"__in_{c}").alias(c) for c in df.columns], PROBABILITY)


def score_batch(
    df: DataFrame,
    model: PipelineModel,
    threshold: float = DEFAULT_THRESHOLD,
    top_percent: int | None = None,
    key: Column | None = None,
) -> DataFrame:
    """Input columns, probability, prediction, risk level and, if the amount is known, the outcome.

    With `top_percent` the decision is exact over the whole batch; the scored rows are then kept, as
    several passes read them. With a threshold no row leaves the JVM or is shuffled.
    """
    if top_percent is None:
        scored = score_probability(df, model, stage_probability)
        decided = scored.withColumn("prediction", decide_threshold(F.col(PROBABILITY), threshold))
    else:
        decided = decide_top_pct(store(score_probability(df, model)), PROBABILITY, top_percent, key)
    return actual_and_match(with_risk_level(decided))


def score_cutoff(
    reference: DataFrame,
    model: PipelineModel,
    percent: int,
    n: int = REFERENCE_SAMPLE,
    key: Column | None = None,
) -> float | None:
    """Top-X% cutoff of a reference table: sample first, score only the sample. Worth storing."""
    sample = score_probability(draw_sample(reference, n, key=key), model).select(PROBABILITY)
    return percentile_cutoff_value(materialize(sample), PROBABILITY, percent)


def _entered(value: object, kind: str) -> object:
    """A hand-entered value as its column's type; None where it can't be read as that."""
    if value is None:
        return None
    try:
        return {"double": float, "int": lambda v: int(float(v))}.get(kind.lower(), str)(value)
    except (TypeError, ValueError, OverflowError):
        return None


@lru_cache(maxsize=8)
def _few_steps(spark: SparkSession, model: PipelineModel, threshold: float, bounds: tuple) -> list[dict[str, Column]]:
    """The columns of a hand-entered policy's three projections, made once: parsed, derived and scored, decided."""
    entered = spark.createDataFrame([], POLICY_SCHEMA)
    parsed = {"reasons": policy_violations(entered, dict(bounds)), **parsed_columns(entered)}
    nodes = {c: F.lit(None).cast(f"array<{kind}>") for c, kind in NODE_COLUMNS.items()}
    features = entered.withColumns(parsed).withColumns({**derived_columns(), **nodes})
    kept = {c: F.col(c) for c in [*POLICY_COLUMNS, "reasons"]}
    valid = F.size("reasons") == 0
    prediction = F.when(valid, decide_threshold(F.col(PROBABILITY), threshold))
    actual = claim_label(F.col("CLAIM_PAID"))
    decided = {
        PROBABILITY: F.when(valid, F.col(PROBABILITY)),
        "prediction": prediction,
        "risk_level": F.when(valid, risk_label(F.col(PROBABILITY))),
        "actual_from_claim_paid": actual,
        "prediction_match": prediction == actual,
        "outcome_note": outcome_note(F.col("CLAIM_PAID"), prediction),
    }
    return [parsed, derived_columns(), {**kept, PROBABILITY: forest_probability(forest_of(model), features)}, {**kept, **decided}]


def _score_few(policies: list[dict], model: PipelineModel, threshold: float, bounds: dict, spark: SparkSession) -> DataFrame:
    """Rows that carry the trees, scored by one expression while the plan is made: no model stages, no job."""
    nodes = node_arrays(forest_of(model))
    columns = {c: pa.array([_entered(p.get(c), kind) for p in policies], _ARROW[kind]) for c, kind in _FIELDS}
    columns |= {c: pa.array([nodes[c]] * len(policies), pa.list_(_ARROW[kind])) for c, kind in NODE_COLUMNS.items()}
    # An Arrow table of this size becomes a local relation.
    rows = spark.createDataFrame(pa.table(columns))
    parsed, derived, scored, decided = _few_steps(spark, model, threshold, tuple(sorted(bounds.items())))
    rows = rows.withColumns(parsed).withColumns(derived)
    for step in (scored, decided):
        rows = rows.select(*[value.alias(name) for name, value in step.items()])
    return rows


def score_policies(
    policies: DataFrame | list[dict],
    model: PipelineModel,
    threshold: float = DEFAULT_THRESHOLD,
    bounds: dict | None = None,
    spark: SparkSession | None = None,
) -> DataFrame:
    """Hand-entered policies: checked against the entry rules, scored, and compared with the outcome.

    `threshold` may be a stored reference cutoff. Policies that break a rule keep their reasons and get
    no prediction.
    """
    bounds = bounds or DEFAULT_PROFILE
    if isinstance(policies, list):
        if len(policies) <= FEW_POLICIES:
            return _score_few(policies, model, threshold, bounds, spark)
        rows = [tuple(_entered(p.get(c), kind) for c, kind in _FIELDS) for p in policies]
        policies = spark.createDataFrame(rows, POLICY_SCHEMA)
    checked = policies.withColumn("reasons", policy_violations(policies, bounds))
    scored = score_probability(checked, model)
    valid = F.size("reasons") == 0
    decided = scored.withColumns(
        {
            "prediction": F.when(valid, decide_threshold(F.col(PROBABILITY), threshold)),
            PROBABILITY: F.when(valid, F.col(PROBABILITY)),
        }
    )
    labelled = with_risk_level(decided).withColumn("risk_level", F.when(valid, F.col("risk_level")))
    return with_outcome_note(actual_and_match(labelled))
