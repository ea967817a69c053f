"""Column expressions that turn a claim probability into a decision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions.parsing import claim_label, parse_number
from riskloom.schema import HIGH_RISK, MEDIUM_RISK


def decide_threshold(p: Column, threshold: float) -> Column:
    """1 where the probability reaches the threshold; a missing one or NaN does not."""
    return F.coalesce(F.nullif(p.cast("double"), F.lit(float("nan"))) >= F.lit(float(threshold)), F.lit(False)).cast("int")


def risk_label(p: Column) -> Column:
    """Risk level of a probability; a missing one or NaN is LOW, as it is no claim."""
    p = F.nullif(p.cast("double"), F.lit(float("nan")))
    return F.when(p >= HIGH_RISK, "HIGH").when(p >= MEDIUM_RISK, "MEDIUM").otherwise("LOW")


def outcome_note(paid: Column, prediction: Column, text: bool = False) -> Column:
    """How a decision compares with the amount paid."""
    actual = claim_label(paid, text)
    return (
        F.when(prediction == actual, "MATCH")
        .when((actual == 1) & (prediction == 0), "MISSED_CLAIM")
        .when((F.coalesce(parse_number(paid, text), F.lit(0.0)) == 0) & (prediction == 1), "FALSE_ALARM")
    )
