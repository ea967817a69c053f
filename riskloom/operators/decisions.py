"""Scoring output: decision, risk level and comparison with the known outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskloom.functions.decisions import outcome_note, risk_label
from riskloom.functions.parsing import claim_label


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, StringType)


def with_risk_level(df: DataFrame, p: str = "probability_claim") -> DataFrame:
    return df.withColumn("risk_level", risk_label(F.col(p)))


def actual_and_match(df: DataFrame, prediction: str = "prediction", paid: str = "CLAIM_PAID") -> DataFrame:
    """Adds the known label and whether the prediction agrees; unchanged if no amount is known."""
    if paid not in df.columns:
        return df
    actual = claim_label(F.col(paid), _is_text(df, paid))
    return df.withColumn("actual_from_claim_paid", actual).withColumn(
        "prediction_match", F.col(prediction) == F.col("actual_from_claim_paid")
    )


def with_outcome_note(df: DataFrame, prediction: str = "prediction", paid: str = "CLAIM_PAID") -> DataFrame:
    if paid not in df.columns:
        return df
    return df.withColumn("outcome_note", outcome_note(F.col(paid), F.col(prediction), _is_text(df, paid)))


def preview(df: DataFrame, n: int = 20, order: list[Column] | None = None) -> DataFrame:
    """The first n rows; with an order each task keeps only its own first n."""
    return (df.orderBy(*order) if order else df).limit(n)
