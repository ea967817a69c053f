"""Row-level cleaning: duplicates, labels, blanks and policy checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskloom.functions.parsing import claim_label, number_column, parse_policy_date
from riskloom.schema import AMOUNT_COLUMNS, CODE_COLUMNS, LABEL, POLICY_MIN_DATE, require_columns

_NUMBER_FIELDS = {*AMOUNT_COLUMNS, *CODE_COLUMNS, "PROD_YEAR"}


def _number_text(df: DataFrame, name: str) -> Column:
    """One spelling per number ("2007.0" and "2007" become "2007"); other text stays as it is."""
    number = number_column(df, name)
    whole = F.when((number == F.floor(number)) & (F.abs(number) < 1e15), number.cast("long").cast("string"))
    return F.coalesce(whole, number.cast("string"), F.col(name))


def dedup(df: DataFrame) -> DataFrame:
    """Drop exact copies (NULL equals NULL); number fields compare by value, dates by their text.

    Copies collapse on the map side first, so one hot row costs one row per task in the shuffle.
    """
    unified = {
        field.name: _number_text(df, field.name)
        for field in df.schema.fields
        if field.name in _NUMBER_FIELDS and isinstance(field.dataType, StringType)
    }
    return df.withColumns(unified).dropDuplicates() if unified else df.dropDuplicates()


def with_claim_label(df: DataFrame, paid: str = "CLAIM_PAID") -> DataFrame:
    is_text = isinstance(df.schema[paid].dataType, StringType)
    return df.withColumn(LABEL, claim_label(F.col(paid), is_text))


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    """Trimmed text values without NULLs and empty strings."""
    return df.select(F.trim(F.col(column).cast("string")).alias(column)).filter(F.col(column) != "")


def policy_violations(df: DataFrame, bounds: dict) -> Column:
    """Array with a reason for every entry rule a row breaks; missing values break none.

    `bounds` holds prod_year_min, prod_year_max and policy_max_date (see reference_profile).
    """
    require_columns(df.columns)
    begin, end = parse_policy_date(F.col("INSR_BEGIN")), parse_policy_date(F.col("INSR_END"))
    year = number_column(df, "PROD_YEAR")
    first, last = F.lit(POLICY_MIN_DATE).cast("date"), F.lit(bounds["policy_max_date"]).cast("date")
    rules = {
        "END_NOT_AFTER_BEGIN": end <= begin,
        "SEATS_NUM_BELOW_ONE": number_column(df, "SEATS_NUM") < 1,
        "PROD_YEAR_OUT_OF_RANGE": ~year.between(bounds["prod_year_min"], bounds["prod_year_max"]),
        "INSR_BEGIN_OUT_OF_RANGE": ~begin.between(first, last),
        "INSR_END_OUT_OF_RANGE": ~end.between(first, last),
    }
    for name in AMOUNT_COLUMNS:
        if name != "SEATS_NUM" and name in df.columns:
            rules[f"{name}_NEGATIVE"] = number_column(df, name) < 0
    found = F.array(*[F.when(broken, F.lit(reason)) for reason, broken in sorted(rules.items())])
    return F.array_compact(found)


def validate_policies(df: DataFrame, bounds: dict) -> DataFrame:
    """Adds `reasons` and `is_valid`; filter on is_valid for either side of the split."""
    return df.withColumn("reasons", policy_violations(df, bounds)).withColumn(
        "is_valid", F.size("reasons") == 0
    )
