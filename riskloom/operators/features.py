"""The derived policy features, one definition for training and scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskloom.functions.parsing import number_column, parse_code, parse_policy_date, safe_ratio
from riskloom.schema import CODE_COLUMNS, FEATURES, RAW_NUMERIC, require_columns
from riskloom.session import short_methods

_PARSED = "__parsed_"


def parsed_columns(df: DataFrame) -> dict[str, Column]:
    """Every dirty field that features rest on, parsed once."""
    parsers = {
        "begin": parse_policy_date(F.col("INSR_BEGIN")),
        "end": parse_policy_date(F.col("INSR_END")),
        **{c: number_column(df, c) for c in [*RAW_NUMERIC, "PROD_YEAR"]},
    }
    return {_PARSED + name: value for name, value in parsers.items()}


def derived_columns() -> dict[str, Column]:
    """The derived features of rows with the parsed columns."""

    def parsed(name: str) -> Column:
        return F.col(_PARSED + name)

    begin, end = parsed("begin"), parsed("end")
    value, premium, seats = parsed("INSURED_VALUE"), parsed("PREMIUM"), parsed("SEATS_NUM")
    days = F.datediff(end, begin)
    age = F.year(begin) - parsed("PROD_YEAR")
    return {
        "EFFECTIVE_YEAR_DERIVED": F.year(begin),
        "POLICY_DURATION_DAYS": days,
        "VEHICLE_AGE_YEARS": age,
        "POLICY_BEGIN_MONTH": F.month(begin),
        "POLICY_BEGIN_QUARTER": F.quarter(begin),
        "POLICY_END_MONTH": F.month(end),
        "POLICY_END_QUARTER": F.quarter(end),
        "POLICY_DURATION_MONTHS": days / F.lit(30.0),
        "INSURED_VALUE_LOG": F.log1p(value),
        "PREMIUM_LOG": F.log1p(premium),
        "VALUE_PER_PREMIUM": safe_ratio(value, premium),
        "VALUE_PER_SEAT": safe_ratio(value, seats),
        "CAPACITY_PER_SEAT": safe_ratio(parsed("CARRYING_CAPACITY"), seats),
        "PREMIUM_PER_DAY": safe_ratio(premium, days.cast("double")),
        "AGE_BY_VALUE": safe_ratio(age, value + F.lit(1.0)),
    }


def policy_features(df: DataFrame) -> DataFrame:
    """Adds the derived columns and leaves the inputs as they came.

    Every dirty field is parsed once, into a column of its own: Catalyst keeps a projection whose
    results are used several times apart, so no feature repeats the parsing.
    """
    require_columns(df.columns)
    short_methods(df.sparkSession)
    parsed = parsed_columns(df)
    return df.withColumns(parsed).withColumns(derived_columns()).drop(*parsed)


def select_features(df: DataFrame, *keep: str) -> DataFrame:
    """The fixed 24-column model projection, after any `keep` columns."""
    columns = []
    for name in FEATURES:
        if name in CODE_COLUMNS:
            is_text = isinstance(df.schema[name].dataType, StringType)
            columns.append(parse_code(F.col(name), is_text).alias(name))
        elif name in RAW_NUMERIC:
            columns.append(number_column(df, name).alias(name))
        else:
            columns.append(F.col(name))
    return df.select(*keep, *columns)
