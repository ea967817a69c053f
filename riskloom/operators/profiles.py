"""Profiles of a reference table: value lists, codes, date and year ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskloom.functions.parsing import POLICY_DATE, number_column, parse_code, parse_policy_date
from riskloom.operators.cleaning import drop_blank
from riskloom.schema import DEFAULT_PROFILE, POLICY_MIN_DATE


def category_counts(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Cleaned values, most frequent first, equal counts by value."""
    counts = drop_blank(df, column).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.desc("n"), F.asc(column))
    return ordered.limit(limit) if limit else ordered


def distinct_codes(df: DataFrame, column: str) -> DataFrame:
    is_text = isinstance(df.schema[column].dataType, StringType)
    codes = df.select(parse_code(F.col(column), is_text).alias(column))
    return codes.filter(F.col(column).isNotNull()).distinct().orderBy(column)


def all_policy_dates(df: DataFrame) -> DataFrame:
    """Begin dates stacked on end dates, unreadable ones left out."""
    stacked = [
        df.select(parse_policy_date(F.col(name), [POLICY_DATE]).alias("policy_date"))
        for name in ("INSR_BEGIN", "INSR_END")
    ]
    return stacked[0].unionByName(stacked[1]).filter(F.col("policy_date").isNotNull())


def reference_profile(df: DataFrame) -> DataFrame:
    """One row of entry bounds and defaults; constants where the table has no usable value."""
    c = F.col
    begin = parse_policy_date(c("INSR_BEGIN"), [POLICY_DATE])
    end = parse_policy_date(c("INSR_END"), [POLICY_DATE])
    # A year beyond INT is no year; it must not hide the others.
    year = number_column(df, "PROD_YEAR").try_cast("int")

    def default(name: str):
        value = F.lit(DEFAULT_PROFILE[name])
        return value if name.startswith("prod") else value.cast("date")

    seen = df.select(begin.alias("begin"), end.alias("end"), year.alias("year")).agg(
        F.min("year").alias("year_min"),
        F.max("year").alias("year_max"),
        F.min("begin").alias("begin_min"),
        # One scan: the latest of both columns is the maximum over the stacked dates.
        F.greatest(F.max("begin"), F.max("end")).alias("date_max"),
    )
    latest = F.coalesce(c("date_max"), default("policy_max_date"))
    first = F.when(c("begin_min").isNotNull(), F.greatest(c("begin_min"), F.lit(POLICY_MIN_DATE).cast("date")))
    return seen.select(
        F.coalesce("year_min", default("prod_year_min")).alias("prod_year_min"),
        F.coalesce("year_max", default("prod_year_max")).alias("prod_year_max"),
        latest.alias("policy_max_date"),
        F.coalesce(first, default("policy_default_begin")).alias("policy_default_begin"),
        F.when(first.isNotNull(), F.least(F.add_months(first, 12), latest))
        .otherwise(default("policy_default_end"))
        .alias("policy_default_end"),
    )
