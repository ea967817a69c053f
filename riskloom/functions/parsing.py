"""Column expressions that repair dirty policy fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Date spellings: 8-AUG-13, with a four-digit year too, and 2013-08-08, before a time of day too.
POLICY_DATE = r"^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{2}$"
ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
ANY_MONTH_NAME = r"^[0-9]{1,2}-[A-Za-z]{3}-([0-9]{2}|[0-9]{4})$"
ANY_ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9:.]+Z?)?$"
# 8/31/2013, always month first.
SLASHED = "/"
_MONTHS = "JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC"

# Java number parsing takes a type suffix ("2007d"); a policy file means text by that.
_JAVA_SUFFIX = r"[0-9.][dDfF]\s*$"


def parse_number(col: Column, text: bool = True) -> Column:
    """DOUBLE value of a field; NULL for NaN and for text that is no number."""
    if text:
        col = F.when(~col.rlike(_JAVA_SUFFIX), col.try_cast("double"))
    return F.nullif(col.cast("double"), F.lit(float("nan")))


def number_column(df: DataFrame, name: str) -> Column:
    """parse_number for a column of df, reading its type from the schema."""
    return parse_number(F.col(name), isinstance(df.schema[name].dataType, StringType))


def parse_code(col: Column, text: bool = True) -> Column:
    """A whole-number code such as SEX; text like '1202.0' counts as 1202."""
    return parse_number(col, text).try_cast("int")


def _as_iso(text: Column) -> Column:
    """8-AUG-13 and 8-AUG-2013 as 2013-08-8; years 69-99 are 1969-1999, an unknown month name becomes month 0."""
    day, year = F.substring_index(text, "-", 1), F.substring_index(text, "-", -1)
    name = F.upper(text.substr(F.length(day) + 2, F.lit(3)))
    month = F.floor((F.instr(F.lit(_MONTHS), name) + 3) / 4).cast("string")
    century = F.when(F.length(year) == 4, "").when(year >= "69", "19").otherwise("20")
    return F.concat(century, year, F.lit("-"), month, F.lit("-"), day)


def _spelled(text: Column, fmt: str) -> tuple[Column, Column]:
    """Whether the text has the format, and its value as year, month and day."""
    if fmt == SLASHED:
        month, day, year = (F.split_part(text, F.lit("/"), F.lit(k)) for k in (1, 2, 3))
        two = F.length(text) - F.length(F.replace(text, F.lit("/"), F.lit(""))) == 2
        return two, F.concat_ws("-", year, month, day)
    return text.rlike(fmt), _as_iso(text) if fmt in (POLICY_DATE, ANY_MONTH_NAME) else text.substr(1, 10)


def parse_policy_date(col: Column, formats: Sequence[str] = (ANY_MONTH_NAME, ANY_ISO, SLASHED)) -> Column:
    """DATE for text in one of the formats and in the calendar, else NULL.

    All spellings meet in one cast, which is cheaper per row than a date formatter for each.
    """
    text = F.trim(col.cast("string"))
    iso = None
    for fmt in formats:
        iso = (F if iso is None else iso).when(*_spelled(text, fmt))
    return iso.try_cast("date")


def claim_label(paid: Column, text: bool = False) -> Column:
    """1 where a claim was paid; missing and unreadable amounts count as 0."""
    return (F.coalesce(parse_number(paid, text), F.lit(0.0)) > 0).cast("int")


def clamp_date(col: Column, low: Column, high: Column) -> Column:
    """Move a date into [low, high]; NULL stays NULL."""
    return F.when(col.isNotNull(), F.least(F.greatest(col, low), high))


def safe_ratio(top: Column, bottom: Column) -> Column:
    """Quotient, NULL where the divisor is zero or missing."""
    return F.try_divide(top, bottom)
