"""Policy files in, tables out."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskloom.functions.parsing import parse_code, parse_number
from riskloom.schema import AMOUNT_COLUMNS, CODE_COLUMNS, NA_TOKENS, POLICY_COLUMNS, REQUIRED_COLUMNS


def _typed(name: str):
    text = F.when(~F.col(name).isin(NA_TOKENS), F.col(name))
    if name in CODE_COLUMNS:
        text = parse_code(text)
    elif name in AMOUNT_COLUMNS:
        text = parse_number(text)
    return text.alias(name)


def typed_columns(columns: Sequence[str]) -> list:
    return [_typed(c) for c in columns]


def file_headers(spark: SparkSession, path: str | Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Which files have which header: column names in file order -> paths. Files without a line are left out.

    One pass that only splits lines; each file sends its first line. The driver sees a path a file.
    """
    lines = spark.read.text(path).select(
        "value", F.monotonically_increasing_id().alias("at"), "_metadata.file_path", "_metadata.file_block_start"
    )
    first = lines.filter("file_block_start = 0 AND trim(value) <> ''").groupBy("file_path").agg(F.min_by("value", "at").alias("line"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in first.orderBy("file_path").collect():
        names = next(csv.reader([row.line.removeprefix("\ufeff")]))
        found.setdefault(tuple(name.strip() for name in names), []).append(row.file_path)
    return found


def _bound(spark: SparkSession, header: Sequence[str], files: list[str], wanted: Sequence[str], corrupt: str | None) -> DataFrame:
    """Files of one header as text columns, bound by name; a wanted column that they lack is NULL."""
    schema = StructType([StructField(c, StringType()) for c in header])
    reader = spark.read.option("header", True)
    if corrupt is None:
        raw = reader.schema(schema).csv(files)
    else:
        # All fields must be split to see that a line has too many.
        schema = StructType([*schema.fields, StructField(corrupt, StringType())])
        raw = reader.option("columnNameOfCorruptRecord", corrupt).option("columnPruning", False).schema(schema).csv(files)
    held = F.lit(True) if corrupt is None else F.col(f"`{corrupt}`").isNull()
    fields = [(F.when(held, F.col(f"`{c}`")) if corrupt else F.col(f"`{c}`")) if c in header else F.lit(None).cast("string") for c in wanted]
    # Spark refuses to read the corrupt column alone, as a count of bad lines would; so it drags a field along.
    nothing = F.substring(F.coalesce(F.col(f"`{header[0]}`"), F.lit("")), 1, 0)
    kept = [F.concat(F.col(f"`{corrupt}`"), nothing).alias(corrupt)] if corrupt else []
    return raw.select(*[f.alias(c) for f, c in zip(fields, wanted)], *kept)


def read_policy_text(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None, corrupt: str | None = None
) -> DataFrame:
    """Delimited policy files with a header, every field as text, bound by name file by file.

    Files may order their columns as they like, lack some (NULL there) and have more: without `columns`
    the result holds all policy columns, then every further column that any file has. A header that
    names a column twice, or files that all lack a required column that is asked for, are an error.
    With `corrupt`, a line with too few or too many fields has no fields, and its text in a column of
    that name, at the end; without it, missing fields are NULL and surplus ones are not read.
    """
    headers = file_headers(spark, path)
    for header, files in headers.items():
        twice = sorted({c for c in header if header.count(c) > 1})
        if twice:
            raise ValueError(f"{files[0]} names columns twice: {', '.join(twice)}")
    seen = sorted({c for header in headers for c in header})
    wanted = list(columns or [*POLICY_COLUMNS, *[c for c in seen if c not in POLICY_COLUMNS]])
    if headers:
        absent = [c for c in wanted if c in REQUIRED_COLUMNS and c not in seen]
        if absent:
            raise ValueError(f"policy columns missing: {', '.join(absent)}")
    parts = [_bound(spark, header, files, wanted, corrupt) for header, files in headers.items()]
    if not parts:
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in [*wanted, *([corrupt] if corrupt else [])]]))
    return reduce(DataFrame.unionByName, parts)


def type_policies(raw: DataFrame) -> DataFrame:
    """Text columns as typed ones; a field that can't be read becomes NULL and costs neither its row nor its neighbours."""
    known = {*POLICY_COLUMNS}
    return raw.select(*[_typed(c) if c in known else F.col(f"`{c}`") for c in raw.columns])


def read_policies(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None, corrupt: str | None = None
) -> DataFrame:
    """`read_policy_text`, typed. Dates and PROD_YEAR stay text; only `columns` are parsed.

    Drop copies before the types are set (`read_policy_text`, `dedup`, `type_policies`) where rows that
    differ only in unreadable amounts must stay apart.
    """
    return type_policies(read_policy_text(spark, path, columns, corrupt))


def write_table_csv(df: DataFrame, path: str) -> None:
    """One file per task; nested columns go out as JSON text."""
    nested = {
        f.name: F.to_json(f.name) for f in df.schema.fields if f.dataType.typeName() in ("array", "struct", "map")
    }
    df.withColumns(nested).write.mode("overwrite").option("header", True).csv(path)
