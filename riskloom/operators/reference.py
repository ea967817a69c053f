"""Samples without replacement as the rows of least hash: drawn in one pass after a count, and mergeable.

Row keys are hex digests in uniform order, so the count alone says below which key about n rows lie; a
pass keeps the rows below it, with a margin that fails once in a billion draws (and is then doubled).
The least n of a union are among the least n of its parts, so a stored sample takes in new rows without
reading the old ones again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.ordering import row_key
from riskloom.operators.sampling import sample_n
from riskloom.session import materialize

KEY = "__sample_key"
# Hex digits of a key that a bound is given in, and margins of the bound in standard deviations.
BOUND_DIGITS = 13
MARGIN = 6


def _bound(share: float) -> str:
    """The key below which `share` of all keys lie."""
    return format(min(16**BOUND_DIGITS - 1, int(share * 16**BOUND_DIGITS)), f"0{BOUND_DIGITS}x")


def _least(rows: DataFrame, n: int, total: int) -> DataFrame:
    """The n rows of least key (all if there are no more), computed once; rows carry KEY, `total` is their number."""
    if total <= n:
        return materialize(rows)
    share = (n + MARGIN * math.sqrt(n) + MARGIN**2) / total
    while True:
        kept = materialize(rows.filter(F.col(KEY) < _bound(share)) if share < 1 else rows)
        if share >= 1 or kept.count() >= n:
            return materialize(sample_n(kept, n, key=F.col(KEY)))
        share *= 2


def draw_sample(df: DataFrame, n: int, columns: Sequence[str] | None = None, key: Column | None = None) -> DataFrame:
    """Exactly min(n, count) rows of `columns`, computed once: the rows of least key, as `sample_n` draws them.

    Two passes over the rows, of which the first only counts.
    """
    rows = df.select((row_key(df) if key is None else key).alias(KEY), *[F.col(f"`{c}`") for c in columns or df.columns])
    return _least(rows, n, df.count()).drop(KEY)


def _versions(path: str) -> str:
    return f"{path}/*/state"


def _write_version(rows: DataFrame, path: str, version: int, n: int, seen: int) -> None:
    """Rows first; a version is there once its state is."""
    folder = f"{path}/{version:08d}"
    rows.write.mode("overwrite").parquet(f"{folder}/rows")
    end = rows.agg(F.max(KEY).alias("end"))
    end.select(F.lit(version).alias("version"), F.lit(n).cast("long").alias("n"), F.lit(seen).cast("long").alias("seen"), "end").write.mode(
        "overwrite"
    ).parquet(f"{folder}/state")


def _state(spark: SparkSession, path: str):
    schema = "version int, n long, seen long, end string"
    return spark.read.schema(schema).parquet(_versions(path)).orderBy(F.desc("version")).first()


def write_sample(df: DataFrame, path: str, n: int, columns: Sequence[str] | None = None, key: Column | None = None) -> None:
    """Starts a stored sample of n rows from these rows."""
    seen = df.count()
    rows = df.select((row_key(df) if key is None else key).alias(KEY), *[F.col(f"`{c}`") for c in columns or df.columns])
    _write_version(_least(rows, n, seen), path, 1, n, seen)


def extend_sample(df: DataFrame, path: str, key: Column | None = None) -> None:
    """Takes new rows into a stored sample, as if it had been drawn from all rows so far.

    Reads the new rows and the stored ones, never the rows of earlier calls. Rows above the largest key
    of a full sample can't enter it and are dropped in the scan. The new version is complete before
    readers see it; a call that fails leaves the old one.
    """
    spark = df.sparkSession
    state = _state(spark, path)
    stored = spark.read.parquet(f"{path}/{state.version:08d}/rows")
    columns = [F.col(f"`{c}`") for c in stored.columns if c != KEY]
    new, fresh = df.select((row_key(df) if key is None else key).alias(KEY), *columns), df.count()
    if state.seen >= state.n and state.end is not None:
        new = new.filter(F.col(KEY) <= state.end)
    both = materialize(stored.unionByName(new))
    total = both.count()
    rows = both if total <= state.n else materialize(sample_n(both, state.n, key=F.col(KEY)))
    _write_version(rows, path, state.version + 1, state.n, state.seen + fresh)


def read_sample(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest complete version."""
    return spark.read.parquet(f"{path}/{_state(spark, path).version:08d}/rows").drop(KEY)
