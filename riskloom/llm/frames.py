"""Small helpers shared by the operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import scratch_path

# Rows of one or two numbers that a join may broadcast; more go through a shuffle.
BROADCAST_ROWS = 500_000
ARROW_ROWS = 512


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Compute once into Parquet in the shared folder and read from there: lineage ends, columns stay prunable."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", compression) if compression else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bounds what a Python worker holds: few rows a batch, and few bytes where rows are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def release_memory() -> None:
    """Gives what a Python worker has freed back to the system; the process stays for later tasks, beside the JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library than glibc
        pass


@contextmanager
def bounded_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> Iterator[None]:
    """`small_batches` for what is computed inside; the caller's settings are back afterwards, errors or not."""
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    before = {name: spark.conf.get(name, None) for name in names}
    small_batches(spark)
    spark.conf.set(names[0], str(rows))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def crc_of_id(doc_id: Column | str) -> Column:
    """crc32 of the id as text; a row without an id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")))


def maybe_broadcast(df: DataFrame, rows: int, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only for counted rows within the bound; beyond it the join shuffles."""
    return F.broadcast(df) if rows <= bound else df
