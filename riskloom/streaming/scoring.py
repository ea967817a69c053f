"""Batch uploads as a stream: policy files that arrive in a folder are scored as they come.

Only the threshold decision is offered: it looks at one row at a time and needs no state. The top-X%
decision needs the whole batch and stays with score_batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from riskloom.plans.scoring import score_batch
from riskloom.schema import DEFAULT_THRESHOLD, POLICY_COLUMNS
from riskloom.sources.policies import typed_columns


def score_uploads(
    spark: SparkSession,
    folder: str,
    out: str,
    progress: str,
    model: PipelineModel,
    threshold: float = DEFAULT_THRESHOLD,
    file_columns: Sequence[str] = POLICY_COLUMNS,
) -> StreamingQuery:
    """Scores all files not yet seen and stops; `progress` remembers them between runs.

    A file whose header isn't `file_columns` in that order ends the query instead of being misread.
    """
    schema = StructType([StructField(c, StringType()) for c in file_columns])
    uploads = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False).csv(folder)
    scored = score_batch(uploads.select(*typed_columns(file_columns)), model, threshold)
    return (
        scored.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
