"""Session defaults and the place where intermediate results are cut from their lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_CUT = 200_000

def local_session(cores: str = "*", app: str = "riskloom") -> SparkSession:
    """A single-machine session for tests and the benchmark; clusters bring their own."""
    parallelism = "8" if cores == "*" else cores
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", parallelism)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def skew_safe(spark: SparkSession) -> SparkSession:
    """Lets adaptive execution split a hot join key even where that costs a shuffle afterwards.

    An aggregate right after a join on its key would else inherit the join's partitions, hot ones too.
    """
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # A row of a policy takes about 1 KB in a task that sorts and deduplicates it, 30 bytes in a shuffle.
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")
    return spark


def short_methods(spark: SparkSession) -> None:
    """Plans whose code for a row makes one method of more than 8,000 bytes run in several shorter ones.

    The JVM never compiles longer methods, so a projection of many derived columns would be interpreted.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def cut_for(spark: SparkSession, rows: int) -> None:
    """Shuffles are cut finely enough for tables of so many rows, so that a task's share doesn't grow with them.

    The rows also say how many parts stay when small ones are put together: 16 MB of a shuffle hold any number of
    rows, by how well they compress. Stored files are read in parts of as much.
    """
    wanted = -(-rows // ROWS_PER_CUT)
    cuts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(cuts))
    least = max(spark.sparkContext.defaultParallelism, wanted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionNum", str(least))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="riskloom-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute once, keep the rows in reliable storage and forget the lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def store(df: DataFrame) -> DataFrame:
    """Like `materialize`, for wide rows: compressed columns, and later passes read only those they use.

    Rows that Parquet can't take (columns without a type, names that differ by case only) are materialized.
    """
    names = {c.lower() for c in df.columns}
    if len(names) < len(df.columns) or any("void" in kind for _, kind in df.dtypes):
        return materialize(df)
    path = scratch_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
