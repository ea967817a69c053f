"""Sharding by a two-pass external shuffle: seeded scatter into buckets, then a shuffle within each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.frames import stored

SHARDS = 40
SEED = 20_251
BUCKET_BYTES = 32 << 20
ROW_OVERHEAD = 16


def shuffle_into_shards(
    rows: DataFrame, text: str = "text", shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """All rows and columns plus `size`, `shard` and `slot`: a seeded uniform order cut into equal shards.

    First pass: a seeded hash of the whole row scatters it into one of the buckets, of `bucket_bytes`
    on average. Second pass: each bucket's rows are put in the order of a Fisher-Yates shuffle of their
    number. Buckets then follow one another; shard sizes differ by one row at most, and slots count
    from 0 in each shard. The same rows and seed give the same shards. Equal texts of different rows
    spread like any others; rows equal in every column share a bucket and are interchangeable there.
    A null text has the size of an empty one. An empty table gives an empty one. The added columns
    replace columns of those names.
    """
    names = [c for c in rows.columns if c not in ("size", "shard", "slot")]
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + ROW_OVERHEAD
    total = rows.agg(F.count("*").alias("n"), F.sum(size).alias("bytes")).first()
    count, buckets = total["n"], max(shards, -(-(total["bytes"] or 0) // bucket_bytes))
    columns = [F.col(f"`{c}`") for c in names]
    scattered = rows.select(F.struct(*columns).alias("row"), size.alias("size"), F.xxhash64(F.lit(seed), *columns).alias("draw"))
    scattered = scattered.withColumn("bucket", F.pmod("draw", F.lit(buckets)))

    sizes = scattered.groupBy("bucket").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = stored(sizes.select("bucket", "n", before.alias("before")), "buckets")
    orders = stored(
        sizes.select("bucket", "before", F.shuffle(F.sequence(F.lit(0), (F.col("n") - 1).cast("int")), seed).alias("order")),
        "orders",
    )

    within = Window.partitionBy("bucket").orderBy("draw", F.xxhash64("row", F.lit(seed + 1)))
    numbered = scattered.withColumn("at", F.row_number().over(within)).join(orders, "bucket")
    place = (F.col("before") + F.element_at("order", F.col("at"))).alias("place")
    least, extra = divmod(count, shards)
    split = extra * (least + 1)
    per = max(least, 1)
    place_of = F.col("place")
    shard = F.when(place_of < split, F.floor(place_of / (least + 1))).otherwise(extra + F.floor((place_of - split) / per))
    slot = F.when(place_of < split, place_of % (least + 1)).otherwise((place_of - split) % per)
    placed = numbered.select("row", "size", place)
    return placed.select(
        *(F.col("row")[c].alias(c) for c in names), "size", shard.cast("int").alias("shard"), slot.cast("long").alias("slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard, rows in slot order; a lost task is redone from the same seeded order."""
    placed = sharded.repartition(sharded.select("shard").distinct().count() or 1, "shard")
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
