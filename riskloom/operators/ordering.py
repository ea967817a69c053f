"""Exact order statistics without a global sort in one task.

A window without a partition would send every row to a single task. Two shapes replace it (values at
exact ranks are a third, see `selection`):

* `cumulate`: running totals over an already counted table (one row per distinct value). The value
  range is cut into buckets of bounded size; each bucket runs its own window and adds the total of
  the buckets before it.
* `find_cuts` / `assign_segments`: exact-size slices of a hash order. Counting by hash prefix finds
  the key at which each slice ends, so rows are labelled by a comparison and never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.schema import SEED
from riskloom.session import materialize

ROWS_PER_BUCKET = 1_000_000
BUCKETS_MAX = 4096
BROADCAST_ROWS_MAX = 200_000
PREFIX_DIGITS = 3
COPIES_PER_TASK = 100_000
LOWEST = float("-inf")
HIGHEST = float("inf")


# --- running totals -----------------------------------------------------------------------------


def cumulate(
    counted: DataFrame,
    value: str,
    counts: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    position: Column | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """Adds `cum_<c>` for each count column: running totals by `value`, ties not allowed.

    `at_most` is a row bound the caller knows; without a small one `counted` is read several times
    and should be materialized. `position` is a DOUBLE that never falls as `value` rises; it
    defaults to the value itself.
    """
    by = list(by)
    order = F.desc(value) if descending else F.asc(value)
    size, buckets = None, 1
    if at_most is None or at_most > ROWS_PER_BUCKET:
        size = counted.agg(
            F.count(F.lit(1)).alias("rows"),
            F.approx_count_distinct(F.struct(*by) if by else F.lit(1)).alias("groups"),
        ).first()
        buckets = min(BUCKETS_MAX, math.ceil(size.rows / ROWS_PER_BUCKET))
    if buckets <= 1:
        window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return counted.withColumns({f"cum_{c}": F.sum(c).over(window) for c in counts})

    # Buckets follow the sort order of windows: NULL below all values, NaN in a bucket above them.
    placed = counted.withColumn("__position", F.coalesce(F.col(value) if position is None else position, F.lit(LOWEST)))
    steps = [i / buckets for i in range(1, buckets)]
    finite = F.when(F.abs("__position") < HIGHEST, F.col("__position"))
    bounds = placed.agg(F.percentile_approx(finite, steps, 10 * buckets)).first()[0] or [0.0]
    splits = [LOWEST, *sorted(set(bounds)), HIGHEST]
    placed = Bucketizer(splits=splits, inputCol="__position", outputCol="__bucket", handleInvalid="keep").transform(placed)

    bucket_order = F.desc("__bucket") if descending else F.asc("__bucket")
    before = Window.partitionBy(*by).orderBy(bucket_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*by, "__bucket")
        .agg(*[F.sum(c).alias(c) for c in counts])
        .select(
            *[F.col(c).alias(f"__by_{c}") for c in by],
            F.col("__bucket").alias("__of"),
            *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"__{c}") for c in counts],
        )
    )
    same = [F.col("__bucket") == F.col("__of"), *[F.col(c).eqNullSafe(F.col(f"__by_{c}")) for c in by]]
    if size.groups * buckets <= BROADCAST_ROWS_MAX:
        offsets = F.broadcast(offsets)
    inside = Window.partitionBy(*by, "__bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumns({f"cum_{c}": F.sum(c).over(inside) for c in counts})
        .join(offsets, same)
        .withColumns({f"cum_{c}": F.col(f"cum_{c}") + F.col(f"__{c}") for c in counts})
        .select(*counted.columns, *[f"cum_{c}" for c in counts])
    )


# --- slices of a hash order ---------------------------------------------------------------------


def row_key(df: DataFrame, columns: Sequence[str] | None = None, seed: int = SEED) -> Column:
    """md5 of a row's values: a random-looking order that any run, task or retry repeats.

    The values are hashed as JSON text, NULLs left out, so rows share a key only if they are copies.
    """
    fields = [F.lit(seed).alias("seed"), *[F.col(name) for name in columns or df.columns]]
    exact = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return F.md5(F.to_json(F.struct(*fields), exact))


def opaque(col: Column) -> Column:
    """The same value, but Catalyst does not copy the expression into filters below it.

    A hash of a whole row mentions every column; pushed through the projections that computed them
    it makes the optimizer's constraint sets explode.
    """
    return F.when(F.spark_partition_id() >= 0, col)


Quotas = Callable[[dict[str, int]], dict[str, list[int]]]


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast of a counted table within the bound; beyond it the join shuffles."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS_MAX else df


def find_cuts(df: DataFrame, key: Column, stratum: Column, quotas: Quotas) -> tuple[DataFrame, int, int]:
    """The cut table (stratum, base, cuts), its number of rows, and how many keys are cut within their copies.

    `base` of a stratum's ends lie before its first row; `cuts` is an array of (key, i, taken, copies) in
    key order: where slice i ends, `taken` of the `copies` rows at `key` belong before the end. `quotas`
    maps stratum sizes to ascending end ranks. Two passes: counts by hash prefix (at most 4096 small rows
    a stratum), then counts by key within the prefixes that hold an end. The driver sees a size and a
    few ends of each stratum; plans don't grow with their number.
    """
    spark = df.sparkSession
    keyed = df.select(stratum.alias("stratum"), opaque(key).alias("key")).withColumn(
        "prefix", F.substring("key", 1, PREFIX_DIGITS)
    )
    counts = materialize(keyed.groupBy("stratum", "prefix").agg(F.count(F.lit(1)).alias("n")))
    sizes = {row.stratum: row.n for row in counts.groupBy("stratum").agg(F.sum("n").alias("n")).collect()}
    ranks = quotas(sizes)
    cuts: dict[str, list[tuple]] = {}
    wanted = [(s, i, end) for s, of in ranks.items() for i, end in enumerate(of) if 0 < end < sizes[s]]
    if wanted:
        ends = _small(spark.createDataFrame(wanted, "stratum string, i int, end long"), len(wanted))
        before = Window.partitionBy("stratum").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
        running = counts.withColumn("cum_n", F.sum("n").over(before)).join(ends, "stratum")
        held = running.filter("cum_n >= end AND cum_n - n < end")
        held = held.select("stratum", "prefix", "i", (F.col("end") - F.col("cum_n") + F.col("n")).alias("rank"), "n").collect()

        scopes = {(row.stratum, row.prefix): row.n for row in held}
        inside = _small(spark.createDataFrame(list(scopes), "stratum string, prefix string"), len(scopes))
        keys = keyed.join(inside, ["stratum", "prefix"]).groupBy("stratum", "prefix", "key").agg(F.count(F.lit(1)).alias("n"))
        at_most = sum(scopes.values())
        if at_most > ROWS_PER_BUCKET:
            keys = materialize(keys)
        position = F.conv(F.substring("key", 1, 13), 16, 10).cast("double")
        running = cumulate(keys, "key", ["n"], by=["stratum", "prefix"], position=position, at_most=at_most)
        local = spark.createDataFrame([tuple(row)[:4] for row in held], "stratum string, prefix string, i int, rank long")
        found = running.join(_small(local, len(held)), ["stratum", "prefix"]).filter("cum_n >= rank AND cum_n - n < rank")
        for row in found.select("stratum", "key", "i", (F.col("rank") - F.col("cum_n") + F.col("n")).alias("taken"), "n").collect():
            cuts.setdefault(row.stratum, []).append(tuple(row)[1:])
    rows = [(s, sum(1 for end in of if end <= 0), sorted(cuts.get(s, []))) for s, of in ranks.items()]
    schema = "stratum string, base int, cuts array<struct<key: string, i: int, taken: long, copies: long>>"
    torn = {(s, key) for s, of in cuts.items() for key, _, taken, copies in of if taken < copies}
    return spark.createDataFrame(rows, schema), len(rows), len(torn)


def _is_torn(cut: Column) -> Column:
    return cut["taken"] < cut["copies"]


def assign_segments(
    df: DataFrame, key: Column, stratum: Column, quotas: Quotas, out: str = "segment", keyed: DataFrame | None = None
) -> DataFrame:
    """Labels each row with the number of slices that end before it, per stratum in key order.

    `key` may repeat only on exact copies (row_key does so). Where a slice ends within the copies of
    one row, each side gets its exact number of them. Rows meet the cut table in a join that broadcasts
    it, up to BROADCAST_ROWS_MAX strata. `keyed`, if given, is a smaller table with the same keys and
    strata, as columns of the names `key` and `stratum`, to find the cuts from.
    """
    if keyed is None:
        table, strata, torn = find_cuts(df, key, stratum, quotas)
    else:
        table, strata, torn = find_cuts(keyed, F.col("key"), F.col("stratum"), quotas)
    cuts = table.select(F.col("stratum").alias("__stratum"), F.col("base").alias("__base"), F.col("cuts").alias("__cuts"))
    rows = df.withColumns({"__key": opaque(key), "__stratum": stratum}).join(_small(cuts, strata), "__stratum", "left")
    label = F.col("__base") + F.size(F.filter("__cuts", lambda c: c["key"] < F.col("__key")))
    helpers = ["__key", "__stratum", "__base", "__cuts"]
    order = [*df.columns, out] if out not in df.columns else df.columns
    if not torn:
        return rows.withColumn(out, label).drop(*helpers).select(*[F.col(f"`{c}`") for c in order])

    at_torn = F.coalesce(F.exists("__cuts", lambda c: (c["key"] == F.col("__key")) & _is_torn(c)), F.lit(False))
    whole = rows.filter(~at_torn).withColumn(out, label).drop(*helpers)
    dealt = _deal_copies(rows.filter(at_torn), torn, out).drop(*helpers)
    return whole.unionByName(dealt).select(*[F.col(f"`{c}`") for c in order])


def _deal_copies(rows: DataFrame, torn: int, out: str) -> DataFrame:
    """One row per distinct copy group, repeated to its exact number per segment.

    Copies collapse before the shuffle and are dealt out again in chunks across all tasks.
    """
    hidden = [c for c in rows.columns if c != "__cuts"]
    single = materialize(rows.groupBy(*[F.col(f"`{c}`") for c in hidden]).agg(F.any_value("__cuts").alias("__cuts")))
    if single.count() != torn:
        raise ValueError("the order key is shared by rows that are not copies of each other")
    here = F.filter("__cuts", lambda c: c["key"] == F.col("__key"))
    first = F.col("__base") + F.size(F.filter("__cuts", lambda c: c["key"] < F.col("__key")))

    def share(j: Column) -> Column:
        """Copies between the end before and the j-th end here; the last share reaches to the last copy."""
        done = F.when(j > 0, F.get(F.col("__here"), (j - 1).cast("int"))["taken"]).otherwise(F.lit(0))
        upto = F.coalesce(F.get(F.col("__here"), j.cast("int"))["taken"], F.get(F.col("__here"), F.lit(0))["copies"])
        return F.struct((F.col("__first") + j).cast("int").alias("segment"), (upto - done).alias("n"))

    shared = single.withColumns({"__here": here, "__first": first})
    shares = F.filter(F.transform(F.sequence(F.lit(0), F.size("__here")), share), lambda s: s["n"] > 0)
    last_chunk = F.expr(f"(__share.n - 1) div {COPIES_PER_TASK}")
    columns = [F.col(f"`{c}`") for c in rows.columns if c != out]
    return (
        shared.select(*columns, F.explode(shares).alias("__share"))
        .select(*columns, "__share", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)).alias("__chunk"))
        .repartition("__share", "__chunk")
        .withColumn("__n", F.least(F.lit(COPIES_PER_TASK), F.expr(f"__share.n - __chunk * {COPIES_PER_TASK}")))
        .select(*columns, F.col("__share.segment").alias(out), F.explode(F.expr("sequence(1L, __n)")).alias("__i"))
        .drop("__i")
    )
