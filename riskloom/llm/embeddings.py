"""Embedding near-dedup by an epsilon grid order join."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.components import components
from riskloom.llm.frames import small_batches, stored
from riskloom.llm.text import ragged

COSINE = 0.93
# Leading principal dimensions of the grid, and the bound of the sample that they are fit on.
GRID_DIMS = 6
SAMPLE_ROWS = 4_096
BLOCK_ROWS = 512
LEAF_ROWS = 32


def _units(column: pa.Array) -> list[np.ndarray | None]:
    """Each vector at length 1 in double precision; None for null, zero and non-finite ones."""
    out: list[np.ndarray | None] = []
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    at = np.cumsum([0, *pc.fill_null(pc.list_value_length(column), 0).to_pylist()])
    for low, high in zip(at[:-1], at[1:], strict=True):
        v = flat[low:high]
        largest = np.abs(v).max() if high > low else 0.0
        if largest > 0 and np.isfinite(largest):
            v = v / largest
            out.append(v / np.sqrt(v @ v))
        else:
            out.append(None)
    return out


def principal_axes(units: list[np.ndarray], dims: int) -> dict[int, np.ndarray]:
    """By vector length, orthonormal columns of most spread; projecting on them never adds distance."""
    axes = {}
    for size in {len(u) for u in units}:
        own = np.stack([u for u in units if len(u) == size])
        _, _, rows = np.linalg.svd(own - own.mean(0), full_matrices=False)
        axes[size] = np.linalg.qr(rows[:dims].T)[0]
    return axes


def _project(vectors: np.ndarray, axes: dict[int, np.ndarray], dims: int) -> np.ndarray:
    size = vectors.shape[1]
    seen = vectors @ axes[size] if size in axes else vectors[:, :dims]
    return np.pad(seen, ((0, 0), (0, dims - seen.shape[1])))


def _join(a: np.ndarray, b: np.ndarray, pa_: np.ndarray, pb: np.ndarray, cosine: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Linked positions of two blocks in grid order, each pair once; halves whose boxes lie too far apart are skipped."""
    reach = 2 - 2 * cosine + 1e-9
    found: list[tuple[np.ndarray, np.ndarray]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        if same and m <= i:
            continue
        gap = np.maximum(pa_[i:j].min(0) - pb[k:m].max(0), pb[k:m].min(0) - pa_[i:j].max(0))
        if (np.maximum(gap, 0) ** 2).sum() > reach:
            continue
        if j - i <= LEAF_ROWS and m - k <= LEAF_ROWS:
            x, y = np.nonzero(a[i:j] @ b[k:m].T >= cosine)
            x, y = x + i, y + k
            if same:
                x, y = x[x < y], y[x < y]
            found.append((x, y))
            continue
        left = [(i, j)] if j - i <= LEAF_ROWS else [(i, (i + j) // 2), ((i + j) // 2, j)]
        right = [(k, m)] if m - k <= LEAF_ROWS else [(k, (k + m) // 2), ((k + m) // 2, m)]
        todo += [(*x, *y) for x in left for y in right]
    if not found:
        return np.zeros(0, int), np.zeros(0, int)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _spanning(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """Least node that links reach, for each of n nodes."""
    low = np.arange(n)
    while True:
        least = np.minimum(low[x], low[y])
        new = low.copy()
        np.minimum.at(new, x, least)
        np.minimum.at(new, y, least)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def near_duplicate_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
    dims: int = GRID_DIMS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row; links join rows of equal label and length.

    Rows link from a cosine of `cosine`, in double precision. Null, empty, zero and non-finite vectors
    and null labels link with nothing. Each row is a vector of its own, also one that repeats another;
    component_id is the least vec_id that links reach. An empty table gives an empty one.

    Equal vectors of a label are joined once and counted by their number. The rest is sorted by label
    and grid cell over all tasks and cut into blocks of `block_rows`. Blocks meet if their boxes come
    near enough in the leading dimensions, as one row a pair, so a hot label spreads over all tasks;
    a task halves the blocks, skips distant halves and compares the rest. It returns sums and
    spanning links, never all pairs.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    epsilon = float(np.sqrt(2 - 2 * cosine))

    def normalise(batches):
        for batch in batches:
            units = _units(batch.column(1))
            keys = [hashlib.blake2b(u.tobytes(), digest_size=16).digest() if u is not None else None for u in units]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([u.tobytes() if u is not None else None for u in units], pa.binary()), pa.array(keys, pa.binary())],
                ["vec_id", "label", "unit", "key"],
            )

    id_kind, label_kind = (vectors.schema[c].dataType.simpleString() for c in (vec_id, label))
    rows = vectors.select(F.col(vec_id), F.col(embedding), F.col(label))
    rows = stored(rows.mapInArrow(normalise, f"vec_id {id_kind}, label {label_kind}, unit binary, key binary"), "vectors")
    usable = rows.filter("label IS NOT NULL AND key IS NOT NULL AND vec_id IS NOT NULL")
    classes = usable.groupBy("label", "key").agg(F.min("vec_id").alias("id"), F.count("*").alias("rows"), F.first("unit").alias("unit"))
    classes = stored(classes.withColumn("size", F.octet_length("unit")), "classes")
    sample = classes.orderBy(F.xxhash64("key"), "label").limit(SAMPLE_ROWS).select("unit").collect()
    axes = principal_axes([np.frombuffer(r[0]) for r in sample], dims)

    def _cells(matrix):
        return np.floor(_project(matrix, axes, dims) / epsilon).astype(np.int64)

    def grid(batches):
        for batch in batches:
            units = batch.column("unit").to_pylist()
            if len({len(u) for u in units}) == 1:
                cells = list(_cells(np.frombuffer(b"".join(units)).reshape(len(units), -1)))
            else:
                cells = [_cells(np.frombuffer(u)[None])[0] for u in units]
            yield batch.append_column("cells", ragged(cells, pa.int32()))

    celled = classes.select("label", "size", "id", "rows", "unit").mapInArrow(
        grid, f"label {label_kind}, size int, id {id_kind}, rows long, unit binary, cells array<int>"
    )
    order = ["label", "size", "cells", "id"]
    celled = stored(celled, "cells").repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(batches):
        held: list[tuple] = []

        def block():
            _, size = held[0][:2]
            ids = np.array([r[2] for r in held], np.int64)
            matrix = np.frombuffer(b"".join(r[4] for r in held)).reshape(len(held), size // 8)
            seen = _project(matrix, axes, dims)
            arrays = [
                pa.array([held[0][0]], label_type), pa.array([size], pa.int32()), pa.array([int(ids[0])]), ragged([ids], pa.int64()),
                ragged([np.array([r[3] for r in held], np.int64)], pa.int64()), pa.array([matrix.tobytes()], pa.binary()),
                ragged([seen.min(0)], pa.float64()), ragged([seen.max(0)], pa.float64()),
            ]
            return pa.RecordBatch.from_arrays(arrays, ["label", "size", "block", "ids", "rows", "matrix", "low", "high"])

        for batch in batches:
            label_type = batch.column(0).type
            for row in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if held and (row[:2] != held[0][:2] or len(held) >= block_rows):
                    yield block()
                    held = []
                held.append(row)
        if held:
            yield block()

    blocks = celled.mapInArrow(
        cut,
        f"label {label_kind}, size int, block long, ids array<long>, rows array<long>, matrix binary, low array<double>, high array<double>",
    )
    blocks = stored(blocks, "blocks")

    # A block's name is its first id: each id is in one block of its label.
    boxes = blocks.select("label", "size", "block", "low", "high")
    strip = F.floor(F.col("low")[0] / epsilon), F.floor(F.col("high")[0] / epsilon)
    left = boxes.withColumn("strip", F.explode(F.sequence(strip[0], strip[1])))
    right = boxes.withColumn("strip", F.explode(F.sequence(strip[0] - 1, strip[1] + 1)))
    right = right.select("label", "size", "strip", F.col("block").alias("other"), F.col("low").alias("other_low"), F.col("high").alias("other_high"))
    gap = lambda k: F.greatest(F.col("low")[k] - F.col("other_high")[k], F.col("other_low")[k] - F.col("high")[k], F.lit(0.0))
    near = sum((gap(k) * gap(k) for k in range(dims)), F.lit(0.0)) <= epsilon**2 + 1e-9
    pairs = left.join(right, ["label", "size", "strip"]).filter("block <= other").filter(near)
    pairs = pairs.select("label", "size", "block", "other").distinct()
    data = blocks.select("label", "size", "block", "ids", "rows", "matrix")
    pairs = pairs.join(data, ["label", "size", "block"])
    pairs = pairs.join(data.select("label", "size", F.col("block").alias("other"), *(F.col(c).alias(f"other_{c}") for c in ("ids", "rows", "matrix"))), ["label", "size", "other"])
    pairs = pairs.select("size", "block", "other", "ids", "rows", "matrix", "other_ids", "other_rows", "other_matrix")

    def link(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                size, block, other = (batch.column(c)[k].as_py() for c in range(3))
                ids, weight, oid, oweight = (batch.column(c)[k].values.to_numpy() for c in (3, 4, 6, 7))
                a, b = (np.frombuffer(batch.column(c)[k].as_py()).reshape(-1, size // 8) for c in (5, 8))
                x, y = _join(a, b, _project(a, axes, dims), _project(b, axes, dims), cosine, block == other)
                names = ids if block == other else np.concatenate([ids, oid])
                shift = 0 if block == other else len(ids)
                links = np.bincount(x, oweight[y], len(names)) + np.bincount(y + shift, weight[x], len(names))
                low = _spanning(x, y + shift, len(names))
                hit = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[hit]), pa.array(links[hit].astype(np.int64)), pa.array(names[low[hit]])], ["id", "links", "low"]
                )

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    linked = stored(pairs.mapInArrow(link, "id long, links long, low long"), "links")
    small_batches(spark)
    # A class id can stand in several labels only if ids repeat; such rows share a component by definition.
    groups = components(linked.select(F.col("id").alias("u"), F.col("low").alias("v")))
    counts = linked.groupBy("id").agg(F.sum("links").alias("links"))
    classes = classes.select("label", "key", "id", "rows").join(counts, "id", "left")
    classes = classes.join(groups, classes["id"] == groups["node"], "left")
    classes = classes.select("label", "key", "id", (F.col("rows") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    member = rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("label")).alias("label"), "key").join(classes, ["label", "key"], "left")
    return member.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").cast("long").alias("component_id"),
        (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"),
    )
