"""Benchmark decontamination by size-partitioned MinHash containment search, verified on exact shingles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.frames import small_batches, stored
from riskloom.llm.text import distinct, sequence_hashes, word_hashes

WIDTH = 5
CONTAINMENT = 0.75
# Items up to which sketches and shingles travel with the tasks; larger benchmarks go by shuffled parts.
ITEM_SHINGLES = 2_000_000


def size_class(n: int) -> int:
    """Items of 2**k to 2**(k+1) - 1 shingles share a partition."""
    return n.bit_length()


def sketch_size(n: int, containment: float) -> int:
    """Least hashes of which an item of n shingles must share one with any text that holds enough of it.

    All items of a size class take the number that its largest size needs, at most all their own.
    """
    largest = (1 << size_class(n)) - 1
    return min(n, int((1 - containment) * largest + 1e-9) + 1)


def item_sets(column: pa.Array, width: int) -> list[tuple[int, np.ndarray]]:
    """Shingle width (fewer words than `width`: their number) and distinct shingles of each item."""
    words, first = word_hashes(column)
    sets = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        w = int(min(width, b - a))
        sets.append((w, distinct(sequence_hashes(words[a:b], w)) if w else np.zeros(0, np.uint64)))
    return sets


class Sketches:
    """Of one shingle width: the least hashes of all items, by size class, ready for lookup."""

    def __init__(self, items: list[tuple[int, np.ndarray]], containment: float):
        self.items, self.containment = items, containment
        keys = [s[: sketch_size(len(s), containment)] for _, s in items]
        flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(items)), [len(k) for k in keys])
        order = np.argsort(flat, kind="stable")
        self.keys, self.owner = flat[order], owner[order]
        # A first sieve by 20 bits of the hash spares most lookups.
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def candidates(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the shingles that are in a sketch, and the item of each."""
        at = np.flatnonzero(self.sieve[(shingles >> np.uint64(44)).astype(np.int64)])
        low = np.searchsorted(self.keys, shingles[at], "left")
        high = np.searchsorted(self.keys, shingles[at], "right")
        n = high - low
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(at, n), self.owner[np.repeat(low, n) + inside]


def _search(texts: pa.Array, sketches: dict[int, Sketches]):
    """(row, item id, shared, item shingles) of each verified pair of the batch."""
    words, first = word_hashes(texts)
    for width, sketch in sketches.items():
        every = sequence_hashes(words, width)
        at, items = sketch.candidates(every)
        rows = np.searchsorted(first, at, "right") - 1
        inside = at + width <= first[np.minimum(rows + 1, len(first) - 1)]
        rows, items = rows[inside], items[inside]
        pairs = np.unique(np.stack([rows, items], 1), axis=0) if len(rows) else np.zeros((0, 2), int)
        row, own = -1, np.zeros(0, np.uint64)
        for r, k in pairs:
            if r != row:
                row, own = r, distinct(every[first[r] : first[r + 1] - width + 1])
            item, shingles = sketch.items[k]
            at = np.minimum(np.searchsorted(own, shingles), len(own) - 1)
            shared = int((own[at] == shingles).sum())
            if shared >= sketch.containment * len(shingles):
                yield int(r), item, shared, len(shingles)


def _benchmark_parts(benchmark: DataFrame, item_id: str, item_text: str, width: int, item_shingles: int) -> tuple[list, pa.DataType]:
    """Broadcast items, {width: [(id, shingles)]}, in parts of about `item_shingles` shingles; and the ids' type."""
    spark = benchmark.sparkSession
    kind = benchmark.schema[item_id].dataType.simpleString()

    def shingle(batches):
        for batch in batches:
            sets = item_sets(batch.column(1), width)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([w for w, _ in sets], pa.int32()), pa.array([s.tobytes() for _, s in sets], pa.binary())],
                ["item_id", "width", "shingles"],
            )

    items = benchmark.select(F.col(item_id), F.col(item_text).cast("string"))
    items = stored(items.mapInArrow(shingle, f"item_id {kind}, width int, shingles binary").filter("width > 0"), "items")
    total = items.agg(F.sum(F.octet_length("shingles") / 8)).first()[0] or 0
    parts = []
    for k in range(max(1, -(-int(total) // item_shingles))):
        share = F.pmod(F.xxhash64("item_id", "shingles"), F.lit(max(1, -(-int(total) // item_shingles)))) == k
        own: dict[int, list] = {}
        for row in items.filter(share).collect():
            own.setdefault(row["width"], []).append((row["item_id"], np.frombuffer(row["shingles"], np.uint64)))
        parts.append(spark.sparkContext.broadcast(own))
    return parts, items.select("item_id").limit(0).toArrow().schema.field(0).type


def find_contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    containment: float = CONTAINMENT,
    width: int = WIDTH,
    item_shingles: int = ITEM_SHINGLES,
) -> DataFrame:
    """(doc_id, item_id, shared, item_shingles) where a text holds `containment` of an item's shingles.

    Shingles are `width` successive words (runs of non-blank characters, A-Z lowered), each counted
    once; an item of fewer words is one shingle of all of them. Items are partitioned by number of
    shingles, and a partition's sketch keeps so many least hashes that a text that holds enough of
    an item must hold one of them: no pair is lost. Each pair met is checked on all shingles of both.
    Null and empty texts and items match nothing; repeated rows are reported each; empty tables give
    an empty one.

    Documents are read once for each part of the benchmark and never shuffled. A part holds about
    `item_shingles` shingles, so what travels to the tasks is bounded however large the benchmark is.
    """
    small_batches(documents.sparkSession)
    parts, item_type = _benchmark_parts(benchmark, item_id, item_text, width, item_shingles)
    item_kind = benchmark.schema[item_id].dataType.simpleString()
    schema = f"doc_id {documents.schema[doc_id].dataType.simpleString()}, item_id {item_kind}, shared int, item_shingles int"

    def part(sent) -> DataFrame:
        def search(batches):
            sketches = {w: Sketches(rows, containment) for w, rows in sent.value.items()}
            for batch in batches:
                found = list(_search(batch.column(1), sketches))
                rows, ids, shared, sizes = zip(*found, strict=True) if found else ([], [], [], [])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int32())), pa.array(ids, item_type), pa.array(shared, pa.int32()), pa.array(sizes, pa.int32())],
                    ["doc_id", "item_id", "shared", "item_shingles"],
                )

        return documents.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(search, schema)

    found = part(parts[0])
    for sent in parts[1:]:
        found = found.union(part(sent))
    return found


def drop_contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    containment: float = CONTAINMENT,
    width: int = WIDTH,
    item_shingles: int = ITEM_SHINGLES,
) -> DataFrame:
    """The rows, with all columns, that `find_contaminated` reports with no item; decided row by row."""
    small_batches(documents.sparkSession)
    place = documents.columns.index(text)
    parts, _ = _benchmark_parts(benchmark, item_id, item_text, width, item_shingles)

    def part(rows: DataFrame, sent) -> DataFrame:
        def keep(batches):
            sketches = {w: Sketches(items, containment) for w, items in sent.value.items()}
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[r for r, *_ in _search(batch.column(place).cast("string"), sketches)]] = False
                yield batch.filter(pa.array(clean))

        return rows.mapInArrow(keep, documents.schema)

    for sent in parts:
        documents = part(documents, sent)
    return documents
