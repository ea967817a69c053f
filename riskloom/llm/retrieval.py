"""Ranked lexical search: term-at-a-time sums of short lists, then document-at-a-time over long ones.

An index block holds the postings of some thousand documents for the terms that queries ask for. In a
block, a query's short lists are summed into accumulators; these then stand beside the long lists as
one more list with bounds. Spans of documents are visited in order, and a span, a document or the rest
of its long lists is skipped once bounds show that it can't reach the best scores found so far.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.frames import bounded_batches, stored
from riskloom.llm.text import ragged, run_hashes

# Fixed values of the score: weights in thousandths, saturation and length shares in hundredths.
SCALE, UNIT, SATURATION, LENGTH_SHARE = 1000, 1_000_000_000, 12, 25
TOP = 20
# Bounds of an index block, and documents a span that is skipped or visited as one.
BLOCK_ROWS, BLOCK_POSTINGS = 8192, 2_000_000
SPAN = 64
# Spans looked at between two looks at the best scores so far.
SPANS_AT_ONCE = 16
# A list is long in a block if more than this share of the block's documents hold its term.
LONG_SHARE = 1 / 32
# Terms of all queries, repeats within one not counted, that are sent to tasks at once: about 24 bytes each.
QUERY_TERMS = 500_000
NO_TERM = np.zeros(0, np.int64)


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all terms in order, and where each text's begin."""
    found, first = run_hashes(texts, lower=True, marks=False)
    return found.view(np.int64), first


class Counted:
    """Rows of (document, term, times) of a task, cut into blocks."""

    def __init__(self, wanted: np.ndarray | None) -> None:
        self.wanted = wanted
        self.clear()

    def clear(self) -> None:
        self.ids, self.sizes, self.parts, self.rows, self.postings = [], [], [], 0, 0

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        terms, first = _terms(texts)
        size = np.diff(first)
        rows = np.repeat(np.arange(len(size)), size)
        if self.wanted is not None:
            at = np.minimum(np.searchsorted(self.wanted, terms), max(0, len(self.wanted) - 1))
            asked = self.wanted[at] == terms if len(self.wanted) else np.zeros(len(terms), bool)
            rows, terms = rows[asked], terms[asked]
        order = np.lexsort((rows, terms))
        rows, terms = rows[order], terms[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (terms[1:] != terms[:-1])
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(rows)))
        # Documents without terms rank nowhere and count nowhere.
        holds = size > 0
        place = np.cumsum(holds) - 1 + self.rows
        self.ids.append(ids.filter(pa.array(holds)))
        self.sizes.append(size[holds])
        self.parts.append((place[rows[at]], terms[at], times))
        self.rows += int(holds.sum())
        self.postings += len(at)

    def block(self) -> tuple:
        """Ids, sizes, distinct terms, their ends, and documents and times of all postings, term by term."""
        rows, terms, times = (np.concatenate([p[i] for p in self.parts]) for i in range(3))
        order = np.lexsort((rows, terms))
        terms = terms[order]
        last = np.ones(len(terms), bool)
        last[:-1] = terms[1:] != terms[:-1]
        ends = np.flatnonzero(last) + 1
        return pa.concat_arrays(self.ids), np.concatenate(self.sizes), terms[last], ends, rows[order], times[order]


def build_index(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", wanted=None) -> DataFrame:
    """A stored index, a row a block: ids, sizes, terms, ends, docs, times. `wanted`: a broadcast of the terms to keep."""
    kind = documents.schema[doc_id].dataType.simpleString()
    schema = f"ids array<{kind}>, sizes array<long>, terms array<long>, ends array<long>, docs array<int>, times array<long>"
    names = ["ids", "sizes", "terms", "ends", "docs", "times"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = Counted(None if wanted is None else wanted.value)

        def full() -> pa.RecordBatch:
            ids, *arrays = counted.block()
            counted.clear()
            lists = [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)]
            lists += [ragged([a], pa.int32() if name == "docs" else pa.int64()) for a, name in zip(arrays, names[1:], strict=True)]
            return pa.RecordBatch.from_arrays(lists, names)

        for batch in batches:
            counted.add(batch.column(0), batch.column(1))
            if counted.rows >= BLOCK_ROWS or counted.postings >= BLOCK_POSTINGS:
                yield full()
        if counted.rows:
            yield full()

    with bounded_batches(documents.sparkSession):
        return stored(documents.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(read, schema), "index")


class Block:
    """Lists of an index block as score parts: term -> documents and parts, the long ones spread out with bounds."""

    def __init__(self, row: dict, documents: int, terms: int) -> None:
        self.sizes, self.terms, ends, docs, times = (
            row[c].values.to_numpy(zero_copy_only=False).astype(np.int64) for c in ("sizes", "terms", "ends", "docs", "times")
        )
        if len(self.sizes) and int(self.sizes.max()) * documents * LENGTH_SHARE >= 1 << 62:
            share = np.array([LENGTH_SHARE * int(n) * documents // terms for n in self.sizes], np.int64)
        else:
            share = (LENGTH_SHARE * self.sizes * documents) // terms
        length = 100 - LENGTH_SHARE + share
        self.parts = (UNIT * times) // (SCALE * times + SATURATION * length[docs])
        self.docs, self.ends, self.begins = docs, ends, np.concatenate([np.zeros(1, np.int64), ends[:-1]])
        self.spans = -(-len(self.sizes) // SPAN)
        self.spread: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def long(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Parts of all documents of the block, zero where the term is absent, and the largest of each span."""
        if k not in self.spread:
            parts = np.zeros(self.spans * SPAN, np.int64)
            low, high = self.begins[k], self.ends[k]
            parts[self.docs[low:high]] = self.parts[low:high]
            self.spread[k] = parts, parts.reshape(-1, SPAN).max(axis=1)
        return self.spread[k]

    def search(self, terms: np.ndarray, factors: np.ndarray, top: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores that may be among the `top` of at least `floor`; ties with the last may be more."""
        at = np.minimum(np.searchsorted(self.terms, terms), max(0, len(self.terms) - 1))
        here = (self.terms[at] == terms) & (factors > 0) if len(self.terms) else np.zeros(len(terms), bool)
        lists, factors = at[here], factors[here]
        if not len(lists):
            return NO_TERM, NO_TERM
        short = (self.ends[lists] - self.begins[lists]) <= LONG_SHARE * len(self.sizes)
        sums = np.zeros(self.spans * SPAN, np.int64)
        for k, factor in zip(lists[short], factors[short], strict=True):
            low, high = self.begins[k], self.ends[k]
            sums[self.docs[low:high]] += factor * self.parts[low:high]
        long = [(factor, *self.long(k)) for k, factor in zip(lists[~short], factors[~short], strict=True)]
        long.sort(key=lambda x: -x[0] * int(x[2].max()))
        # What the lists from the i-th on can add at most, for each span.
        rest = np.zeros((len(long) + 1, self.spans), np.int64)
        for i in range(len(long) - 1, -1, -1):
            rest[i] = rest[i + 1] + long[i][0] * long[i][2]
        bound = sums.reshape(-1, SPAN).max(axis=1) + rest[0]
        docs, scores = NO_TERM, NO_TERM
        for low in range(0, self.spans, SPANS_AT_ONCE):
            spans = np.arange(low, min(low + SPANS_AT_ONCE, self.spans))
            spans = spans[bound[spans] >= floor]
            if not len(spans):
                continue
            own = (spans[:, None] * SPAN + np.arange(SPAN)).ravel()
            span = np.repeat(spans, SPAN)
            total = sums[own]
            for i, (factor, parts, _) in enumerate(long):
                able = total + rest[i][span] >= floor
                if not able.all():
                    own, span, total = own[able], span[able], total[able]
                    if not len(own):
                        break
                total = total + factor * parts[own]
            good = total >= floor
            docs, scores = np.concatenate([docs, own[good]]), np.concatenate([scores, total[good]])
            if len(scores) > top:
                floor = max(floor, int(np.partition(scores, len(scores) - top)[len(scores) - top]))
                keep = scores >= floor
                docs, scores = docs[keep], scores[keep]
        return docs, scores


def _query_terms(queries: DataFrame, item_id: str, text: str) -> DataFrame:
    """Stored (item, term, times): the terms of each query, repeats counted."""
    kind = queries.schema[item_id].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, first = _terms(batch.column(1))
            rows = pa.array(np.repeat(np.arange(batch.num_rows), np.diff(first)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(2).take(rows), pa.array(terms)], ["item_id", "row", "term"])

    with bounded_batches(queries.sparkSession):
        # Rows of one id are queries of their own: the tag is fixed once it is stored.
        rows = queries.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text"))
        rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "queries").select("item_id", "text", "row")
        found = rows.mapInArrow(read, f"item_id {kind}, row long, term long")
        return stored(found.groupBy("item_id", "row", "term").agg(F.count("*").alias("times")), "query-terms")


def _best(found: DataFrame, top: int) -> DataFrame:
    """The `top` rows of each query; Spark keeps no more than that of a task before the shuffle."""
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def rank_documents(
    documents: DataFrame,
    queries: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    query_terms: int = QUERY_TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` best documents of each query with a score above 0.

    Terms are runs of letters, digits and non-ASCII characters, A-Z lowered, compared by 64-bit
    fingerprints. A term's weight is floor(1000 ln((2N+2) / (2 df + 1))), its part in a document
    1e9 tf div (1000 tf + 12 m) with m = 75 + 25 n N div L; N documents have terms, L in all, n in this
    one. Scores sum weight times part over the query's terms, repeats included; equal scores go by
    ascending id, null ids last, and equal ids in any order. Every row of `documents` and of `queries`
    counts for itself. Null, empty and term-free texts rank nowhere and find nothing; empty tables
    give an empty result. Other columns are not read.

    Texts are read once, into blocks of bounded size with the lists that queries ask for (all lists if
    the queries' terms go in several parts of `query_terms`). A task carries its best scores from block
    to block and puts out `top` rows a query at most.
    """
    spark = documents.sparkSession
    kind, item_kind = documents.schema[doc_id].dataType, queries.schema[item_id].dataType
    asked = _query_terms(queries, item_id, item_text)
    count = asked.count()
    parts = max(1, -(-count // query_terms))
    wanted = None
    if parts == 1:
        terms = asked.select("term").distinct().toArrow().column(0).to_numpy()
        wanted = spark.sparkContext.broadcast(np.sort(terms))
    index = build_index(documents, doc_id, text, wanted)
    sizes = index.select(F.sum(F.size("ids").cast("long")), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda s, n: s + n))).first()
    total, length = sizes[0] or 0, sizes[1] or 0

    # Lists lie term by term, so a list's length is the distance between two ends.
    lengths = F.transform("ends", lambda end, i: end - F.when(i > 0, F.get("ends", i - 1)).otherwise(F.lit(0)))
    found = index.select(F.explode(F.arrays_zip(F.col("terms").alias("term"), lengths.alias("n"))).alias("list"))
    found = found.select(F.col("list.term").alias("term"), F.col("list.n").alias("n"))
    found = found.groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(F.lit(float(SCALE)) * F.log((F.lit(2 * total + 2).cast("double")) / (2 * F.col("df") + 1)))
    weighted = asked.join(found, "term").select("item_id", "row", "term", (F.col("times") * weight).alias("factor"))
    weighted = stored(weighted, "weights")

    schema = f"item_id {item_kind.simpleString()}, row long, doc_id {kind.simpleString()}, score long"
    results = []
    for k in range(parts if total else 0):
        own = weighted.filter(F.pmod(F.xxhash64("row"), F.lit(parts)) == k).orderBy("row").toArrow()
        sent = spark.sparkContext.broadcast(own)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            yield from _searched(batches, sent.value, total, length, top)

        with bounded_batches(spark, rows=1):  # a row is a whole block
            results.append(stored(_best(index.mapInArrow(search, schema), top), "found"))
        sent.destroy()
    if wanted is not None:
        wanted.destroy()
    if not results:
        return spark.createDataFrame([], f"item_id {item_kind.simpleString()}, rank int, doc_id {kind.simpleString()}, score long")
    return reduce(DataFrame.union, results).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _in_order(ids: pa.Array, scores: np.ndarray) -> np.ndarray:
    """Places by falling score, then rising id, null ids last."""
    keys = [("score", "descending"), ("id", "ascending")]
    return pc.sort_indices(pa.table({"id": ids, "score": pa.array(scores)}), sort_keys=keys).to_numpy()


def _searched(batches: Iterator[pa.RecordBatch], sent: pa.Table, documents: int, terms: int, top: int) -> Iterator[pa.RecordBatch]:
    """Best rows of all queries over a task's blocks."""
    rows, term, factor = (sent.column(c).to_numpy() for c in ("row", "term", "factor"))
    turns = np.append(np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else NO_TERM, len(rows))
    items = sent.column("item_id").combine_chunks() if len(rows) else None
    best: list[tuple[np.ndarray, np.ndarray]] = [(NO_TERM, NO_TERM)] * (len(turns) - 1)
    ids, before = None, 0
    for batch in batches:
        for row in range(batch.num_rows):
            lists = {c: batch.column(c).slice(row, 1).flatten() for c in batch.schema.names}
            block = Block({c: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for c, v in lists.items()}, documents, terms)
            own = []
            seen = pa.concat_arrays([ids, lists["ids"]]) if before else lists["ids"]
            for q in range(len(turns) - 1):
                places, scores = best[q]
                floor = max(1, int(scores.min())) if len(scores) >= top else 1
                low, high = turns[q], turns[q + 1]
                docs, new = block.search(term[low:high], factor[low:high], top, floor)
                if len(docs):
                    places, scores = np.concatenate([places, docs + before]), np.concatenate([scores, new])
                    if len(scores) > top:
                        # Only rows that tie with the last need their ids.
                        keep = scores >= np.partition(scores, len(scores) - top)[len(scores) - top]
                        places, scores = places[keep], scores[keep]
                    if len(scores) > top:
                        keep = _in_order(seen.take(pa.array(places)), scores)[:top]
                        places, scores = places[keep], scores[keep]
                    best[q] = places, scores
                own.append(best[q][0])
            # Only ids that are still among the best are kept on.
            used = np.unique(np.concatenate(own)) if own else NO_TERM
            ids = seen.take(pa.array(used))
            best = [(np.searchsorted(used, places), scores) for places, scores in best]
            before = len(used)
    if ids is None or items is None:
        return
    for q, (places, scores) in enumerate(best):
        at = np.full(len(places), turns[q])
        yield pa.RecordBatch.from_arrays(
            [items.take(pa.array(at)), pa.array(rows[at]), ids.take(pa.array(places)), pa.array(scores)],
            ["item_id", "row", "doc_id", "score"],
        )
