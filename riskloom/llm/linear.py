"""Linear models over fingerprints of terms: bounded training samples, and scoring of all rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.frames import small_batches
from riskloom.llm.text import distinct, ragged, run_hashes, sequence_hashes

Terms = Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Term fingerprints and the row of each: lower-case words without marks."""
    runs, first = run_hashes(column, lower=True, marks=False)
    return runs, np.repeat(np.arange(len(first) - 1), np.diff(first))


def runs_and_pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Runs of letters or of marks as written, and pairs of neighbours."""
    runs, first = run_hashes(column, lower=False, marks=True)
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    pairs = sequence_hashes(runs, 2)
    same = rows[1:] == rows[:-1]
    return np.concatenate([runs, pairs[same]]), np.concatenate([rows, rows[:-1][same]])


def sample_terms(documents: DataFrame, doc_id: str, text: str, chosen: DataFrame, terms: Terms) -> list[tuple]:
    """(label, distinct terms) of the chosen rows (id, label); `chosen` is bounded by its maker."""
    small_batches(documents.sparkSession)
    rows = documents.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    rows = rows.join(F.broadcast(chosen), "id").select("label", "text")

    def read(batches):
        for batch in batches:
            found, of = terms(batch.column(1))
            order = np.argsort(of, kind="stable")
            bounds = np.searchsorted(of[order], np.arange(batch.num_rows + 1))
            sets = [distinct(found[order[a:b]]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), ragged(sets, pa.int64())], ["label", "terms"])

    table = rows.mapInArrow(read, "label int, terms array<long>").toArrow()
    labels = table.column("label").to_numpy()
    lists = table.column("terms").combine_chunks()
    flat, at = lists.flatten().to_numpy().view(np.uint64), lists.offsets.to_numpy()
    # A fixed order of rows, however they arrive.
    rows = [(int(y), flat[a:b]) for y, a, b in zip(labels, at[:-1], at[1:], strict=True)]
    return sorted(rows, key=lambda r: (r[0], len(r[1]), r[1][:8].tolist(), int(r[1].sum(dtype=np.uint64)) if len(r[1]) else 0))


def sparse(rows: list[np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the terms that are among the ascending keys."""
    flat = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    if not len(keys):
        return of[:0], of[:0]
    at = np.minimum(np.searchsorted(keys, flat), len(keys) - 1)
    hit = keys[at] == flat
    return of[hit], at[hit]


class Lookup:
    """Finds which terms of a batch a model knows."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.sieve = np.zeros(1 << 22, bool)
        self.sieve[(keys >> np.uint64(42)).astype(np.int64)] = True

    def __call__(self, found: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and column of each known term, once a row."""
        likely = self.sieve[(found >> np.uint64(42)).astype(np.int64)]
        found, rows = found[likely], rows[likely]
        if not len(found) or not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
        hit = self.keys[at] == found
        both = np.unique(rows[hit].astype(np.int64) * len(self.keys) + at[hit])
        return np.divmod(both, len(self.keys))


def score_rows(
    documents: DataFrame, doc_id: str, text: str, terms: Terms, keys: np.ndarray, score: Callable
) -> DataFrame:
    """(doc_id, score) of every row; `score(rows, columns, n)` gives the scores of n rows."""
    small_batches(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(keys)
    kind = documents.schema[doc_id].dataType.simpleString()

    def rate(batches):
        lookup = Lookup(sent.value)
        for batch in batches:
            rows, columns = lookup(*terms(batch.column(1)))
            found = score(rows, columns, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    return documents.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(rate, f"doc_id {kind}, score double")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
