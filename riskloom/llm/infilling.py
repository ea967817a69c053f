"""Fill-in-middle: texts cut at code points, reordered around sentinels, and put together again.

Cuts are code points, slices are bytes. The sparse index of a batch holds nothing but its characters of
more than one byte: where each stands and how many bytes more than one it takes. Between two of them
code points and bytes run in step, so a cut is one binary search and one addition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.frames import bounded_batches, stored
from riskloom.llm.text import text_bytes

# The sentinels, and the shares of texts left plain and of the rest put suffix first.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM = 90
SUFFIX_FIRST_BELOW = 20
SEED = 1
DRAW_DIGITS = 8


class Exceptions:
    """The sparse index of texts laid end to end: only characters of more than one byte have an entry.

    `byte` and `point` say where such a character begins, in bytes and in code points of all texts;
    `excess[i]` is the number of bytes beyond one each that the first i of them take.
    """

    def __init__(self, data: np.ndarray) -> None:
        self.byte = np.flatnonzero(data >= 0xC0)
        lead = data[self.byte]
        extra = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate([np.zeros(1, np.int64), np.cumsum(extra)])
        self.point = self.byte - self.excess[:-1]

    def to_bytes(self, points: np.ndarray) -> np.ndarray:
        """Byte at which each code point begins."""
        return points + self.excess[np.searchsorted(self.point, points, "left")]

    def to_points(self, at: np.ndarray) -> np.ndarray:
        """Code points before each byte; the byte must begin a character or end the texts."""
        return at - self.excess[np.searchsorted(self.byte, at, "left")]


def draws(doc_id: Column | str, seed: int = SEED) -> Column:
    """Four unsigned numbers from the digest of the seed and the id; a null id counts as no digits."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(column.cast("string"), F.lit(""))), 256)
    groups = [F.conv(F.substring(digest, 1 + DRAW_DIGITS * i, DRAW_DIGITS), 16, 10).cast("long") for i in range(4)]
    return F.array(*groups)


def _rearranged(texts: pa.Array, draw: np.ndarray) -> Iterator[tuple[int, str, int, int, bytes]]:
    """(code points, form, prefix, middle, output) of each text; the two lengths are -1 where it stays plain."""
    data, at = text_bytes(texts)
    index = Exceptions(data)
    starts = index.to_points(at)
    size = np.diff(starts)
    cuts = np.sort(draw[:, :2] % (size[:, None] + 1), axis=1)
    first, second = (index.to_bytes(starts[:-1] + cuts[:, i]) for i in (0, 1))
    whole = data.tobytes()
    plain = (size == 0) | (draw[:, 2] % 100 >= PLAIN_FROM)
    suffix_first = draw[:, 3] % 100 < SUFFIX_FIRST_BELOW
    for i, n in enumerate(size.tolist()):
        begin, end = int(at[i]), int(at[i + 1])
        if plain[i] or any(whole.find(mark, begin, end) >= 0 for mark in (PREFIX, SUFFIX, MIDDLE)):
            yield n, "plain", -1, -1, whole[begin:end]
            continue
        low, high = int(first[i]), int(second[i])
        prefix, middle, suffix = whole[begin:low], whole[low:high], whole[high:end]
        if suffix_first[i]:
            output = b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
        else:
            output = b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
        yield n, "spm" if suffix_first[i] else "psm", int(cuts[i, 0]), int(cuts[i, 1] - cuts[i, 0]), output


def _restored(outputs: pa.Array, forms: list[str | None]) -> Iterator[tuple[bytes | None, int, int]]:
    """(text, code points of prefix and of middle) of each output, found by its sentinels."""
    data, at = text_bytes(outputs)
    index = Exceptions(data)
    whole = data.tobytes()
    for i, form in enumerate(forms):
        begin, end = int(at[i]), int(at[i + 1])
        if form == "plain":
            yield whole[begin:end], -1, -1
            continue
        head, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
        turn = whole.find(second, begin + len(head), end)
        last = whole.find(MIDDLE, turn + len(second), end) if turn >= 0 else -1
        if form not in ("psm", "spm") or not whole.startswith(head, begin, end) or last < 0:
            yield None, -1, -1
            continue
        one, two, middle = (begin + len(head), turn), (turn + len(second), last), (last + len(MIDDLE), end)
        prefix, suffix = (one, two) if form == "psm" else (two, one)
        points = index.to_points(np.array([*prefix, *middle]))
        text = whole[slice(*prefix)] + whole[slice(*middle)] + whole[slice(*suffix)]
        yield text, int(points[1] - points[0]), int(points[3] - points[2])


def _lengths(values: list[int]) -> pa.Array:
    return pa.array([None if v < 0 else v for v in values], pa.int64())


def _texts(values: list[bytes | None]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def fill_in_middle(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """All rows and columns plus `n`, `form`, `prefix_chars`, `middle_chars` and `output`.

    `n` is the text's number of code points. Two draws of the digest of seed and id, modulo n + 1, cut
    it into prefix, middle and suffix. `output` is the text itself (form plain: empty texts, texts that
    hold a sentinel, and a tenth of the ids), or prefix, suffix and middle (psm), or suffix, prefix and
    middle (spm), each behind its sentinel; the lengths are null for plain ones.

    A null text is an empty one; a null id draws as an empty id; rows of one id and text come out
    alike. An empty table gives an empty one. The added columns replace columns of those names.
    Nothing is shuffled: a task holds a batch of bounded bytes, or one text if that is longer.
    """
    schema = "n long, form string, prefix_chars long, middle_chars long, output string"

    @F.arrow_udf(schema)
    def cut(texts: pa.Array, numbers: pa.Array) -> pa.Array:
        draw = numbers.flatten().to_numpy(zero_copy_only=False).reshape(-1, 4).astype(np.int64)
        found = list(_rearranged(texts, draw))
        n, form, prefix, middle, output = zip(*found, strict=True) if found else ([],) * 5
        arrays = [pa.array(n, pa.int64()), pa.array(form, pa.string()), _lengths(prefix), _lengths(middle), _texts(output)]
        return pa.StructArray.from_arrays(arrays, ["n", "form", "prefix_chars", "middle_chars", "output"])

    added = ("n", "form", "prefix_chars", "middle_chars", "output")
    kept = [F.col(f"`{c}`") for c in documents.columns if c.lower() not in added]
    made = documents.select(*kept, cut(F.col(f"`{text}`").cast("string"), draws(F.col(f"`{doc_id}`"), seed)).alias("output"))
    return made.select(*kept, *(F.col("output")[c].alias(c) for c in added))


def restore_texts(outputs: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """All rows and columns plus `restored`, `restored_prefix` and `restored_middle`, from output and form alone.

    The lengths are code points, null for plain outputs. An output that does not carry its form's
    sentinels, or an unknown or null form, gives nulls; a null output counts as an empty one. The added
    columns replace columns of those names.
    """
    schema = "restored string, restored_prefix long, restored_middle long"

    @F.arrow_udf(schema)
    def join(made: pa.Array, forms: pa.Array) -> pa.Array:
        found = list(_restored(made, forms.to_pylist()))
        text, prefix, middle = zip(*found, strict=True) if found else ([],) * 3
        return pa.StructArray.from_arrays(
            [_texts(text), _lengths(prefix), _lengths(middle)], ["restored", "restored_prefix", "restored_middle"]
        )

    added = ("restored", "restored_prefix", "restored_middle")
    kept = [F.col(f"`{c}`") for c in outputs.columns if c.lower() not in added]
    made = outputs.select(*kept, join(F.col(f"`{output}`").cast("string"), F.col(f"`{form}`")).alias("restored"))
    return made.select(*kept, *(F.col("restored")[c].alias(c) for c in added))


def transform_digests(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """What was cut, and the digests of each output and of the text restored from it; computed once."""
    with bounded_batches(documents.sparkSession):
        made = fill_in_middle(documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "doc_id", "text")
        made = restore_texts(made.drop("text"))
        digests = made.select(
            "doc_id",
            "n",
            "form",
            "prefix_chars",
            "middle_chars",
            F.sha2("output", 256).alias("output_sha256"),
            F.sha2("restored", 256).alias("restored_sha256"),
        )
        return stored(digests, "infilling")
