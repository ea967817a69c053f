"""Words and shingles of whole batches of texts as 64-bit fingerprints, by numpy over Arrow's buffers.

Words are runs of bytes other than ASCII white space, with A-Z lowered. Equal words have equal
fingerprints; different ones collide with odds of about 2**-64 a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 19
# Odd multipliers of the fingerprints; any would do.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the whole word, one to one."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in one array, and where each text begins and the last ends. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def lowered(data: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def blank_free(data: np.ndarray) -> np.ndarray:
    """Which bytes are part of a word."""
    table = np.ones(256, bool)
    table[[32, 9, 10, 11, 12, 13]] = False
    return table[data]


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word, and for each text the number of words before it."""
    word = np.zeros(len(data) + 1, bool)
    word[:-1] = blank_free(data)
    edge = at[1:-1][at[1:-1] < len(data)]
    begin = word[:-1].copy()
    begin[1:] &= ~word[:-2]
    begin[edge] = word[edge]
    end = word[:-1] & ~word[1:]
    inner = edge[edge > 0] - 1
    end[inner] = word[inner]
    begins, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return begins, ends, np.searchsorted(begins, at)


class Powers:
    """Powers of BASE and of its inverse, made once a task; they don't travel with it."""

    def __init__(self) -> None:
        self.made: tuple[np.ndarray, np.ndarray] | None = None

    def __reduce__(self):
        return Powers, ()

    def up_to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if self.made is None or len(self.made[0]) <= n:
            bases = BASE, np.uint64(pow(int(BASE), -1, 1 << 64))
            self.made = tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, b, np.uint64))]) for b in bases)
        return self.made


POWERS = Powers()


def span_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprint of each span; spans ascend and don't overlap. Works in blocks that fit the cache."""
    out = np.empty(len(begins), np.uint64)
    i = 0
    while i < len(begins):
        j = max(i + 1, int(np.searchsorted(ends, begins[i] + BLOCK, "right")))
        low, high = begins[i], ends[j - 1]
        up, down = POWERS.up_to(max(BLOCK, 1 << int(high - low).bit_length()))
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=total[1:])
        b, e = begins[i:j] - low, ends[i:j] - low
        out[i:j] = mix((total[e] - total[b]) * down[b] + (e - b).astype(np.uint64))
        i = j
    return out


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all words of all texts in order, and where each text's words begin."""
    data, at = text_bytes(column)
    begins, ends, first = word_spans(data, at)
    return span_hashes(lowered(data), begins, ends), first


def sequence_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Fingerprint of the words i to i + width - 1, for each i with so many words after it."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total = mix(total * BASE + words[k : k + n])
    return total


def distinct(values: np.ndarray) -> np.ndarray:
    """Ascending, each once."""
    values = np.sort(values)
    return values[np.concatenate([np.ones(min(1, len(values)), bool), values[1:] != values[:-1]])]


def shingle_sets(column: pa.Array, width: int = 5) -> list[np.ndarray]:
    """Distinct shingles of each text, ascending; a text of fewer words is one shingle, one without words none."""
    words, first = word_hashes(column)
    every = sequence_hashes(words, width)
    sets = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            sets.append(distinct(every[a : b - width + 1]))
        else:
            sets.append(sequence_hashes(words[a:b], int(b - a)) if b > a else np.zeros(0, np.uint64))
    return sets


def ragged(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column of one array a row."""
    at = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat.view(np.int64) if flat.dtype == np.uint64 else flat).cast(kind))


def run_hashes(column: pa.Array, lower: bool, marks: bool) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of runs of letters and digits (all non-ASCII bytes are letters) and, if `marks`, of marks."""
    data, at = text_bytes(column)
    kind = np.full(256, 2, np.uint8)
    kind[[32, 9, 10, 11, 12, 13]] = 0
    kind[48:58] = kind[65:91] = kind[97:123] = kind[128:] = 1
    if not marks:
        kind[kind == 2] = 0
    if lower:
        data = lowered(data)
    of = kind[data]
    turn = np.ones(len(data) + 1, bool)
    turn[1:-1] = of[1:] != of[:-1]
    turn[at[at < len(data)]] = True
    bounds = np.flatnonzero(turn)
    begins, ends = bounds[:-1], bounds[1:]
    solid = of[begins] > 0 if len(begins) else np.zeros(0, bool)
    begins, ends = begins[solid], ends[solid]
    return span_hashes(data, begins, ends), np.searchsorted(begins, at)
