"""Best-fit packing of token sequences by exact complements of lengths."""

from __future__ import annotations

import os
import sys
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.frames import release_memory, small_batches, stored
from riskloom.llm.text import lowered, span_hashes, text_bytes, word_spans

TOKENIZER = "word_bpe_49k.json"
MAX_TOKENS = 4096
END_ID = 1
# Rows ranked together: rows of one length are split into so many groups at least, more if over this many rows each.
RANKED_GROUPS, RANKED_ROWS = 64, 100_000
# Words that a task keeps, and slots of the table that finds most of them at once.
KEPT_WORDS = 800_000
SLOTS = 1 << 20
# Words that stay between tasks.
WORDS_BETWEEN = 150_000
# Words of letters that are encoded together.
LOT = 1_000


class Lengths:
    """Counts of the pieces left by length, with indexes of the lengths and of the sums of two."""

    def __init__(self, counts: dict[int, int], most: int):
        self.left = Counter({k: v for k, v in counts.items() if v > 0})
        self.most = most
        self.single = np.zeros(most + 1, bool)
        self.single[list(self.left)] = True
        self._pairs: np.ndarray | None = None

    def take(self, pattern: list[int], copies: int) -> None:
        for length in pattern:
            self.left[length] -= copies
            if not self.left[length]:
                del self.left[length]
                self.single[length] = False
                self._pairs = None

    @property
    def pairs(self) -> np.ndarray:
        """Which sums two lengths reach, each length used once or twice."""
        if self._pairs is None:
            bits = sum(1 << k for k in self.left)
            sums = 0
            for k in self.left:
                sums |= bits << k
            raw = (sums & ((1 << (self.most + 1)) - 1)).to_bytes(self.most // 8 + 1, "little")
            self._pairs = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[: self.most + 1].astype(bool)
        return self._pairs

    def holds(self, used: list[int]) -> bool:
        return all(self.left[k] >= n for k, n in Counter(used).items())

    def complement(self, gap: int, used: list[int]) -> list[int] | None:
        """One, two or three lengths that fill the gap exactly beside those used, largest first."""
        if self.single[gap] and self.holds([*used, gap]):
            return [gap]
        found = self._two(gap, used)
        if found or gap < 3:
            return found
        first = np.arange(gap - 2, 0, -1)
        for a in first[self.single[first] & self.pairs[gap - first]]:
            if two := self._two(gap - int(a), [*used, int(a)]):
                return [int(a), *two]
        return None

    def _two(self, gap: int, used: list[int]) -> list[int] | None:
        if gap < 2 or not self.pairs[gap]:
            return None
        first = np.arange(gap - 1, (gap - 1) // 2, -1)
        for a in first[self.single[first] & self.single[gap - first]]:
            two = [int(a), gap - int(a)]
            if self.holds([*used, *two]):
                return two
        return None

    def best_fit(self, gap: int, used: list[int]) -> int | None:
        for k in np.flatnonzero(self.single[: gap + 1])[::-1]:
            if self.holds([*used, int(k)]):
                return int(k)
        return None


def plan_packing(counts: dict[int, int], most: int = MAX_TOKENS) -> list[tuple[list[int], int]]:
    """Patterns of lengths of at most `most` in all, and how often each is used; uses up all counts.

    The longest piece left opens a sequence. A gap is filled by one, two or three lengths that fit it
    exactly, else by the longest that fits, and so on. A pattern is used as often as counts allow, so
    each uses up a length: the plan is no longer than a few times the number of lengths.
    """
    lengths, plan = Lengths(counts, most), []
    for longest in sorted(lengths.left, reverse=True):
        while lengths.left[longest] > 0:
            pattern, gap = [longest], most - longest
            while gap:
                if rest := lengths.complement(gap, pattern):
                    pattern += rest
                    break
                fit = lengths.best_fit(gap, pattern)
                if fit is None:
                    break
                pattern.append(fit)
                gap -= fit
            copies = min(lengths.left[k] // n for k, n in Counter(pattern).items())
            lengths.take(pattern, copies)
            plan.append((pattern, copies))
    return plan


def places(plan: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): pieces of those ranks go to sequences in turn."""
    used, sequence, rows = Counter(), 0, []
    for pattern, copies in plan:
        offset = 0
        for length in pattern:
            rows.append((length, used[length], used[length] + copies, sequence, offset))
            used[length] += copies
            offset += length
        sequence += copies
    return rows


class WordTokens:
    """Ids of whole texts, each distinct word tokenized once and found again by its 64-bit fingerprint.

    Words end at ASCII white space, which the tokenizer drops. It also parts letters, single digits and
    marks, so an ASCII word is looked up by these, lowered; one with an apostrophe or other characters
    is looked up as it is. A text with the tokenizer's own markers is tokenized whole. The words known
    are a few flat arrays; past KEPT_WORDS only those of the current batch stay.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Known words in order of fingerprint: where the ids of each begin in `flat`, and how many they are.
        self.keys, self.starts, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self._place()

    def shrink(self, most: int) -> None:
        """Keeps the words learned first, which are the commonest, between tasks."""
        if len(self.keys) > most:
            self._keep(np.sort(np.argpartition(self.starts, most)[:most]))
            self._place()

    def _keep(self, stay: np.ndarray) -> None:
        """Forgets all words but those at these places."""
        take = _runs(self.starts[stay], self.sizes[stay])
        self.flat, self.sizes, self.keys = self.flat[take], self.sizes[stay], self.keys[stay]
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _place(self) -> None:
        """A word of each slot, so that most are found without a search."""
        self.slot = np.zeros(SLOTS, np.int32)
        self.slot[(self.keys & np.uint64(SLOTS - 1)).astype(np.int64)] = np.arange(len(self.keys), dtype=np.int32)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key among the known ones, -1 where it is none."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = self.slot[(keys & np.uint64(SLOTS - 1)).astype(np.int64)].astype(np.int64)
        other = np.flatnonzero(self.keys[at] != keys)
        found = np.minimum(np.searchsorted(self.keys, keys[other]), len(self.keys) - 1)
        at[other] = np.where(self.keys[found] == keys[other], found, -1)
        return at

    def _learn(self, keys: np.ndarray, words: list[str], used: np.ndarray) -> None:
        """Takes new words in; `used` are the places of the known ones that must stay."""
        if len(self.keys) + len(keys) > KEPT_WORDS:
            self._keep(np.unique(used))
        new, starts, sizes = self._encoded(words)
        starts += len(self.flat)
        self.flat = np.concatenate([self.flat, new])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.starts, self.sizes = (np.insert(a, at, b) for a, b in ((self.keys, keys), (self.starts, starts), (self.sizes, sizes)))
        self._place()

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words in some order, and where those of each word begin and how many they are."""
        letters = [i for i, w in enumerate(words) if w.isascii() and w.isalpha() or self._letters(w)]
        lots = [letters[i : i + LOT] for i in range(0, len(letters), LOT)]
        order, ids, sizes = [], [], []
        alone = set(range(len(words))).difference(letters)
        # Words of letters alone are encoded many at a time: each is one word of the tokenizer.
        for lot, found in zip(lots, self.tokenizer.encode_batch([" ".join([words[i] for i in lot]) for lot in lots], add_special_tokens=False), strict=True):
            owner = np.array(found.word_ids)
            ends = np.append(np.flatnonzero(np.diff(owner)) + 1, len(owner))
            if len(ends) != len(lot):  # it sees other letters than Python does
                alone.update(lot)
                continue
            order += lot
            ids.append(np.array(found.ids, np.uint32))
            sizes.append(np.diff(ends, prepend=0))
        rest = sorted(alone)
        coded = [c.ids for c in self.tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)]
        ids.append(np.fromiter(chain.from_iterable(coded), np.uint32))
        sizes.append(np.fromiter(map(len, coded), np.int64, len(coded)))
        size, place = np.concatenate(sizes), np.array([*order, *rest], np.int64)
        starts, counts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        starts[place], counts[place] = np.cumsum(size) - size, size
        return np.concatenate(ids), starts, counts

    @staticmethod
    def _letters(word: str) -> bool:
        """Whether a word stays one run of letters when it is composed and lowered."""
        return unicodedata.is_normalized("NFC", word) and (low := word.lower()).isalpha() and unicodedata.is_normalized("NFC", low)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and where each text's begin."""
        data, at = text_bytes(texts)
        begins, ends, parted = _parts(data, *word_spans(data, at)[:2])
        first = np.searchsorted(begins, at)
        keys = span_hashes(parted, begins, ends)
        place = self._find(keys)
        if (missing := np.flatnonzero(place < 0)).size:
            new, where = np.unique(keys[missing], return_index=True)
            spans = [(int(begins[i]), int(ends[i])) for i in missing[where]]
            self._learn(new, [parted[b:e].tobytes().decode() for b, e in spans], place[place >= 0])
            place = self._find(keys)
        sizes = self.sizes[place] if len(place) else np.zeros(0, np.int64)
        bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])[first]
        flat = self.flat[_runs(self.starts[place], sizes)] if len(place) else np.zeros(0, np.uint32)

        mark = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
        whole = {int(i) for i in np.searchsorted(at, mark, "right") - 1 if np.any((mark >= at[i]) & (mark + 1 < at[i + 1]))}
        if whole:
            parts = [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            for i in whole:
                parts[i] = np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32)
            flat, bounds = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return flat, bounds

    def batch(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        flat, bounds = self.ids(pa.array(texts, pa.string()))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield flat[a:b].astype("<u4").tobytes()


def _parts(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of what is looked up, and the bytes with ASCII words lowered."""
    kind = np.full(128, 3, np.uint8)
    kind[48:58] = 2
    kind[65:91] = kind[97:123] = 1
    ascii_only = data < 128
    of = kind[np.where(ascii_only, data, 0)]
    odd = np.concatenate([np.zeros(1, np.int64), np.cumsum(~ascii_only | (data == ord("'")))])
    plain = odd[ends] == odd[begins]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[begins[plain]] += 1
    inside[ends[plain]] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    start = np.zeros(len(data) + 1, bool)
    start[1:-1] = inside[1:] & ((of[1:] != of[:-1]) | (of[1:] == 2))
    start[begins] = True
    stop = start.copy()
    stop[ends] = True
    low = np.flatnonzero(start)
    bounds = np.flatnonzero(stop)
    return low, bounds[np.searchsorted(bounds, low, "right")], np.where(inside, lowered(data), data)


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all runs, one run after another."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_pieces(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    most: int = MAX_TOKENS,
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32[, ids]) of each row's ids and the end id.

    Only rows longer than `most` are cut, every `most` ids. Null and empty texts are the end id alone.
    `ids` are little-endian unsigned 32-bit numbers.
    """
    path = tokenizer or tokenizer_path()
    kind = documents.schema[doc_id].dataType.simpleString()
    small_batches(documents.sparkSession)

    def cut(batches):
        # One thread a task: each thread of the tokenizer would keep memory of its own in every worker.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        # A worker process keeps common words from task to task, and no more, as other stages need its memory.
        coder = vars(sys).setdefault("_word_tokens", {}).get(path) or WordTokens(path)
        vars(sys)["_word_tokens"][path] = coder
        for batch in batches:
            flat, bounds = coder.ids(batch.column(1))
            flat = np.insert(flat, bounds[1:], END_ID).astype("<u4")
            sizes = np.diff(bounds) + 1
            bounds = bounds + np.arange(len(bounds))
            count = -(-sizes // most)
            row = np.repeat(np.arange(len(sizes)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * most
            length = np.minimum(most, sizes[row] - start)
            view = memoryview(flat).cast("B")
            low = 4 * (bounds[row] + start)
            parts = [view[a : a + n] for a, n in zip(low.tolist(), (4 * length).tolist(), strict=True)]
            arrays = [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length)]
            arrays.append(pa.array([zlib.crc32(p) for p in parts], pa.int64()))
            if keep_ids:
                arrays.append(pa.array([bytes(p) for p in parts], pa.binary()))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names[: len(arrays)])
        coder.shrink(WORDS_BETWEEN)
        release_memory()

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return documents.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(cut, schema)


def pack_pieces(pieces: DataFrame, most: int = MAX_TOKENS) -> DataFrame:
    """The pieces plus `sequence_id` and `offset`; sequences hold at most `most` tokens, gapless from 0.

    `pieces` is read three times: pass a stored table. Only the counts of the at most `most` lengths
    reach the driver. Pieces of one length are interchangeable: they are ranked in groups of about
    RANKED_ROWS, and the rank tells the place. Equal rows get places of their own.
    """
    spark: SparkSession = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    table = spark.createDataFrame(
        places(plan_packing(counts, most)), "length long, low long, high long, sequence long, at long"
    )
    table = table.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("low", "high", "sequence", "at"))).alias("spans"))

    groups = max(RANKED_GROUPS, sum(counts.values()) // RANKED_ROWS)
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)).cast("int")
    salted = pieces.withColumn("salt", salt)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    starts = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).select("length", "salt", F.coalesce(before, F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(order) - 1).join(starts, ["length", "salt"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before")).join(F.broadcast(table), "length")
    span = F.filter("spans", lambda s: (s["low"] <= F.col("rank")) & (F.col("rank") < s["high"]))[0]
    ranked = ranked.withColumn("span", span)
    return ranked.select(
        *pieces.columns,
        (F.col("span.sequence") + F.col("rank") - F.col("span.low")).alias("sequence_id"),
        F.col("span.at").alias("offset"),
    )


def pack_documents(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    most: int = MAX_TOKENS,
    keep_ids: bool = False,
) -> DataFrame:
    """Tokenizes all rows and packs them into as few sequences of `most` tokens as it can.

    One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids). Null and
    empty texts give one piece of the end id; repeated rows are packed each; an empty table gives an
    empty one; other columns are left out.
    """
    return pack_pieces(stored(token_pieces(documents, doc_id, text, tokenizer, most, keep_ids), "pieces"), most)
