"""Code length of texts by prediction by partial matching, and a unigram base to hold it against."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.frames import crc_of_id, small_batches, stored
from riskloom.llm.text import blank_free, lowered, ragged, span_hashes, text_bytes, word_spans

# Bytes of context of the longest predictions; a gram is a context and the byte after it.
ORDER = 5
END = 0xFF
FOLDS, HELD_OUT = 5, 1
# Entries of a lookup that travels with the tasks: 16 bytes each in a table of two to four times as many slots, a power
# of two. The driver makes it and holds it up to three times while it is sent; rarer grams and words meet in joins.
LOOKUP_GRAMS = 2_000_000
LOOKUP_WORDS = 500_000
# Steps of counts by which the commonest are told, for each doubling; and parts that a step is taken in.
STEPS, SHARES = 16, 1 << 20
# Keys that a counting task holds before it sends sums on.
HELD_KEYS = 3_000_000
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def symbols(column: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts as symbols, and their words.

    Each text is its words, A-Z lowered, with single spaces between, then END, which UTF-8 never uses;
    END also fills the context before its first byte. Returns the gram (`order` + 1 bytes as a number)
    of each symbol, where each text's grams begin, and hashes and ranges of its words.
    """
    data, at = text_bytes(column)
    begins, ends, first = word_spans(data, at)
    low, inside = lowered(data), blank_free(data)
    words, size = np.diff(first), ends - begins
    # Where each text's words end: all of them and single spaces between, then its ENDs.
    letters = np.concatenate([[0], np.cumsum(size)])[first]
    length = np.diff(letters) + np.maximum(words, 1)
    start = order + np.concatenate([[0], np.cumsum(length + order - 1)])
    close = start[:-1] + length - 1
    total = int(start[-1])
    out = np.full(max(total, order) + 8, END, np.uint8)
    solid = np.ones(len(out), bool)
    solid[:order] = solid[total:] = False
    wanted = solid.copy()
    for k in range(order):
        solid[close + k] = False
        if k:
            wanted[close + k] = False
    inner = np.ones(len(begins), bool)
    inner[first[1:][words > 0] - 1] = False
    nth = np.arange(len(begins)) - np.repeat(first[:-1], words)
    gap = np.repeat(start[:-1], words) + np.cumsum(size) - np.repeat(letters[:-1], words) + nth
    gap = gap[inner]
    out[gap], solid[gap] = 32, False
    out[solid] = low[inside]
    # The bytes up to each symbol, as one number.
    window = np.ndarray(len(out) - 8, ">u8", out, strides=(1,))
    grams = np.empty(total, np.uint64)
    grams[order:] = window[: total - order] >> np.uint64(8 * (7 - order))
    bounds = np.concatenate([[0], np.cumsum(length)])
    return grams[wanted[:total]], bounds, span_hashes(low, begins, ends), first, words


class Tally:
    """Sums of two counts by key; holds a bounded number of keys."""

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: np.ndarray, train: bool) -> None:
        """Counts each key once, and once more as training if so."""
        keys = np.sort(keys)
        at = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
        n = np.diff(np.append(at, len(keys))).astype(np.uint64)
        self.parts.append(np.stack([keys[at], n, n * np.uint64(train)]))
        self.size += len(at)
        if self.size > 2 * HELD_KEYS:
            self.merge()

    def merge(self) -> None:
        if len(self.parts) < 2:
            return
        every = np.concatenate(self.parts, 1)
        every = every[:, np.argsort(every[0], kind="stable")]
        at = np.flatnonzero(np.concatenate([[True], every[0, 1:] != every[0, :-1]]))
        self.parts = [np.stack([every[0, at], np.add.reduceat(every[1], at), np.add.reduceat(every[2], at)])]
        self.size = len(at)

    def flush(self) -> np.ndarray:
        self.merge()
        out = self.parts[0] if self.parts else np.zeros((3, 0), np.uint64)
        self.parts, self.size = [], 0
        return out


def _counts(documents: DataFrame, order: int) -> DataFrame:
    """(kind, key, n, train): grams (0) and words (1) of all rows, and counts in training rows."""

    def count(batches):
        tallies = Tally(), Tally()

        def rows():
            for kind, tally in enumerate(tallies):
                every = tally.flush()
                for at in range(0, every.shape[1], 1 << 16):
                    part = every[:, at : at + (1 << 16)].view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(part.shape[1], kind, np.int8)), *(pa.array(p) for p in part)], ["kind", "key", "n", "train"]
                    )

        for batch in batches:
            for train in (True, False):
                own = batch.filter(pc.equal(batch.column(0), not train))
                grams, _, words, _, _ = symbols(own.column(1), order)
                tallies[0].add(grams, train)
                tallies[1].add(words, train)
            if max(t.size for t in tallies) > HELD_KEYS:
                for t in tallies:
                    t.merge()
                if max(t.size for t in tallies) > HELD_KEYS:
                    yield from rows()
        yield from rows()

    rows = documents.select("held_out", "text").mapInArrow(count, "kind tinyint, key long, n long, train long")
    return rows.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("train").alias("train"))


def _suffix(gram: Column, size: int) -> Column:
    """The last `size` bytes of a gram."""
    return gram if size >= 8 else gram.bitwiseAND(F.lit((1 << (8 * size)) - 1))


def gram_costs(grams: DataFrame, order: int) -> DataFrame:
    """(key, cost): log10 probability of each gram's last byte after its first ones.

    `grams` holds key, and train, its count in training texts. A context of `order` bytes predicts by
    counts, with escape (distinct bytes seen) / (occurrences + distinct bytes seen). On escape the
    context loses its first byte, and bytes that the longer one has seen are excluded from its counts;
    below the empty context all bytes not seen yet are equally likely. A context never seen costs nothing.
    """
    seen = {order: grams.filter("train > 0").select(F.col("key").alias("gram"), F.col("train").alias("n"))}
    for k in range(order - 1, -1, -1):
        seen[k] = stored(seen[k + 1].groupBy(_suffix(F.col("gram"), k + 1).alias("gram")).agg(F.sum("n").alias("n")), f"order-{k}")
    context = F.shiftrightunsigned("gram", 8)
    tables = {
        k: t.groupBy(context.alias("context")).agg(F.sum("n").alias("total"), F.count("*").alias("kinds")) for k, t in seen.items()
    }
    costs = seen[order].withColumn("context", context).join(tables[order], "context")
    known = costs.select(F.col("gram").alias("key"), F.log10(F.col("n") / (F.col("total") + F.col("kinds"))).alias("cost"))

    left = grams.filter("train = 0").select("key", F.lit(0.0).alias("cost"), F.lit(False).alias("done"))
    for k in range(order, -1, -1):
        whole = tables[k].select("context", F.col("total").alias("all_total"), F.col("kinds").alias("all_kinds"))
        here = seen[k].select("gram", "n")
        left = left.withColumn("gram", _suffix(F.col("key"), k + 1)).withColumn("context", context)
        left = left.join(here, "gram", "left").join(whole, "context", "left")
        total, kinds = F.col("all_total"), F.col("all_kinds")
        if k < order:
            # What the context one byte longer has seen, counted here.
            longer = seen[k + 1].select(context.alias("longer"), _suffix(F.col("gram"), k + 1).alias("short"))
            gone = longer.join(here.withColumnRenamed("gram", "short").withColumnRenamed("n", "gone"), "short")
            gone = gone.groupBy("longer").agg(F.sum("gone").alias("gone"), F.count("*").alias("gone_kinds"))
            left = left.withColumn("longer", F.shiftrightunsigned(_suffix(F.col("key"), k + 2), 8)).join(gone, "longer", "left")
            total, kinds = total - F.coalesce("gone", F.lit(0)), kinds - F.coalesce("gone_kinds", F.lit(0))
        both = total + kinds
        step = F.when(F.col("done") | total.isNull() | (both == 0), 0.0)
        step = step.when(F.col("n").isNotNull(), F.log10(F.col("n") / both)).otherwise(F.log10(kinds / both))
        left = left.select("key", (F.col("cost") + step).alias("cost"), (F.col("done") | F.col("n").isNotNull()).alias("done"))
    root = tables[0].agg(F.coalesce(F.sum("kinds"), F.lit(0)).alias("kinds"))
    left = left.crossJoin(F.broadcast(root)).select(
        "key", F.when(F.col("done"), F.col("cost")).otherwise(F.col("cost") - F.log10(256 - F.col("kinds"))).alias("cost")
    )
    return known.union(left)


class Table:
    """Numbers by 64-bit key, in open addressing; lookups of whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.full(1 << self.bits, np.nan)
        left, slot = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(left):
            free = np.isnan(self.values[slot])
            chosen, own = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[own]
            self.keys[chosen], self.values[chosen] = keys[left[won]], values[left[won]]
            rest = np.ones(len(left), bool)
            rest[won] = False
            left, slot = left[rest], (slot[rest] + 1) & (len(self.keys) - 1)

    @classmethod
    def of(cls, slots: tuple[int, np.ndarray, np.ndarray]) -> Table:
        """From the arrays of a table made before, as they travel."""
        table = cls.__new__(cls)
        table.bits, table.keys, table.values = slots
        return table

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, NaN where there is none."""
        slot = self._slot(keys)
        out = self.values[slot]
        wrong = np.flatnonzero((self.keys[slot] != keys) & ~np.isnan(out))
        at = slot[wrong]
        while len(wrong):
            at = (at + 1) & (len(self.keys) - 1)
            value = self.values[at]
            out[wrong] = value
            more = (self.keys[at] != keys[wrong]) & ~np.isnan(value)
            wrong, at = wrong[more], at[more]
        return out


def commonest(counts: DataFrame, limit: int) -> DataFrame:
    """About `limit` rows of those with the largest counts `n`, whole tables of no more rows.

    No rows are ordered, which a limit does in the driver: counts are told apart by their logarithm, and of the
    last step taken a share goes by a hash of the key.
    """
    step = F.floor(STEPS * F.log2("n"))
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).collect()
    left = limit
    for last, rows in sorted(((row.step, row.rows) for row in sizes), reverse=True):
        if rows > left:
            share = F.pmod(F.xxhash64("key"), F.lit(SHARES)) < left * SHARES // rows
            return counts.filter((step > last) | (step == last) & share)
        left -= rows
    return counts


def _slots(df: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """A table's arrays, from rows (key, value) that are bounded by their maker."""
    rows = df.toArrow()
    keys, values = rows.column(0).to_numpy().view(np.uint64), rows.column(1).to_numpy()
    # The driver's memory holds the rows once, beside the table.
    del rows
    table = Table(keys, values)
    return table.bits, table.keys, table.values


def score_texts(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    lookup_grams: int = LOOKUP_GRAMS,
    lookup_words: int = LOOKUP_WORDS,
) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes.

    Rows whose crc32(id as text) mod 5 is 1 are held out; the others train. `score` is the log10
    probability of the text's words, A-Z lowered, with single spaces between and an end, byte by byte;
    `n_bytes` counts its predictions. `base_score` sums log10((c + 0.5) / (N + 0.5 (V + 1))) over words
    and an end. Null and empty texts are the end alone. Repeated rows train and are scored each. An
    empty table gives an empty one. Without training rows all bytes are equally likely.

    Counts and costs are tables that Spark sums and joins. Scoring looks up the costs of the
    `lookup_grams` commonest grams and the counts of the `lookup_words` commonest words in each task;
    the rest, whatever its number, meets its costs in a shuffled join on rows (row, key, count).
    """
    spark = documents.sparkSession
    small_batches(spark)
    kind = documents.schema[doc_id].dataType.simpleString()
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("held_out", crc_of_id("doc_id") % FOLDS == HELD_OUT)
    counted = stored(_counts(rows, order), "counts")
    grams, words = counted.filter("kind = 0"), counted.filter("kind = 1")
    costs = stored(gram_costs(grams, order), "costs")
    ends = rows.agg(F.count_if(~F.col("held_out"))).first()[0]
    sums = words.agg(F.coalesce(F.sum("train"), F.lit(0)), F.count_if(F.col("train") > 0)).first()
    total, kinds = sums[0] + ends, sums[1] + (ends > 0)

    n_grams = costs.count()
    by_count = costs if n_grams <= lookup_grams else costs.join(commonest(grams.select("key", "n"), lookup_grams), "key")
    near = spark.sparkContext.broadcast(
        (_slots(by_count.select("key", "cost")), _slots(commonest(words.filter("n > 1"), lookup_words).select("key", "train")))
    )
    share = float(total) + 0.5 * (kinds + 1)
    out = (
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long, "
        "words array<long>, grams array<long>"
    )

    def score(batches):
        costs_of, count_of = (Table.of(slots) for slots in near.value)
        for batch in batches:
            keys, bounds, hashes, first, lengths = symbols(batch.column(2), order)
            cost, count = costs_of(keys), count_of(hashes)
            far_gram, far_word = np.isnan(cost), np.isnan(count)
            base = np.log10((np.where(far_word, 0, count) + 0.5) / share)
            texts = batch.num_rows
            of = np.repeat(np.arange(texts), lengths)
            own = np.bincount(of, np.where(far_word, 0, base), texts) + np.log10((ends + 0.5) / share)
            known = np.bincount(of, ~far_word & (count > 0), texts).astype(np.int64) + (ends > 0)
            ppm = np.add.reduceat(np.where(far_gram, 0, cost), bounds[:-1]) if texts else np.zeros(0)
            gram_of = np.repeat(np.arange(texts), np.diff(bounds))
            rest = []
            for far, values, owner in ((far_word, hashes, of), (far_gram, keys, gram_of)):
                values, cut = values[far], np.searchsorted(owner[far], np.arange(texts + 1))
                rest.append(ragged([values[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(lengths + 1), pa.array(known), pa.array(own), pa.array(ppm),
                    pa.array(np.diff(bounds)), *rest,
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "n_bytes", "words", "grams"],
            )

    scored = rows.select("doc_id", "held_out", "text").mapInArrow(score, out)
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    # Nothing reads the lookups again, which else stay in the driver's memory.
    near.destroy()
    rare = scored.select("row", F.explode("words").alias("key")).groupBy("row", "key").agg(F.count("*").alias("times"))
    rare = rare.join(words.select("key", "train"), "key")
    part = F.col("times") * F.log10((F.col("train") + 0.5) / F.lit(share))
    known = F.sum(F.when(F.col("train") > 0, F.col("times")).otherwise(0))
    rest = rare.groupBy("row").agg(F.sum(part).alias("more_base"), known.alias("more_known"))
    joined = scored.drop("words", "grams").join(rest, "row", "left")
    if n_grams > lookup_grams:
        far = scored.select("row", F.explode("grams").alias("key")).groupBy("row", "key").agg(F.count("*").alias("times"))
        far = far.join(costs, "key").groupBy("row").agg(F.sum(F.col("times") * F.col("cost")).alias("more_score"))
        joined = joined.join(far, "row", "left")
    else:
        joined = joined.withColumn("more_score", F.lit(0.0))
    plus = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a)
    return joined.select(
        "doc_id", "held_out", "n_tokens", plus("n_known", "more_known"), F.lit(total).cast("long").alias("train_tokens"),
        plus("base_score", "more_base"), plus("score", "more_score"), "n_bytes",
    )
