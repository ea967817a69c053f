"""N-gram Jaccard join by signature trees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm import frames
from riskloom.llm.components import components
from riskloom.llm.frames import maybe_broadcast, small_batches
from riskloom.llm.text import BASE, distinct, mix, ragged, shingle_sets

# Similarity as a share of whole numbers, so that no rounding decides.
PART, WHOLE = 75, 100
# Shingles that stand last in the order; the list only moves work, never a result.
COMMON_SHINGLES = 500_000
COMMON_SHARE, COMMON_LEAST = 0.01, 8
# Members of a bucket that one tree holds; larger buckets are cut by size into such chunks.
TREE_ROWS = 1_024
LEAF, FAN = 8, 8
# Partners of other groups that a row proposes in the first round of trees; each round takes MORE_PARTNERS times as many.
FIRST_PARTNERS, MORE_PARTNERS = 8, 32
# Least-named sets of its buckets that a row is compared with before any tree is built.
REPRESENTATIVES = 4
# So many first buckets of a row travel with it, to tell whether a pair has met in an earlier one.
OWN_MOST = 16
BITS_MOST = 1 << 15
# A token's place in its row is kept in parts of so many to the row; places of a prefix are in the first third.
PLACES = 256
# Rounds of trees leave many tables behind.
stored = partial(frames.stored, compression="zstd")


def prefix_length(n: int) -> int:
    """Two sets that are similar enough share one of their first so many shingles in any common order."""
    return n - -(-PART * n // WHOLE) + 1 if n else 0


def bitmap_width(n: int) -> int:
    return min(BITS_MOST, max(256, 1 << (2 * n - 1).bit_length()))


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """Token bitmap, eight bits a byte, of two to four bits a shingle up to a limit."""
    bits = np.zeros(bitmap_width(len(shingles)), bool)
    bits[(shingles & np.uint64(len(bits) - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


def fold(bits: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps (rows) at a smaller power-of-two width in bytes: positions wrap around."""
    return np.bitwise_or.reduce(bits.reshape(*bits.shape[:-1], -1, width), axis=-2)


class Node:
    """A subtree over rows low to high - 1: OR of their bitmaps, range of sizes, and what bounds an overlap."""

    def __init__(self, low: int, high: int, children: list[Node], sizes: np.ndarray, groups: np.ndarray, bits: list[np.ndarray]):
        self.low, self.high, self.children = low, high, children
        self.least, self.most = int(sizes[low:high].min()), int(sizes[low:high].max())
        self.group = int(groups[low]) if (groups[low:high] == groups[low]).all() else None
        parts = [c.bits for c in children] or bits[low:high]
        width = min(len(p) for p in parts)
        self.bits = np.bitwise_or.reduce([fold(p, width) for p in parts], axis=0)

    def linked_to(self, other: Node) -> bool:
        return self.group is not None and self.group == other.group

    def may_link(self, other: Node) -> bool:
        """By sizes, and by the largest overlap that the bitmaps leave possible."""
        if PART * max(self.least, other.least) > WHOLE * min(self.most, other.most):
            return False
        width = min(len(self.bits), len(other.bits))
        common = int(np.bitwise_count(fold(self.bits, width) & fold(other.bits, width)).sum())
        # Shingles that share a bit with another of their set are at most those beyond its bits.
        spare = min(self.spares[width], other.spares[width])
        return (PART + WHOLE) * (common + spare) >= PART * (self.least + other.least)


def build(sizes: np.ndarray, groups: np.ndarray, bits: list[np.ndarray]) -> Node:
    """Tree over rows in the order given; bottom nodes hold LEAF rows, others FAN nodes."""
    beyond: dict[int, np.ndarray] = {}  # by bitmap width, each row's shingles beyond the bits they set
    for width in {len(b) for b in bits}:
        beyond[width] = sizes - np.array([int(np.bitwise_count(fold(b, min(width, len(b)))).sum()) for b in bits])
    level = [Node(i, min(i + LEAF, len(sizes)), [], sizes, groups, bits) for i in range(0, len(sizes), LEAF)]
    done = list(level)
    while len(level) > 1:
        level = [Node(c[0].low, c[-1].high, c, sizes, groups, bits) for c in (level[i : i + FAN] for i in range(0, len(level), FAN))]
        done += level
    for node in done:
        node.spares = {w: int(c[node.low : node.high].max()) for w, c in beyond.items()}
    return level[0]


def tree_join(
    sizes: np.ndarray, groups: np.ndarray, bits: list[np.ndarray], side: np.ndarray | None = None
) -> Iterator[tuple[int, int, float]]:
    """Pairs (i < j) of different groups that may be similar enough, with the bound of their similarity.

    With `side`, only pairs between both sides. Two subtrees meet unless both are wholly of one group
    or no pair of theirs can overlap enough.
    """
    if len(sizes) <= LEAF:
        yield from _leaf_join((0, len(sizes)), (0, len(sizes)), sizes, groups, bits, side)
        return
    root = build(sizes, groups, bits)
    todo = [(root, root)]
    while todo:
        a, b = todo.pop()
        if a.linked_to(b) or not a.may_link(b):
            continue
        if a.children or b.children:
            left, right = a.children or [a], b.children or [b]
            todo += [(x, y) for i, x in enumerate(left) for j, y in enumerate(right) if a is not b or i <= j]
        else:
            yield from _leaf_join((a.low, a.high), (b.low, b.high), sizes, groups, bits, side)


def _leaf_join(a, b, sizes, groups, bits, side) -> Iterator[tuple[int, int, float]]:
    """The pairs of two row ranges, or of one with itself, that their sizes and bitmaps leave possible."""
    i, j = np.arange(*a)[:, None], np.arange(*b)[None]
    small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
    left = (i < j) & (groups[i] != groups[j]) & (WHOLE * small >= PART * large)
    if side is not None:
        left &= side[i] != side[j]
    if not left.any():
        return
    width = min(len(x) for x in bits[slice(*a)] + bits[slice(*b)])
    x = np.stack([fold(r, width) for r in bits[slice(*a)]])
    y = x if a == b else np.stack([fold(r, width) for r in bits[slice(*b)]])
    p, q = np.nonzero(left)
    common = np.bitwise_count(x[p] & y[q]).sum(1, dtype=np.int64)
    spare = np.minimum(sizes[a[0] + p] - np.bitwise_count(x).sum(1, dtype=np.int64)[p], sizes[b[0] + q] - np.bitwise_count(y).sum(1, dtype=np.int64)[q])
    small, large = small[p, q], large[p, q]
    most = np.minimum(common + spare, small)
    for k in np.flatnonzero((PART + WHOLE) * most >= PART * (small + large)):
        yield a[0] + int(p[k]), b[0] + int(q[k]), float(most[k] / (small[k] + large[k] - most[k]))


def _node(shingles: np.ndarray) -> int | None:
    """64-bit name of a set; None for the empty one."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True) if len(shingles) else None


def _fingerprints(documents: DataFrame, kind: str) -> DataFrame:
    """(doc_id, key, n, node, common): size and name of the set, and shingles met often in some batch."""

    def read(batches):
        for batch in batches:
            sets = shingle_sets(batch.column(1))
            flat = np.sort(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
            least = max(COMMON_LEAST, int(COMMON_SHARE * len(sets)))
            run = flat[least - 1 :] == flat[: len(flat) - least + 1] if len(flat) >= least else np.zeros(0, bool)
            common = distinct(flat[: len(run)][run])
            lists = [common if i == 0 else common[:0] for i in range(len(sets))]
            sizes, nodes = [len(s) for s in sets], [_node(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), ragged(lists, pa.int64())],
                ["doc_id", "key", "n", "node", "common"],
            )

    return documents.mapInArrow(read, f"doc_id {kind}, key long, n long, node long, common array<long>")


def _route(documents: DataFrame, common: np.ndarray) -> DataFrame:
    """(node, n, prefix, bits): the shingles by which a set meets others, rare ones first, and its bitmap."""
    sent = documents.sparkSession.sparkContext.broadcast(common)

    def read(batches):
        late = sent.value
        for batch in batches:
            sets = [s for s in shingle_sets(batch.column(1)) if len(s)]
            prefixes = []
            for s in sets:
                at = np.minimum(np.searchsorted(late, s), max(0, len(late) - 1))
                often = late[at] == s if len(late) else np.zeros(len(s), bool)
                k = prefix_length(len(s))
                rare = s[~often]
                prefixes.append(rare[:k] if len(rare) >= k else np.concatenate([rare, s[often]])[:k])
            nodes, sizes, bits = [_node(s) for s in sets], [len(s) for s in sets], [bitmap(s).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), ragged(prefixes, pa.int64()), pa.array(bits, pa.binary())],
                ["node", "n", "prefix", "bits"],
            )

    return documents.mapInArrow(read, "node long, n long, prefix array<long>, bits binary")


def _texts(documents: DataFrame) -> DataFrame:
    """(node, text) of the rows that have shingles. Texts shrink in shuffles and files, fingerprints don't."""

    def read(batches):
        for batch in batches:
            nodes = pa.array([_node(s) for s in shingle_sets(batch.column(1))], pa.int64())
            yield pa.RecordBatch.from_arrays([nodes, batch.column(1)], ["node", "text"]).filter(nodes.is_valid())

    return documents.mapInArrow(read, "node long, text string")


def _once(rows: DataFrame, name: str, nodes: int) -> DataFrame:
    """Stored rows, one a node. Rows that repeat an id may bring a node twice; only then is there a shuffle."""
    rows = stored(rows, name)
    return rows if rows.count() == nodes else stored(rows.dropDuplicates(["node"]), name)


def _buckets(rows: DataFrame) -> DataFrame:
    """(bucket, node, n) from rows (token, node, n, at): rows of a token, cut where none before can link with one after.

    `at` is the token's place in the row's order. Of the first shingle that two linked rows share, each
    has its overlap left from that place on, which bounds the size of the other: by the place, a row of
    size n reaches sizes from 3/4 up to 4/3 of n. In order of size, a row can link only within the run of
    rows of which each is reached by one before. Rows that reach no neighbour, or that none before
    reaches, are left out; one shuffle, nothing held but the row before.
    """

    def read(batches):
        # Of the row before this batch: itself, whether it has gone out, its run's first size, the size that its token's rows reach.
        last, sent, opened, reached = None, False, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if last is None else [last, batch]).combine_chunks()
            token, size = table.column(0).to_numpy(), table.column(2).to_numpy()
            n = size >> 7
            at = -(-(size & 127) * n // PLACES)
            reach = ((PART + WHOLE) * (n - at) - PART * n) // PART
            one = token[1:] == token[:-1]
            group = np.concatenate([[0], np.cumsum(~one)]) << 32
            top = reach.copy()
            if last is not None:
                top[0] = max(top[0], reached)
            top = np.maximum.accumulate(group + top) - group
            same = np.concatenate([[False], one & (n[1:] <= top[:-1])])
            begin = np.maximum.accumulate(np.where(same, 0, np.arange(len(n))))
            first = np.where((begin == 0) & (last is not None), opened, n[begin])
            keep = same & (first <= reach)
            keep[:-1] |= same[1:] & (n[1:] <= reach[:-1])
            out = keep.copy()
            if last is not None and sent:
                out[0] = False
            bucket = mix(token.view(np.uint64) + first.astype(np.uint64) * BASE).view(np.int64)
            last, sent, opened, reached = table.slice(len(token) - 1).to_batches()[0], bool(keep[-1]), int(first[-1]), int(top[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[out]), pa.array(table.column(1).to_numpy()[out]), pa.array(n[out])], ["bucket", "node", "n"]
            )

    # Size and place, rounded down, in one small number: most tokens stand in one row, and all of them are shuffled.
    size = (F.shiftleft(F.col("n"), 7) + F.expr(f"at * {PLACES} div n")).alias("size")
    ordered = rows.select("token", "node", size).repartition("token").sortWithinPartitions("token", "size")
    return ordered.mapInArrow(read, "bucket long, node long, n long")


def _plausible(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """The pairs (u, n, v, m, rank) that their bitmaps leave possible, as (u, v, rank)."""

    def read(batches):
        for batch in batches:
            kept = []
            for n, m, a, b in zip(*(batch.column(k).to_pylist() for k in (3, 4, 5, 6)), strict=True):
                a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
                width = min(len(a), len(b))
                a, b = fold(a, width), fold(b, width)
                spare = min(n - int(np.bitwise_count(a).sum()), m - int(np.bitwise_count(b).sum()))
                kept.append((PART + WHOLE) * (int(np.bitwise_count(a & b).sum()) + spare) >= PART * (n + m))
            yield batch.select([0, 1, 2]).filter(pa.array(kept, pa.bool_()))

    full = pairs.join(bits.select(F.col("node").alias("v"), F.col("bits").alias("right")), "v")
    full = full.join(bits.select(F.col("node").alias("u"), F.col("bits").alias("left")), "u")
    return full.select("u", "v", "rank", "n", "m", "left", "right").mapInArrow(read, "u long, v long, rank int")


def _verified(pairs: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(u, v) of the pairs that are similar enough, by all shingles of both, read anew from their texts."""

    def sets(column):
        """The set of each text; rows in order of one side repeat its texts."""
        different = column.dictionary_encode()
        every = shingle_sets(different.dictionary)
        return [every[i] for i in different.indices.to_pylist()]

    def read(batches):
        for batch in batches:
            hits = []
            for a, b in zip(sets(batch.column(2)), sets(batch.column(3)), strict=True):
                if len(a) > len(b):
                    a, b = b, a
                both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
                hits.append(WHOLE * both >= PART * (len(a) + len(b) - both))
            yield batch.select([0, 1]).filter(pa.array(hits, pa.bool_()))

    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    wanted = stored(classes.join(nodes, "node").select("node", F.col("first").alias("doc_id")), "wanted")
    count = wanted.count()
    texts = rows.join(maybe_broadcast(wanted.select("doc_id"), count), "doc_id", "left_semi")
    texts = _once(_texts(texts), "texts", count)
    full = pairs.select("u", "v").join(texts.select(F.col("node").alias("v"), F.col("text").alias("right")), "v")
    full = full.join(texts.select(F.col("node").alias("u"), F.col("text").alias("left")), "u")
    return full.select("u", "v", "left", "right").mapInArrow(read, "u long, v long")


def _met_representatives(tried: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (u, v) of the pairs (u, v, rank): each row's best first, others only where these have not joined both."""
    best = tried.groupBy("u").agg(F.min_by("v", "rank").alias("v"))
    edges = stored(_verified(best, rows, classes), "edges")
    groups = components(edges)
    rest = tried.select("u", "v").join(best, ["u", "v"], "left_anti")
    for end in ("u", "v"):
        rest = rest.join(groups.select(F.col("node").alias(end), F.col("component").alias(f"{end}_in")), end, "left")
    rest = rest.filter(F.coalesce("u_in", "u") != F.coalesce("v_in", "v")).select("u", "v")
    rest = stored(rest, "rest")
    return edges if rest.isEmpty() else stored(edges.union(_verified(rest, rows, classes)), "edges")


def _candidates(units: DataFrame, limit: int) -> DataFrame:
    """(u, v, unit): for each row of a unit, the `limit` likeliest partners of other groups; unit: set if some were left out.

    A bucket leaves a pair out if both rows' lists of first buckets show an earlier one that they share:
    so the first shared bucket of all puts it out, and hardly any other. A row and its representatives
    have been compared before.
    """

    def join(rows: list[tuple]):
        rows.sort(key=lambda r: (r[3], r[4], r[2]))
        ids = [r[2] for r in rows]
        side = np.array([r[1] for r in rows])
        own = [frozenset(r[7]) for r in rows]
        met = [frozenset(r[8] or ()) for r in rows]
        found = tree_join(
            np.array([r[3] for r in rows]), np.array([r[4] for r in rows]), [np.frombuffer(r[5], np.uint8) for r in rows],
            side if side.max() else None,
        )
        best: dict[int, list[tuple[float, int]]] = {}
        cut: set[int] = set()
        for i, j, bound in found:
            if ids[j] in met[i] or ids[i] in met[j]:
                continue
            if (shared := own[i] & own[j]) and min(shared) < rows[i][6]:
                continue
            # Each link that joins two groups is met from the side of the row with the larger id.
            x, y = (i, j) if ids[i] > ids[j] else (j, i)
            partners = best.setdefault(x, [])
            partners.append((-bound, ids[y]))
            if len(partners) >= 4 * limit:
                partners.sort()
                del partners[limit:]
                cut.add(x)
        for x, partners in best.items():
            partners.sort()
            for _, v in partners[:limit]:
                yield ids[x], v, rows[0][0] if x in cut or len(partners) > limit else None

    def read(batches):
        unit, held = None, []

        def emit():
            out = list(join(held)) if len(held) > 1 else []
            columns = zip(*out, strict=True) if out else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["u", "v", "unit"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != unit:
                    if held:
                        yield emit()
                    unit, held = row[0], []
                held.append(row)
        if held:
            yield emit()

    columns = ["unit", "side", "node", "n", "group", "bits", "bucket", "own", "reps"]
    return units.select(*columns).mapInArrow(read, "u long, v long, unit long")


def _units(hits: DataFrame, groups: DataFrame, bits: DataFrame, again: DataFrame | None) -> DataFrame:
    """Buckets with rows of several groups, as units of bounded size: rows with what `_candidates` reads.

    A bucket of more than TREE_ROWS rows is sorted by size and cut into chunks, the top nodes of its
    tree; two chunks make a unit if their sizes can match and they aren't wholly of one group. With `again`, only its units.
    """
    rows = hits.select("bucket", "node", "n").join(groups, "node", "left")
    rows = rows.select("bucket", "node", "n", F.coalesce("component", "node").alias("group"))
    mixed = rows.groupBy("bucket").agg(F.count("*").alias("count"), F.min("group").alias("a"), F.max("group").alias("b")).filter("a <> b")
    rows = stored(rows.join(mixed.select("bucket", "count"), "bucket"), "mixed")
    own = rows.groupBy("node").agg(F.slice(F.sort_array(F.collect_list("bucket")), 1, OWN_MOST).alias("own"))
    small = rows.filter(F.col("count") <= TREE_ROWS)
    small = small.select(F.xxhash64("bucket").alias("unit"), F.lit(0).alias("side"), "bucket", "node", "n", "group")
    half = TREE_ROWS // 2
    at = F.row_number().over(Window.partitionBy("bucket").orderBy("n", "node"))
    large = stored(rows.filter(F.col("count") > TREE_ROWS).withColumn("chunk", F.floor((at - 1) / half)), "chunks")
    chunks = large.groupBy("bucket", "chunk").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.min("group").alias("low"), F.max("group").alias("high"))
    other = chunks.select("bucket", *(F.col(c).alias(f"o_{c}") for c in ("chunk", "least", "most", "low", "high")))
    met = chunks.join(other, "bucket").filter("chunk <= o_chunk").filter(PART * F.col("o_least") <= WHOLE * F.col("most"))
    met = met.filter(~((F.col("low") == F.col("high")) & (F.col("o_low") == F.col("o_high")) & (F.col("low") == F.col("o_low"))))
    met = met.select("bucket", F.xxhash64("bucket", "chunk", "o_chunk").alias("unit"), "chunk", "o_chunk")
    sides = met.select("bucket", "unit", "chunk", F.lit(0).alias("side")).union(
        met.filter("chunk <> o_chunk").select("bucket", "unit", F.col("o_chunk").alias("chunk"), F.lit(1).alias("side"))
    )
    cut = large.join(sides, ["bucket", "chunk"]).select("unit", "side", "bucket", "node", "n", "group")
    units = small.union(cut)
    if again is not None:
        units = units.join(again, "unit", "left_semi")
    units = units.join(bits.join(own, "node"), "node")
    return units.repartition("unit").sortWithinPartitions("unit")


def jaccard_groups(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row, by links of similar sets of 5-word shingles.

    Words are runs of non-blank characters, A-Z lowered; a text of fewer than five words is one shingle.
    Two rows link where 100 * intersection >= 75 * union. Null and empty texts have no shingles and
    link with nothing. component_id is the least doc_id that links reach, itself included. Rows that
    repeat an id or a text link like any others. Ids are whole numbers; a null id links with nothing.
    An empty table gives an empty one. Shingles are compared by 64-bit fingerprints.

    Equal sets are joined once. A row meets others in the buckets of its first shingles in an order
    with common ones last, a quarter of them, so that every link shares a bucket. Each row first meets a
    few representatives, of the least-named sets of its buckets those it shares most with, which groups
    large families; then a signature tree over each bucket that still has rows of several groups finds pairs
    that may link, and all shingles of both decide. Rounds that took only the likeliest partners are
    repeated with more until none is left out.
    """
    return _groups(documents, doc_id, text).select("doc_id", "n_shingles", "component_id")


def _text_key(text: Column) -> Column:
    """Tells rows of one id apart by their text."""
    return F.xxhash64(text.cast("string"))


def _groups(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The result of jaccard_groups with the `key` of each row's text and its `component`, named by a set."""
    spark = documents.sparkSession
    small_batches(spark)
    kind = documents.schema[doc_id].dataType.simpleString()
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    prints = stored(_fingerprints(rows.withColumn("key", _text_key(F.col("text"))), kind), "prints")
    often = prints.select(F.explode("common").alias("token")).groupBy("token").agg(F.count("*").alias("c"))
    often = often.orderBy(F.desc("c"), "token").limit(COMMON_SHINGLES).select("token").toArrow().column(0).to_numpy()
    classes = prints.filter("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("first"))
    classes = stored(classes, "classes")
    n_classes = classes.count()

    firsts = maybe_broadcast(classes.select(F.col("first").alias("doc_id")), n_classes)
    routed = _once(_route(rows.join(firsts, "doc_id", "left_semi"), np.sort(often.view(np.uint64))), "routed", n_classes)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
    hits = stored(_buckets(routed.select(F.posexplode("prefix").alias("at", "token"), "node", "n")), "hits")
    small_batches(spark)
    # Buckets of the same rows are one, of so much more weight; a row alone meets no other.
    stats = hits.groupBy("bucket").agg(F.count("*").alias("c"), F.min("node").alias("pivot"), F.bit_xor(F.xxhash64("node")).alias("who"))
    stats = stats.filter("c > 1")
    stats = stats.groupBy("c", "pivot", "who").agg(F.min("bucket").alias("bucket"), F.count("*").alias("weight"))
    hits = stored(hits.join(stats.select("bucket", "pivot", "weight"), "bucket"), "buckets")

    # A row's representatives: of the least-named sets of its buckets, near enough in size, those of most weight.
    bits = routed.select("node", "bits")
    met = hits.filter("node <> pivot").groupBy("node", "pivot").agg(F.first("n").alias("n"), F.sum("weight").alias("weight"))
    size = hits.filter("node = pivot").groupBy("pivot").agg(F.first("n").alias("m"))
    met = met.join(size, "pivot").filter(WHOLE * F.least("n", "m") >= PART * F.greatest("n", "m"))
    best = F.slice(F.sort_array(F.collect_list(F.struct("weight", "m", "pivot")), False), 1, REPRESENTATIVES)
    met = stored(met.groupBy("node", "n").agg(best.alias("best")), "met")
    bits = bits.join(met.select("node", F.col("best.pivot").alias("reps")), "node", "left")
    tried = met.select(F.col("node").alias("u"), "n", F.posexplode("best").alias("rank", "best"))
    tried = tried.select("u", F.col("best.pivot").alias("v"), "n", F.col("best.m").alias("m"), "rank")
    tried = stored(_plausible(tried, routed.select("node", "bits")), "tried")
    edges, limit = _met_representatives(tried, rows, classes), FIRST_PARTNERS
    tried = tried.select("u", "v")
    again = None
    while True:
        groups = components(edges)
        found = stored(_candidates(_units(hits, groups, bits, again), limit), "candidates")
        again = stored(found.filter("unit IS NOT NULL").select("unit").distinct(), "again")
        pairs = stored(found.select("u", "v").distinct(), "pairs")
        new = stored(pairs.join(tried, ["u", "v"], "left_anti"), "new")
        complete, none = again.isEmpty(), new.isEmpty()
        if not none:
            edges, tried = stored(edges.union(_verified(new, rows, classes)), "edges"), tried.union(new)
        if complete:
            groups = groups if none else components(edges)
            break
        limit *= MORE_PARTNERS

    classes = classes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    named = classes.join(least, "component").select("node", "component", "component_id")
    node = F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node")
    out = prints.select("doc_id", "key", "n", node).join(named, "node", "left")
    component_id = F.coalesce("component_id", "doc_id").alias("component_id")
    return out.select("doc_id", "key", F.col("n").alias("n_shingles"), "component", component_id)


def keep_one_of_each_group(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, with all columns, whose id is the least of their group; of a group's rows that repeat it, one.

    Rows without shingles or without an id are no one's copies and all stay. Each row goes or stays by
    its own text, also where an id stands on rows with different texts. Columns may have any names.
    """
    groups = stored(_groups(documents, doc_id, text).filter("doc_id IS NOT NULL AND n_shingles > 0"), "groups")
    dropped = groups.filter("doc_id <> component_id").select(F.col("doc_id").alias("id"), "key").distinct()
    dropped = stored(dropped, "dropped")
    least = groups.filter("doc_id = component_id").select(F.col("doc_id").alias("id"), "component", "key")
    repeated = stored(least.groupBy("id", "component").agg(F.count("*").alias("n"), F.collect_set("key").alias("keys")).filter("n > 1"), "repeated")
    # The row travels as one value, so that its columns can't be taken for ours.
    columns = [F.col(f"`{c}`") for c in documents.columns]
    rows = documents.select(F.struct(*columns).alias("row"), F.col(f"`{doc_id}`").alias("id"), _text_key(F.col(f"`{text}`")).alias("key"))
    kept = rows.join(maybe_broadcast(dropped, dropped.count()), ["id", "key"], "left_anti")
    if not repeated.isEmpty():
        again = repeated.select("id", "component", F.explode("keys").alias("key"))
        one = kept.join(again, ["id", "key"]).groupBy("id", "component").agg(F.any_value("row").alias("row"))
        kept = kept.join(again, ["id", "key"], "left_anti").select("row").unionByName(one.select("row"))
    return kept.select(*[F.col("row")[c].alias(c) for c in documents.columns])
