"""A fitted pipeline as one column: an expression for a handful of rows, Arrow batches for any number.

Model stages cost about a second to plan, whatever the number of rows. Here the trees are flat arrays
(feature, threshold, children, value) that an expression walks, `depth` steps a tree; its size doesn't
grow with the trees, and Spark evaluates it on a local table without starting a job.

Over whole tables the stages cost a vector a row and a walk over objects a tree, again wherever a plan
repeats the probability. `batch_probability` looks up which leaves of all trees each value of a row leaves
open and takes the first that all values do, without a walk; a plan evaluates it once a row.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.parsing import number_column
from riskloom.operators.ordering import opaque

# What runs in Python workers travels with its tasks, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows whose open leaves fit a core's cache; and the leaves that one word tells apart.
ROWS_PER_PASS = 512
LEAVES_MOST = 64

_SEPARATOR = "\u0001"
_WEIGHT = re.compile(r"Tree \d+ \(weight (\S+)\):")
_SPLIT = re.compile(r"If \(feature (\d+) (<=|in) \{?([^})]*)\}?\)")


@dataclass
class Forest:
    """Nodes of all trees one after another; a leaf's children are -1."""

    numeric: list[str]
    numeric_fills: list[float]
    categorical: list[str]
    categorical_fills: list[str]
    labels: list[list[str]]
    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    roots: list[int] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    depth: int = 0

    def _node(self) -> int:
        for values, empty in ((self.feature, 0), (self.threshold, 0.0), (self.left, -1), (self.right, -1), (self.value, 0.0)):
            values.append(empty)
        return len(self.feature) - 1

    def add_tree(self, lines: list[str], weight: float) -> None:
        """Lines of a printed tree: If, its left side, Else, its right side, or Predict."""
        lines = iter(lines)

        def read(depth: int) -> int:
            line, at = next(lines), self._node()
            self.depth = max(self.depth, depth)
            if line.startswith("Predict: "):
                self.value[at] = float(line.removeprefix("Predict: "))
                return at
            found = _SPLIT.match(line)
            if found is None:
                raise ValueError(f"unknown split: {line}")
            index, kind, text = found.groups()
            first = read(depth + 1)
            next(lines)
            second = read(depth + 1)
            self.feature[at] = int(index)
            if kind == "<=":
                self.threshold[at], goes_left = float(text), True
            else:  # a one-hot slot: its left categories are 0 or 1
                if text not in ("0.0", "1.0"):
                    raise ValueError(f"unknown categories: {line}")
                self.threshold[at], goes_left = 0.5, text == "0.0"
            self.left[at], self.right[at] = (first, second) if goes_left else (second, first)
            return at

        self.roots.append(read(0))
        self.weights.append(weight)


@lru_cache(maxsize=8)
def forest_of(model: PipelineModel) -> Forest:
    """Reads the fitted stages; once a model object."""
    imputer, index, _, _, trees = model.stages
    forest = Forest(
        imputer.getOrDefault("numericCols"),
        imputer.getOrDefault("numericFills"),
        imputer.getOrDefault("categoricalCols"),
        imputer.getOrDefault("categoricalFills"),
        [list(of) for of in index.labelsArray],
    )
    lines: list[str] = []
    weight = None
    for line in [*map(str.strip, trees.toDebugString.splitlines()[1:]), "Tree 0 (weight 0):"]:
        head = _WEIGHT.match(line)
        if head is None:
            lines.append(line) if line else None
            continue
        if weight is not None:
            forest.add_tree(lines, weight)
        lines, weight = [], float(head[1])
    return forest


# Arrays that the expression walks, as columns of the rows themselves; and their types.
NODE_COLUMNS = {
    "__forest_feature": "int",
    "__forest_threshold": "double",
    "__forest_left": "int",
    "__forest_right": "int",
    "__forest_value": "double",
    "__forest_roots": "int",
    "__forest_weights": "double",
}


def node_arrays(forest: Forest) -> dict[str, list]:
    """What the columns NODE_COLUMNS of a row hold."""
    return {c: getattr(forest, c.removeprefix("__forest_")) for c in NODE_COLUMNS}


def _filled(forest: Forest, df: DataFrame) -> list[Column]:
    """Numeric columns, then categorical ones as text, gaps filled as the imputer fills them."""
    numbers = [F.coalesce(number_column(df, c), F.lit(v)) for c, v in zip(forest.numeric, forest.numeric_fills)]
    texts = zip(forest.categorical, forest.categorical_fills)
    return [*numbers, *[F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit(v)) for c, v in texts]]


def _literal(values: Sequence, kind: str) -> Column:
    """An array constant of any length as one literal: Spark folds the split and the cast away."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def forest_probability(forest: Forest, df: DataFrame) -> Column:
    """Claim probability of rows with the feature columns, as the pipeline gives it (other order of summation).

    The arrays are taken from the columns NODE_COLUMNS if the rows have them, else from constants.
    """
    filled = _filled(forest, df)
    numbers = F.array(*filled[: len(forest.numeric)])
    slots, offset = [], len(forest.numeric)
    for text, labels in zip(filled[offset:], forest.labels):
        at = F.array_position(F.split(F.lit(_SEPARATOR.join(labels)), _SEPARATOR), text)
        # An unseen category has no slot.
        slots.append(F.when(at > 0, at + (offset - 1)).otherwise(F.lit(-1)).cast("int"))
        offset += len(labels)
    hot = F.array(*slots)
    arrays = {c.removeprefix("__forest_"): F.col(c) if c in df.columns else _literal(node_arrays(forest)[c], kind) for c, kind in NODE_COLUMNS.items()}
    feature, threshold, left, right, value = (arrays[c] for c in ("feature", "threshold", "left", "right", "value"))

    def step(node: Column, _: Column) -> Column:
        index = F.get(feature, node)
        own = F.when(index < len(forest.numeric), F.get(numbers, index)).otherwise(F.array_contains(hot, index).cast("double"))
        child = F.when(own <= F.get(threshold, node), F.get(left, node)).otherwise(F.get(right, node))
        return F.when(F.get(left, node) < 0, node).otherwise(child)

    steps = F.sequence(F.lit(1), F.lit(max(1, forest.depth)))
    parts = F.zip_with(arrays["roots"], arrays["weights"], lambda root, weight: weight * F.get(value, F.aggregate(steps, root, step)))
    margin = F.aggregate(parts, F.lit(0.0), lambda total, part: total + part)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))


def _places(forest: Forest) -> tuple[list[int], list[int]]:
    """Column and code of each vector slot; the code of a number is -1."""
    of = [(i, -1) for i in range(len(forest.numeric))]
    of += [(len(forest.numeric) + j, k) for j, labels in enumerate(forest.labels) for k in range(len(labels))]
    return [column for column, _ in of], [code for _, code in of]


def dense_vectors(forest: Forest, df: DataFrame, width: int, out: str) -> DataFrame:
    """Adds the model's input as a vector with room for each of `width` slots, which a tree's node reads without a search.

    Equal to what the preparation stages give: an unseen category has no slot, slots beyond the known ones hold zero.
    """
    filled = _filled(forest, df)
    numbers = len(forest.numeric)
    codes = {
        f"__code{j}": F.array_position(F.split(F.lit(_SEPARATOR.join(labels)), _SEPARATOR), text).cast("int")
        for j, (text, labels) in enumerate(zip(filled[numbers:], forest.labels))
    }
    zero, one, parts = F.lit(0.0), F.lit(1.0), [F.array(*filled[:numbers])]
    for c, labels in zip(codes, forest.labels):
        at = F.col(c)
        parts += [F.array_repeat(zero, F.greatest(at - 1, F.lit(0))), F.array_repeat(one, F.least(at, F.lit(1))), F.array_repeat(zero, len(labels) - at)]
    slots = numbers + sum(map(len, forest.labels))
    values = F.concat(*parts, F.array_repeat(zero, max(0, width - slots)))
    values = values if slots <= width else F.slice(values, 1, width)
    # Opaque, or a plan makes the vector again wherever it is used.
    return df.withColumns(codes).withColumn(out, opaque(array_to_vector(values))).drop(*codes)


def _pieces(forest: Forest, root: int) -> list[tuple[list[tuple[int, int, int]], list[float]]]:
    """A tree as trees of at most LEAVES_MOST leaves that add up to it.

    A tree is its inner nodes (node, first leaf, first leaf of its right side) and its leaves' values, from left to right.
    Too large a tree becomes one that has only its left side, and one that has only its right side.
    """

    def read(node: int, inner: list, values: list, without: frozenset) -> None:
        if node in without or forest.left[node] < 0:
            values.append(0.0 if node in without else forest.value[node])
            return
        at, first = len(inner), len(values)
        inner.append((node, first, first))
        read(forest.left[node], inner, values, without)
        inner[at] = (node, first, len(values))
        read(forest.right[node], inner, values, without)

    todo, pieces = [(root, frozenset())], []
    while todo:
        cut, without = todo.pop()
        inner, values = [], []
        read(root, inner, values, without)
        if len(values) <= LEAVES_MOST:
            pieces.append((inner, values))
            continue
        # `cut` is the node whose sides are told apart next: the topmost with two sides left.
        while without & {forest.left[cut], forest.right[cut]}:
            cut = forest.right[cut] if forest.left[cut] in without else forest.left[cut]
        todo += [(cut, without | {forest.left[cut]}), (cut, without | {forest.right[cut]})]
    return pieces


def _masks(forest: Forest) -> tuple[list[np.ndarray], list[list[str]], list[np.ndarray], np.ndarray]:
    """Per numeric column its thresholds, per category column the categories that a node asks for, per column the leaves
    of every tree that a value's bin leaves open, as bits, and the leaves' weighted values (tree, leaf).

    The bin of a number is how many thresholds lie below it, that of a category its place in the list, the last bin is
    for all others. A row ends in the first leaf of a tree that all of its columns leave open.
    """
    columns, codes = _places(forest)
    pieces = [(piece, weight) for root, weight in zip(forest.roots, forest.weights) for piece in _pieces(forest, root)]
    inner = {node for (nodes, _), _ in pieces for node, _, _ in nodes if forest.feature[node] < len(columns)}
    numbers = len(forest.numeric)
    cuts = [sorted({forest.threshold[i] for i in inner if columns[forest.feature[i]] == c}) for c in range(numbers)]
    asked = [sorted({codes[forest.feature[i]] for i in inner if columns[forest.feature[i]] == c}) for c in range(numbers, numbers + len(forest.labels))]
    at = [{value: i for i, value in enumerate(of)} for of in [*cuts, *asked]]
    most = max([len(values) for (_, values), _ in pieces], default=1)
    kind = next(np.dtype(f"u{size}") for size in (2, 4, 8) if most <= 8 * size)
    every = (1 << (8 * kind.itemsize)) - 1
    open_ = [np.full((len(of) + 1, len(pieces)), every, kind) for of in at]
    value = np.zeros((len(pieces), most))
    for tree, ((nodes, values), weight) in enumerate(pieces):
        value[tree, : len(values)] = weight * np.array(values)
        for node, first, middle in nodes:
            slot, limit = forest.feature[node], forest.threshold[node]
            right_only = kind.type(every ^ ((1 << middle) - (1 << first)))
            # A slot that the vectors lack holds zero, one of a category zero or one.
            if slot >= len(columns):
                if not 0.0 <= limit:
                    open_[0][:, tree] &= right_only
            elif codes[slot] < 0:
                open_[columns[slot]][at[columns[slot]][limit] + 1 :, tree] &= right_only
            else:
                own = np.arange(len(open_[columns[slot]])) == at[columns[slot]][codes[slot]]
                open_[columns[slot]][np.where(own, not 1.0 <= limit, not 0.0 <= limit), tree] &= right_only
    names = [[labels[code] for code in of] for labels, of in zip(forest.labels, asked)]
    return [np.array(of, float) for of in cuts], names, open_, value


def _margins(forest: Forest, batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[np.ndarray]:
    """Weighted sums of the trees' values, for batches of filled columns."""
    cuts, names, open_, value = _masks(forest)
    names = [pa.array(of, pa.string()) for of in names]
    one, flat = open_[0].dtype.type(1), value.ravel()
    tree = np.arange(len(value)) * value.shape[1]
    for columns in batches:
        bins = [np.searchsorted(limits, c.to_numpy(zero_copy_only=False), side="left") for c, limits in zip(columns, cuts)]
        for c, of in zip(columns[len(cuts) :], names):
            bins.append(pc.fill_null(pc.index_in(c.cast(pa.string()), of), len(of)).to_numpy(zero_copy_only=False))
        total = np.empty(len(columns[0]))
        for low in range(0, len(total), ROWS_PER_PASS):
            part = slice(low, low + ROWS_PER_PASS)
            left = open_[0].take(bins[0][part], axis=0)
            for of, own in zip(open_[1:], bins[1:]):
                if len(of) > 1:
                    left &= of.take(own[part], axis=0)
            # The bits below the lowest one that is set count the leaves before it.
            total[part] = flat.take(np.bitwise_count((left - one) & ~left) + tree).sum(axis=1)
        yield total


def batch_probability(forest: Forest, df: DataFrame) -> Column:
    """Claim probability of rows with the feature columns, as the pipeline gives it (other order of summation).

    Arrow hands each task's rows to numpy in batches; no other column leaves the JVM.
    """

    def probability(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for margin in _margins(forest, batches):
            with np.errstate(over="ignore"):
                yield pa.array(1.0 - 1.0 / (1.0 + np.exp(2.0 * margin)))

    return F.arrow_udf(probability, "double")(*_filled(forest, df))
