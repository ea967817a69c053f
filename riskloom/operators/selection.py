"""Values at exact ranks of many columns at once, by sketches that merge and counts that decide.

A pass over the rows is one aggregate: no row a cell, no shuffle of values. A sketch, whose rank error
is bounded, gives a bracket that should hold a wanted rank; the next pass counts exactly what lies
below, on and between the bracket's ends, and brings the values between them if the bound says that
they are few. Values that tie by the million are one end of a bracket, so they cost a count. Where more
values are left, the same two passes go on inside the bracket: 5 million rows take two passes, 2
billion four. A bracket that misses its rank is widened, so results never rest on the sketch.
"""

from __future__ import annotations

import operator
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

# Size of the KLL sketches and their rank error at that size (99 % of all ranks); a bracket reaches three of it
# to each side. A sketch takes about 0.4 MB a column, whatever the number of rows.
SKETCH_SIZE = 16_384
SKETCH_ERROR = 2.6e-4
SLACK = 3 * SKETCH_ERROR
# Values of one column, target and group that may come to the driver.
VALUES_KEPT = 10_000
_BOUNDS = ArrayType(ArrayType(DoubleType()))


@dataclass(frozen=True)
class Target:
    """Ranks (from 0, ascending order) wanted of n values, and about which share of n they stand at."""

    level: float
    ranks: Callable[[int], Sequence[int]]


@dataclass(frozen=True)
class Located:
    """The value at a rank, and how many values are smaller and equal."""

    value: float
    less: int
    equal: int


@dataclass
class Search:
    """One target of one column of one group. Ranks still wanted lie in the open interval (low, high)."""

    size: int
    wanted: list[int]
    bracket: tuple[float | None, float | None]
    inside: int
    low: float | None = None
    high: float | None = None
    below: int = 0
    slack: float = SLACK
    found: dict[int, Located] = field(default_factory=dict)

    def most_between(self) -> float:
        """At most so many values lie strictly between the bracket's ends."""
        return self.inside if self.whole() else min(self.inside, 4 + 2 * (self.slack + SKETCH_ERROR) * self.inside)

    def whole(self) -> bool:
        """Few values are left, so the interval itself is the bracket."""
        return self.inside <= VALUES_KEPT

    def levels(self) -> list[float]:
        """Shares of the interval's values to bracket the wanted ranks with."""
        first, last = ((r - self.below + 0.5) / max(1, self.inside) for r in (self.wanted[0], self.wanted[-1]))
        return [max(0.0, first - self.slack), min(1.0, last + self.slack)]

    def settle(self, less: int, start: int, stop: int, end: int, values: list[float] | None = None) -> None:
        """From exact counts of values below and up to both ends: finds ranks, or narrows, or widens the next bracket."""
        low, high = self.bracket
        if high is None:
            stop = end = self.size
        if low is not None and low == high:
            stop = end = start
        on_low, between, on_high = start - less, stop - start, end - stop
        ordered = None if values is None else sorted(values)
        missed, left = [], []
        for rank in self.wanted:
            if less <= rank < start:
                self.found[rank] = Located(low, less, on_low)
            elif start + between <= rank < start + between + on_high:
                self.found[rank] = Located(high, start + between, on_high)
            elif start <= rank < start + between and ordered is not None:
                value = ordered[rank - start]
                first = bisect_left(ordered, value)
                self.found[rank] = Located(value, start + first, bisect_right(ordered, value) - first)
            elif start <= rank < start + between:
                left.append(rank)
            else:
                missed.append(rank)
        self.wanted = sorted(missed + left)
        if missed and self.slack > 1:
            raise RuntimeError(f"a sketch misses ranks {missed} of {self.size} at any width")
        if missed:
            self.slack *= 8
        elif left:
            self.low, self.high, self.below, self.inside, self.slack = low, high, start, between, SLACK


def _sketch(value: Column, levels: Sequence[float]) -> Column:
    """Aggregate: values at about these shares of all, NULL without values."""
    made = F.kll_sketch_agg_double(value, F.lit(SKETCH_SIZE))
    return F.when(F.count(value) > 0, F.kll_sketch_get_quantile_double(made, F.array(*[F.lit(x) for x in levels])))


def _name(key: tuple) -> str:
    return "/".join(map(str, key))


class Passes:
    """Aggregates over all open searches; the bounds of groups come from a small table, a row a group."""

    def __init__(self, df: DataFrame, columns: dict[str, Column], by: Sequence[str]) -> None:
        self.df, self.columns, self.by = df, columns, list(by)

    def run(self, searches: dict[tuple, dict], bounds: Callable, cells: Callable) -> list[tuple[Search, tuple]]:
        """(search, its cells) of all given searches: `cells(key, value, low, high, own)` are the aggregates.

        `bounds(search)` gives low and high; `own` tells rows of groups that have a search of that key.
        """
        keys = sorted({k for of in searches.values() for k in of})
        if not self.by:
            numbers = {k: [None if b is None else F.lit(b) for b in bounds(s)] + [None] for k, s in searches[()].items()}
            source = self.df
        else:
            rows = [(*group, [list(bounds(of[k])) if k in of else None for k in keys]) for group, of in searches.items()]
            fields = [StructField(f"__of_{c}", self.df.schema[c].dataType) for c in self.by]
            table = self.df.sparkSession.createDataFrame(rows, StructType([*fields, StructField("__bounds", _BOUNDS)]))
            same = [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in self.by]
            source = self.df.join(F.broadcast(table), same, "left")
            at = {k: F.get("__bounds", F.lit(i)) for i, k in enumerate(keys)}
            numbers = {k: [F.get(v, F.lit(0)), F.get(v, F.lit(1)), v.isNotNull()] for k, v in at.items()}
        parts = [
            F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cells(k, self.columns[k[0]], *numbers[k]))]).alias(_name(k)) for k in keys
        ]
        found = {tuple(row[c] for c in self.by): row for row in source.groupBy(*self.by).agg(*parts).collect()}
        return [(s, tuple(found[g][_name(k)])) for g, of in searches.items() for k, s in of.items()]


def _between(value: Column, low: Column | None, high: Column | None, own: Column | None) -> Column:
    """Values strictly inside; a missing bound bounds nothing."""
    tests = [F.lit(True) if low is None else value > low, F.lit(True) if high is None else value < high]
    if own is not None:  # a group's bounds may be missing in its row
        tests = [own, value.isNotNull(), *[F.coalesce(test, F.lit(True)) for test in tests]]
    return reduce(Column.__and__, tests)


def _sketch_again(work: Passes, searches: dict[tuple, dict]) -> None:
    """New brackets inside the intervals that are left."""
    pairs: dict[tuple, set] = {}
    for of in searches.values():
        for k, s in of.items():
            pairs.setdefault(k, set()).update(s.levels())
    levels = {k: sorted(of) for k, of in pairs.items()}

    def cells(k, value, low, high, own):
        return [_sketch(F.when(_between(value, low, high, own), value), levels[k])]

    keys = {id(s): k for of in searches.values() for k, s in of.items()}
    for search, (values,) in work.run(searches, lambda s: (s.low, s.high), cells):
        at = levels[keys[id(search)]]
        search.bracket = tuple(values[at.index(x)] for x in search.levels())


def _count(work: Passes, searches: dict[tuple, dict]) -> None:
    """Exact counts of every bracket, and the values between its ends where they are few in all groups."""
    few = {k: all(of[k].most_between() <= VALUES_KEPT for of in searches.values() if k in of) for of in searches.values() for k in of}

    def cells(k, value, low, high, own):
        made = [F.lit(0) if end is None else F.count_if(test(value, end)) for end in (low, high) for test in (operator.lt, operator.le)]
        return [*made, F.collect_list(F.when(_between(value, low, high, own), value))] if few[k] else made

    for search, counts in work.run(searches, lambda s: s.bracket, cells):
        search.settle(*counts)


def select_ranks(
    df: DataFrame, columns: dict[str, Column], targets: Sequence[Target], by: Sequence[str] = ()
) -> dict[tuple, dict[str, list[Search]]]:
    """For each group (the empty one without `by`) and column, a settled search for each target.

    Its `found` maps ranks to values, NULLs and NaN left out; a column without values has none. Columns
    are DOUBLE. The driver holds a few numbers, and up to VALUES_KEPT values, for
    each group, column and target.
    """
    by = list(by)
    columns = {n: F.nullif(c.cast("double"), F.lit(float("nan"))) for n, c in columns.items()}
    levels = [x for t in targets for x in (max(0.0, t.level - SLACK), min(1.0, t.level + SLACK))]
    first = df.groupBy(*by).agg(
        *[F.count(c).alias(f"{n}/n") for n, c in columns.items()],
        *[_sketch(c, levels).alias(f"{n}/b") for n, c in columns.items()],
    )
    searches: dict[tuple, dict[tuple, Search]] = {}
    for row in first.collect():
        of = searches[tuple(row[c] for c in by)] = {}
        for name in columns:
            size, ends = row[f"{name}/n"], row[f"{name}/b"]
            for i, target in enumerate(targets):
                wanted = sorted({r for r in target.ranks(size) if 0 <= r < size}) if size else []
                of[name, i] = Search(size, wanted, tuple(ends[2 * i : 2 * i + 2]) if size else (None, None), size)

    def still(test: Callable[[Search], bool]) -> dict[tuple, dict]:
        of = {g: {k: s for k, s in of.items() if s.wanted and test(s)} for g, of in searches.items()}
        return {g: found for g, found in of.items() if found}

    work = Passes(df, columns, by)
    left = still(lambda s: True)
    while left:
        _count(work, left)
        left = still(lambda s: True)
        for of in left.values():
            for s in of.values():
                if s.whole():
                    s.bracket = s.low, s.high
        if wide := still(lambda s: not s.whole()):
            _sketch_again(work, wide)
    return {g: {n: [of[n, i] for i in range(len(targets))] for n in columns} for g, of in searches.items()}


def exact_quantiles(
    df: DataFrame, columns: dict[str, Column], q: Fraction, by: Sequence[str] = ()
) -> dict[str, float | None] | dict[tuple, dict[str, float | None]]:
    """Linear-interpolated quantile q of each named DOUBLE column; None where all values are NULL or NaN.

    With `by`, a dictionary of such results by group.
    """

    def ranks(n: int) -> list[int]:
        low = q.numerator * (n - 1) // q.denominator
        return [low, min(low + 1, n - 1)]

    def value(search: Search) -> float | None:
        if not search.found:
            return None
        low, top = (search.found[r].value for r in ranks(search.size))
        share = q.numerator * (search.size - 1) % q.denominator / q.denominator
        return low if share == 0 or low == top else low + (top - low) * share

    found = select_ranks(df, columns, [Target(float(q), ranks)], by)
    made = {g: {n: value(of[n][0]) for n in columns} for g, of in found.items()}
    return made if by else made.get((), dict.fromkeys(columns))


def approximate_quantile(df: DataFrame, column: Column, q: Fraction) -> float | None:
    """A value whose rank is off by about SKETCH_ERROR of all values at most, from one pass; None without values."""
    column = F.nullif(column.cast("double"), F.lit(float("nan")))
    found = df.agg(_sketch(column, [float(q)]).alias("v")).first()["v"]
    return found[0] if found else None
