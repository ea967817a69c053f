"""Splits, samples and folds of exact size, taken as slices of the row-key order."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ordering import assign_segments, row_key
from riskloom.schema import SEED, TEST_FRACTION

_NULL_STRATUM = "\u0000"
_SEPARATOR = "\u0001"


def _stratum(label: str) -> Column:
    return F.coalesce(F.col(label).cast("string"), F.lit(_NULL_STRATUM))


def _in_label_order(sizes: dict[str, int]) -> list[str]:
    def rank(s):
        try:
            return (0, float(s), s)
        except ValueError:
            return (1, 0.0, s)

    return sorted(sizes, key=rank)


def split_quotas(sizes: dict[str, int], fraction: float) -> dict[str, int]:
    """Test rows per class: ceil(n x fraction) in all, shares kept, largest remainders first."""
    total = sum(sizes.values())
    want = math.ceil(fraction * total)
    quota = {s: want * n // total for s, n in sizes.items()}
    by_remainder = sorted(_in_label_order(sizes), key=lambda s: -(want * sizes[s] % total))
    for s in by_remainder[: want - sum(quota.values())]:
        quota[s] += 1
    return quota


def sample_quotas(sizes: dict[str, int], max_rows: int) -> dict[str, int]:
    """Rows per class: round(max/n x class size), half to even; everything if n <= max."""
    total = sum(sizes.values())
    if total <= max_rows:
        return dict(sizes)
    return {s: round(max_rows / total * n) for s, n in sizes.items()}


def fold_quotas(sizes: dict[str, int], k: int) -> dict[str, list[int]]:
    """Rows per class and fold when classes are laid end to end and dealt round-robin to folds."""
    quotas, start = {}, 0
    for s in _in_label_order(sizes):
        end = start + sizes[s]
        quotas[s] = [(end - f + k - 1) // k - (start - f + k - 1) // k for f in range(k)]
        start = end
    return quotas


def stratified_split(
    df: DataFrame,
    label: str,
    fraction: float = TEST_FRACTION,
    seed: int = SEED,
    key: Column | None = None,
    out: str = "split",
) -> DataFrame:
    """Adds `split` = 'test' or 'train'."""
    key = row_key(df, seed=seed) if key is None else key

    def ends(sizes):
        return {s: [n] for s, n in split_quotas(sizes, fraction).items()}

    parts = assign_segments(df, key, _stratum(label), ends, out)
    return parts.withColumn(out, F.when(F.col(out) == 0, "test").otherwise("train"))


def _grouped_quotas(sizes: dict[str, int], quotas: Callable[[dict[str, int]], dict]) -> dict:
    """Quotas of each group by itself, where strata are named group, separator, class."""
    groups: dict[str, dict[str, int]] = {}
    for s, n in sizes.items():
        group, _, own = s.partition(_SEPARATOR)
        groups.setdefault(group, {})[own] = n
    return {f"{g}{_SEPARATOR}{s}": q for g, of in groups.items() for s, q in quotas(of).items()}


def stratified_sample(
    df: DataFrame, label: str, max_rows: int, seed: int = SEED, key: Column | None = None, by: str | None = None
) -> DataFrame:
    """At most about max_rows rows with class shares kept; all rows if there are no more than that.

    With `by`, so many of each of its values, which must not contain U+0001.
    """
    key = row_key(df, seed=seed) if key is None else key
    group = F.lit("") if by is None else F.coalesce(F.col(by).cast("string"), F.lit(_NULL_STRATUM))

    def ends(sizes):
        return {s: [n] for s, n in _grouped_quotas(sizes, lambda of: sample_quotas(of, max_rows)).items()}

    stratum = F.concat(group, F.lit(_SEPARATOR), _stratum(label))
    return assign_segments(df, key, stratum, ends, "__segment").filter("__segment = 0").drop("__segment")


def stratified_fit_split(
    df: DataFrame,
    label: str,
    max_rows: int | None = None,
    fraction: float = TEST_FRACTION,
    seed: int = SEED,
    key: Column | None = None,
    out: str = "part",
) -> DataFrame:
    """Adds `part` = 'fit' or 'valid': of a sample of about max_rows rows all but `fraction` are fit.

    Every other row, in the sample or not, is for validation. No limit means a sample of all rows. With
    the same key, stratified_sample of max_rows holds all fit rows.
    """
    key = row_key(df, seed=seed) if key is None else key

    def ends(sizes):
        sample = sizes if max_rows is None else sample_quotas(sizes, max_rows)
        held = split_quotas(sample, fraction) if sum(sample.values()) else sample
        return {s: [n - held[s]] for s, n in sample.items()}

    parts = assign_segments(df, key, _stratum(label), ends, out)
    return parts.withColumn(out, F.when(F.col(out) == 0, "fit").otherwise("valid"))


def stratified_kfold(
    df: DataFrame, label: str, k: int = 5, seed: int = SEED, key: Column | None = None, out: str = "fold"
) -> DataFrame:
    """Adds `fold` in 0..k-1; class counts and fold sizes differ by at most one."""
    key = row_key(df, seed=seed) if key is None else key

    def ends(sizes):
        return {
            s: [sum(counts[: f + 1]) for f in range(k - 1)] for s, counts in fold_quotas(sizes, k).items()
        }

    return assign_segments(df, key, _stratum(label), ends, out)


def sample_n(df: DataFrame, n: int, seed: int = SEED, key: Column | None = None) -> DataFrame:
    """Exactly min(n, count) rows without replacement; rows stay where they are."""
    key = row_key(df, seed=seed) if key is None else key

    def ends(sizes):
        return {s: [min(n, size)] for s, size in sizes.items()}

    return assign_segments(df, key, F.lit("all"), ends, "__segment").filter("__segment = 0").drop("__segment")
