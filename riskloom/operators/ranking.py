"""Top-X% decisions and reports: the k best-scored rows, exactly, without ranking every row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.decisions import decide_threshold
from riskloom.operators.metrics import confusion_counts, rates, score
from riskloom.operators.ordering import assign_segments, row_key
from riskloom.operators.reference import draw_sample
from riskloom.operators.selection import Target, approximate_quantile, exact_quantiles, select_ranks
from riskloom.schema import REFERENCE_SAMPLE, TOP_PERCENTS
from riskloom.session import materialize, store


def top_segments(
    df: DataFrame,
    p: str,
    percents: Sequence[int],
    counts: Callable[[int, int], int],
    key: Column | None = None,
    out: str = "segment",
) -> DataFrame:
    """Labels rows, best score first, with the number of top-k ends before them.

    `counts(n, percent)` is each k, ascending, near `percent` hundredths of the row count. The score at
    each k is found by sketch and count, two aggregates that shuffle no scores; only rows tied at a
    score that an end cuts are ordered further, by row key, from a stored table of their keys.
    """
    key = row_key(df) if key is None else key
    scored = df.withColumn("__score", score(p))
    # Ranks count from the lowest score; a missing score is the lowest of all, so none is left out.
    targets = [Target(1 - x / 100, lambda n, x=x: [n - counts(n, x)]) for x in percents]
    found = select_ranks(scored, {"score": F.col("__score")}, targets)[()]["score"]
    total = found[0].size if found else 0
    ranks = [counts(total, x) for x in percents]
    by_score = F.lit(sum(1 for k in ranks if k <= 0))
    inside: dict[str, list[int]] = {}
    edges = {}
    for k, search in zip(ranks, found, strict=True):
        for at in search.found.values():
            first = total - at.less - at.equal  # rows with a higher score
            if 0 < k < total:
                edges[repr(at.value)] = at
                inside.setdefault(repr(at.value), []).append(k - first)
    ties = None
    for name, at in edges.items():
        by_score = by_score + F.when(F.col("__score") < at.value, len(inside[name])).otherwise(0)
        if any(k < at.equal for k in inside[name]):
            ties = (F if ties is None else ties).when(F.col("__score") == at.value, name)
    if ties is None:
        return scored.withColumn(out, by_score).drop("__score")

    # Rows outside a tie form one stratum without ends and need no key, so one narrow pass labels all.
    tied = scored.withColumn("__tied", ties).withColumn("__key0", F.when(F.col("__tied").isNotNull(), key))
    keyed = materialize(tied.filter(F.col("__tied").isNotNull()).select(F.col("__tied").alias("stratum"), F.col("__key0").alias("key")))
    labelled = assign_segments(
        tied,
        F.coalesce("__key0", F.lit("")),
        F.coalesce("__tied", F.lit("untied")),
        lambda sizes: {s: inside.get(s, []) for s in sizes},
        "__tie",
        keyed,
    )
    place = by_score + F.coalesce(F.col("__tie"), F.lit(0))
    return labelled.withColumn(out, place).drop("__score", "__tied", "__key0", "__tie")


def top_k(n: int, percent: int) -> int:
    """Rows in the top percent, at least one."""
    return max(1, n * percent // 100)


def decide_top_pct(
    df: DataFrame, p: str, percent: int, key: Column | None = None, out: str = "prediction"
) -> DataFrame:
    """Flags exactly max(1, n x percent / 100) highest scores; ties go by row key."""
    marked = top_segments(df, p, [percent], top_k, key, out)
    return marked.withColumn(out, (F.col(out) == 0).cast("int"))


def percentile_cutoff_value(df: DataFrame, p: str, percent: int, approximate: bool = False) -> float | None:
    """Linear-interpolated (100 - percent)-th percentile of the scores, missing ones and NaN left out; None without scores.

    With `approximate`, one pass gives a score whose rank is off by about 0.03 % of all scores at most.
    """
    column, q = F.col(p).cast("double"), Fraction(100 - percent, 100)
    return approximate_quantile(df, column, q) if approximate else exact_quantiles(df, {"p": column}, q)["p"]


def percentile_cutoff(df: DataFrame, p: str, percent: int, approximate: bool = False) -> DataFrame:
    cutoff = percentile_cutoff_value(df, p, percent, approximate)
    return df.sparkSession.createDataFrame([(percent, cutoff)], "top_pct int, cutoff double")


def reference_cutoff(
    reference: DataFrame, p: str, percent: int, n: int = REFERENCE_SAMPLE, key: Column | None = None
) -> float | None:
    """Cutoff of a fixed-size sample of the reference scores."""
    key = row_key(reference) if key is None else key
    return percentile_cutoff_value(draw_sample(reference, n, [p], key), p, percent)


def decide_reference_cutoff(
    df: DataFrame,
    p: str,
    reference: DataFrame,
    percent: int,
    n: int = REFERENCE_SAMPLE,
    key: Column | None = None,
    out: str = "prediction",
) -> DataFrame:
    cutoff = reference_cutoff(reference, p, percent, n, key)
    if cutoff is None:
        raise ValueError("no reference scores to take a cutoff from")
    return df.withColumn(out, decide_threshold(F.col(p), cutoff))


def top_x_report(
    df: DataFrame,
    y: str,
    p: str,
    percents: Sequence[int] = TOP_PERCENTS,
    key: Column | None = None,
) -> DataFrame:
    """Accuracy, precision, recall, F1 and coverage if the top X% are called claims."""
    percents = sorted(percents)
    slim = df.select(F.col(y).alias("y"), F.col(p).alias("p"), (row_key(df) if key is None else key).alias("key"))
    # Several passes read y, p and key, and none should score the rows again.
    slim = store(slim)
    ranked = top_segments(slim, "p", percents, lambda n, x: n * x // 100, F.col("key"), "segment")
    positive = (F.col("y") == 1).cast("long")
    parts = ranked.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.sum(positive).alias("pos"))
    # At most one row per percent plus one is left; each counts for every percent that reaches it.
    reach = F.explode(F.array(*[F.struct(F.lit(x).alias("pct"), F.lit(i).alias("i")) for i, x in enumerate(percents)]))
    c = F.col
    hit = c("segment") <= c("reach.i")

    def total(value: str, condition: Column) -> Column:
        return F.sum(F.when(condition, c(value)).otherwise(F.lit(0)))

    cells = (
        parts.withColumn("reach", reach)
        .groupBy(c("reach.pct").alias("top_pct"))
        .agg(
            total("n", hit).alias("k"),
            total("pos", hit).alias("tp"),
            F.sum("pos").alias("all_pos"),
            F.sum("n").alias("total"),
        )
    )
    tp, k, all_pos, n = c("tp"), c("k"), c("all_pos"), c("total")
    found = rates(tp, k - tp, all_pos - tp, n - k - all_pos + tp)
    return cells.select(
        "top_pct",
        "k",
        *[col.alias(name) for name, col in found.items()],
        F.try_divide(k.cast("double"), n).alias("coverage"),
    )


def threshold_baseline(df: DataFrame, y: str, p: str, threshold: float) -> DataFrame:
    """The fixed-threshold row a top-X% report is compared with."""
    c = F.col
    tp, fp, fn, tn = c("tp"), c("fp"), c("fn"), c("tn")
    return confusion_counts(df, y, p, threshold).select(
        *[col.alias(name) for name, col in rates(tp, fp, fn, tn).items()],
        F.lit(float(threshold)).alias("threshold"),
        (tp + fp).alias("n_positive"),
        (tp + fp + fn + tn).alias("n_total"),
    )
