"""Rows that the n-gram join shuffles and pairs that it verifies."""

import random

import numpy as np

from riskloom.llm import similarity
from riskloom.llm.similarity import _buckets, jaccard_groups, prefix_length


def test_buckets_hold_pairs_whose_first_shared_shingle_allows_a_link(spark):
    random.seed(5)
    rows = []
    for node in range(700):
        n = random.choice([random.randrange(1, 60), 100])
        rows += [(random.randrange(40), node, n, at) for at in random.sample(range(prefix_length(n)), min(prefix_length(n), 3))]
    # The first two differ in size by less than a quarter, but what is left of the larger from there on is too little.
    rows += [(-1, 1000, 100, 0), (-1, 1001, 120, 30), (-2, 1000, 100, 0), (-2, 1001, 120, 5), (-3, 1000, 100, 20), (-3, 1001, 100, 20)]
    rows = list({(t, v): (t, v, n, at) for t, v, n, at in rows}.values())
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # runs go on over batches
    try:
        got = _buckets(spark.createDataFrame(rows, "token long, node long, n long, at int")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
    within = {}
    for r in got:
        within.setdefault(r.bucket, []).append(r.node)
    assert len(got) == len({(r.bucket, r.node) for r in got})
    met = {frozenset((a, b)) for nodes in within.values() for a in nodes for b in nodes}
    for i, (token, a, n, at) in enumerate(rows):
        for other, b, m, place in rows[:i]:
            # 100 * both >= 75 * (n + m - both), where both is at most what is left of either
            if token == other and 175 * min(n - at, m - place) >= 75 * (n + m):
                assert frozenset((a, b)) in met, (token, a, b)
    assert sum({1000, 1001} <= set(nodes) for nodes in within.values()) == 1


def test_a_family_is_joined_by_one_verified_pair_a_row(spark, monkeypatch):
    rng = np.random.default_rng(6)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(60):
        text = list(words)
        text[int(rng.integers(0, 400))] = f"x{i}"
        rows.append((i, " ".join(text)))
    rows += [(100 + i, " ".join(f"y{i}z{k}" for k in range(50))) for i in range(5)]
    counts, verified = [], similarity._verified

    def counted(pairs, *others):
        counts.append(pairs.count())
        return verified(pairs, *others)

    monkeypatch.setattr(similarity, "_verified", counted)
    got = jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: 0 if i < 60 else i for i, _ in rows}
    assert sum(counts) <= len(rows), counts
