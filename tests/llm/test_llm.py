"""Operators of riskloom.llm against SQL, brute force, exact properties and held-out rows."""

import math
import random
import textwrap
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from riskloom.llm import compression
from riskloom.llm.boilerplate import drop_site_boilerplate
from riskloom.llm.catalog import ORACLES, QUERIES
from riskloom.llm.components import components
from riskloom.llm.compression import score_texts
from riskloom.llm.decontamination import drop_contaminated, find_contaminated
from riskloom.llm.embeddings import near_duplicate_vectors
from riskloom.llm.licenses import scan_licenses
from riskloom.llm.packing import Lengths, WordTokens, pack_documents, plan_packing, tokenizer_path
from riskloom.llm.quality import score_quality, train_quality
from riskloom.llm.sharding import shuffle_into_shards
from riskloom.llm.similarity import bitmap, jaccard_groups, keep_one_of_each_group, tree_join
from riskloom.llm.toxicity import drop_toxic, score_toxicity, train_toxicity

DOCUMENTS = "doc_id long, text string, row string, size int"
ODD = [
    (1, None, "a", 1),
    (2, "", "a", 1),
    (3, " \n\t", "a", 1),
    (4, "word", "a", 1),
    (5, "one two three four five six", "a", 1),
    (5, "one two three four five six", "a", 1),
    (6, "ONE two three\nfour  five six", None, 2),
    (None, "one two three four five six", "x", None),
    (7, "long " * 30_000, "z", 9),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, DOCUMENTS)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, folder, name):
    assert differences(QUERIES[name](spark, folder), connect(folder), ORACLES[name]) is None


def test_components_of_random_graphs(spark):
    random.seed(3)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 440)]
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for u, v in edges:
        a, b = sorted((root(u), root(v)))
        parent[b] = a
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: root(n) for e in edges if e[0] != e[1] for n in e} | {n: root(n) for n in got}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_contamination_of_odd_rows(spark, odd, empty):
    items = spark.createDataFrame(
        [(1, "one two three four five six"), (2, "four FIVE"), (3, None), (4, ""), (5, "none of these words is there")],
        "item_id int, text string",
    )
    found = sorted((r[0] or 0, r[1]) for r in find_contaminated(odd, items).collect())
    assert found == [(0, 1), (0, 2), (5, 1), (5, 1), (5, 2), (5, 2), (6, 1), (6, 2)]
    parts = sorted((r[0] or 0, r[1]) for r in find_contaminated(odd, items, item_shingles=1).collect())
    assert parts == found
    kept = drop_contaminated(odd, items)
    assert kept.columns == odd.columns and sorted(r[0] for r in kept.collect()) == [1, 2, 3, 4, 7]
    assert find_contaminated(empty, items).count() == 0 and find_contaminated(odd, items.limit(0)).count() == 0


def test_vectors_of_odd_rows(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [0.0, 0.0], 1), (5, None, 1)]
    rows += [(6, [float("nan"), 1.0], 1), (7, [1.0, 0.0], None), (8, [1.0, 0.0, 0.0], 1), (9, [None, 1.0], 1), (10, [1.0, 0.3], 1), (11, [], 1)]
    got = sorted(tuple(r) for r in near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect())
    linked = {1: (3, 1), 2: (3, 1), 10: (3, 1)}
    assert got == sorted((i, *linked.get(i, (0, i)), linked.get(i, (0, i))[1] == i) for i, _, _ in rows)


def test_vectors_across_blocks(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(12, 16))
    rows = [(i, (centre[i % 12] + 0.15 * rng.normal(size=16)).astype("f4").tolist(), i % 2) for i in range(700)]
    unit = np.array([r[1] for r in rows], float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = (unit @ unit.T >= 0.93) & (np.arange(700)[:, None] % 2 == np.arange(700) % 2)
    got = near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), block_rows=40).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == {i: int(near[i].sum()) - 1 for i in range(700)}


def test_groups_of_odd_rows(odd, empty):
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_groups(odd).collect())
    assert got == Counter([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 2, 5), (5, 2, 5), (6, 2, 5), (None, 2, None), (7, 1, 7)])
    assert jaccard_groups(empty).count() == 0
    kept = keep_one_of_each_group(odd)
    assert kept.columns == odd.columns
    assert sorted(r[0] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7]


def test_an_id_on_rows_with_different_texts(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(12)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (3, b), (4, c), (4, c), (4, "other words"), (4, None), (4, None), (4, ""), (None, a)]
    got = keep_one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(tuple(r) for r in got) == Counter([(1, a), (2, b), (4, c), (4, "other words"), (4, None), (4, None), (4, ""), (None, a)])


def test_groups_of_chains_and_families(spark):
    random.seed(5)
    words = [f"w{k}" for k in range(4000)]
    texts = []
    for family in range(6):
        base = [random.choice(words) for _ in range(120)]
        for _ in range(25):
            base = list(base)
            base[random.randrange(len(base))] = random.choice(words)
            texts.append(" ".join(base))
    shared = " ".join(random.choice(words) for _ in range(60))
    texts += [shared + " " + " ".join(random.choice(words) for _ in range(random.randrange(5, 90))) for _ in range(60)]
    rows = list(enumerate(texts))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    label = list(range(len(sets)))
    changed = True
    while changed:
        changed = False
        for i in range(len(sets)):
            for j in range(i):
                if label[i] != label[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    got = jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(label))


def test_tree_join_loses_no_link():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[: rng.integers(20, 400)], rng.integers(0, 2**63, rng.integers(1, 60), dtype=np.uint64)])) for _ in range(300)]
    sets.sort(key=len)
    found = {(i, j) for i, j, _ in tree_join(np.array([len(s) for s in sets]), np.arange(300), [bitmap(s) for s in sets])}
    for i in range(300):
        for j in range(i + 1, 300):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                assert (i, j) in found


def _ppm(train, order):
    seen = defaultdict(Counter)
    for text in train:
        line = b"\xff" * order + text
        for at in range(order, len(line)):
            for k in range(order + 1):
                seen[line[at - k : at]][line[at]] += 1

    def cost(text):
        line, total = b"\xff" * order + text, 0.0
        for at in range(order, len(line)):
            gone = set()
            for k in range(order, -1, -1):
                found = {s: n for s, n in seen[line[at - k : at]].items() if s not in gone}
                if not found:
                    continue
                n, q = sum(found.values()), len(found)
                if line[at] in found:
                    total += math.log10(found[line[at]] / (n + q))
                    break
                total += math.log10(q / (n + q))
                gone |= set(found)
            else:
                total -= math.log10(256 - len(gone))
        return total

    return cost


@pytest.mark.parametrize("lookups", [{}, {"lookup_grams": 5, "lookup_words": 3}])
def test_scores_are_those_of_brute_force(spark, lookups):
    import zlib

    random.seed(4)
    rows = [(i, " ".join(random.choice(["Ab", "abc", "é", "x1", "longer", "w" * 9]) for _ in range(random.randrange(12)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "new Ünseen"), (62, "new Ünseen"), (None, "abc")]
    held = {i: zlib.crc32(str("" if i is None else i).encode()) % 5 == 1 for i, _ in rows}
    plain = lambda t: bytes(b + 32 if 65 <= b <= 90 else b for b in " ".join((t or "").split()).encode()) + b"\xff"
    tokens = lambda t: [*plain(t)[:-1].split(), b""]
    count = Counter(w for i, t in rows if not held[i] for w in tokens(t))
    total, cost = sum(count.values()), _ppm([plain(t) for i, t in rows if not held[i]], 3)
    got = score_texts(spark.createDataFrame(rows, "doc_id long, text string"), order=3, **lookups).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        t = texts[r["doc_id"]]
        assert r["held_out"] == held[r["doc_id"]] and r["train_tokens"] == total and r["n_tokens"] == len(tokens(t))
        assert r["n_known"] == sum(count[w] > 0 for w in tokens(t))
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 0.5) / (total + 0.5 * (len(count) + 1))) for w in tokens(t)))
        assert r["score"] == pytest.approx(cost(plain(t)))


def test_scores_without_rows(empty):
    assert score_texts(empty).count() == 0


def test_license_rules(spark):
    rows = [
        (1, "Released under the MIT License."),
        (2, "He said it was released under the MIT License. Not so!"),
        (3, "Licensed under the Apache License, Version 2.0.\nAll rights reserved."),
        (4, None),
        (5, ""),
    ]
    got = {r["doc_id"]: (r["sentence_ids"], r["licenses"]) for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {
        1: (["mit-grant"], ["MIT"]), 2: ([], []), 3: (["apache-2.0-grant", "all-rights-reserved"], ["Apache-2.0", "Proprietary"]), 4: ([], []), 5: ([], []),
    }


MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
GPL = """This program is free software{0} you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation{1} either version {2} of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
"""
GPL_2, GPL_3 = GPL.format(";", ";", 2), GPL.format(":", ",", 3)


def _licenses(spark, texts):
    rows = scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [r["licenses"] for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_licenses_of_full_public_texts(spark):
    texts = [MIT, GPL_2, GPL_3, GPL.format(";", ",", 2), GPL.format(":", ";", 3), GPL_3.replace("General", "Lesser General")]
    assert _licenses(spark, texts) == [["MIT"], ["GPL-2.0-or-later"], ["GPL-3.0-or-later"], ["GPL-2.0-or-later"], ["GPL-3.0-or-later"], []]


BSD = """Copyright (c) 2020, Some One
All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_3 = BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""


def _wrapped(text, width, mark="", end="\n"):
    lines = [x for line in text.split("\n") for x in (textwrap.wrap(line, width) or [""])]
    return end.join(mark + line for line in lines)


@pytest.mark.parametrize("mark, end", [("", "\n"), ("# ", "\n"), (" * ", "\r\n"), ("// ", "\n"), (";; ", "\n"), ("-- ", "\n"), ("! ", "\n"), ("rem ", "\n"), ("> ", "\n")])
def test_licenses_of_wrapped_texts(spark, mark, end):
    texts = [MIT, GPL_2, GPL_3, BSD, BSD_3, BSD_3.replace("1. ", "(a) ").replace("2. ", "b) ").replace("3. ", "- "), APACHE]
    names = [["MIT"], ["GPL-2.0-or-later"], ["GPL-3.0-or-later"], ["BSD-2-Clause", "Proprietary"], ["BSD-3-Clause", "Proprietary"], ["BSD-3-Clause", "Proprietary"], ["Apache-2.0"]]
    for width in (40, 72, 80):
        assert _licenses(spark, [_wrapped(t, width, mark, end) for t in texts]) == names


def test_wrapped_lines_around_a_notice(spark):
    permission = MIT.split("\n\n", 2)[2]
    texts = [
        "Copyright (c) 2020 Some One\n" + _wrapped(permission, 70),
        "Some project\n\nThis project is licensed under\nthe MIT License\n\nMore",
        "He said it was\nreleased under\nthe MIT License\nlast year.",
        "- Licensed under the\n- MIT License",
        "a line\nReleased under the MIT License\nanother",
        _wrapped(MIT, 70).replace("included in all", "left out of all"),
    ]
    assert _licenses(spark, texts) == [["MIT"], ["MIT"], [], [], ["MIT"], []]


def test_licenses_beside_long_runs(spark):
    runs = ["#" * 200_000, "\n" * 200_000, "* " * 100_000, ". " * 100_000, "- \n" * 50_000, " " * 200_000]
    texts = [f"{run}\n\n{_wrapped(MIT, 70)}\n{run}" for run in runs]
    assert _licenses(spark, texts) == [["MIT"]] * len(runs)


def _check_packing(rows, n_rows, most):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= most
    assert sum(r["piece"] == 0 for r in rows) == n_rows
    return len(by)


def test_packing(spark, folder, odd, empty):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    rows = pack_documents(documents).collect()
    used = _check_packing(rows, documents.count(), 4096)
    tokens = sum(r["length"] for r in rows)
    assert used <= math.ceil(tokens / 4096) + 1
    rows = pack_documents(odd, most=100).collect()
    _check_packing(rows, len(ODD), 100)
    assert {r["length"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert pack_documents(empty).count() == 0


def test_packing_plan_uses_all_pieces():
    random.seed(6)
    counts = {random.randrange(1, 101): random.randrange(1, 50) for _ in range(60)}
    plan = plan_packing(counts, 100)
    used = Counter()
    for pattern, copies in plan:
        assert sum(pattern) <= 100 and copies > 0
        for length in pattern:
            used[length] += copies
    assert used == Counter(counts)


def test_no_exact_complement_is_skipped():
    # Eight first lengths find a pair only by using a length twice that is left once.
    once = [3**k for k in range(8)]
    counts = {k: 1 for k in [*once, *(20_000 - 2 * k for k in once), 6_999, 6_600, 6_401]}
    assert Lengths(counts, 20_000).complement(20_000, []) == [6_999, 6_600, 6_401]


def test_word_tokens_are_those_of_whole_texts():
    texts = ["It's DON'T x\x1cy", "İX ΑΣ ΟΔΟΣ.", "é \xa0 x", "a<|endoftext|>b", "", "1,234.5%%% $$$", "été ﬁn 中文", "x_y__z_ thon''"]
    coder = WordTokens(tokenizer_path())
    whole = coder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.batch(texts)] == [w.ids for w in whole]


def test_boilerplate(spark):
    rows = [(i, "h" if i < 30 else None, f"top\nown {i}\n same  \n\nown {i}", "kept") for i in range(40)] + [(99, "h", None, "x"), (98, "small", "top\na", "y")]
    out = drop_site_boilerplate(spark.createDataFrame(rows, "page_id long, host string, text string, line string"), "host", "text")
    got = {r["page_id"]: r for r in out.collect()}
    assert out.columns == ["page_id", "host", "text", "line", "lines", "dropped_lines"]
    assert got[0]["text"] == "own 0\n\nown 0" and got[0]["dropped_lines"] == 2 and got[0]["line"] == "kept"
    assert got[35]["text"] == rows[35][2] and got[99]["text"] is None and got[98]["text"] == "top\na"
    assert drop_site_boilerplate(spark.createDataFrame([], "host string, text string"), "host", "text").count() == 0


def _pipeline_cut(spark, rows):
    import corpus_pipeline

    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    return {r["doc_id"]: r for r in corpus_pipeline.without_boilerplate(spark, docs, "").collect()}


def test_shared_lines_of_a_large_source_go(spark):
    banner, passage = "a banner", "passage " * 60 + "end"
    texts = [f"own {i}" + f"\n{banner}" * (i % 40 == 0) + f"\n{passage}" * (i % 60 == 1) + "\ntwice" * (i < 2) for i in range(3000)]
    got = _pipeline_cut(spark, [(i, t, "big" if i < 2900 else "rest", len(t)) for i, t in enumerate(texts)])
    assert all(banner not in r["text"] and passage not in r["text"] for r in got.values() if r["source"] == "big")
    assert got[0]["text"] == "own 0\ntwice" and got[0]["n_chars"] == len("own 0\ntwice") and got[2]["text"] == "own 2"


def test_small_sources_lose_shared_lines_too(spark):
    rows = [(i, f"own {i}\ntop", "five" if i < 5 else "two", 10) for i in range(7)]
    got = _pipeline_cut(spark, rows)
    assert {i: r["text"] for i, r in got.items()} == {i: f"own {i}" if i < 5 else f"own {i}\ntop" for i in range(7)}


def test_shards(spark, folder, odd, empty):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    first, again = (sorted((r["doc_id"], r["shard"], r["slot"]) for r in shuffle_into_shards(documents).collect()) for _ in range(2))
    assert first == again and len(first) == documents.count()
    sizes = Counter(s for _, s, _ in first)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(40))
    assert {(s, k) for _, s, k in first} == {(s, k) for s, n in sizes.items() for k in range(n)}
    rows = shuffle_into_shards(odd, shards=4)
    assert sorted(Counter(r["shard"] for r in rows.collect()).values()) == [2, 2, 2, 3]
    assert set(rows.columns) == {"doc_id", "text", "row", "size", "shard", "slot"}
    assert shuffle_into_shards(empty).count() == 0


@pytest.mark.parametrize("label, train, score, least", [("toxic", train_toxicity, score_toxicity, 0.95), ("quality", train_quality, score_quality, 0.95)])
def test_classifiers_on_held_out_rows(spark, label, train, score, least):
    folder = "/root/testdata/sf0.1"
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = score(documents, train(documents, labels))
    rows = scored.join(labels, "doc_id").filter("held_out").select(label, "predicted").collect()
    assert sum(r[0] == r[1] for r in rows) >= least * len(rows)
    clean = [r[1] for r in rows if r[0] == (label == "quality")]
    assert sum(p == (label == "quality") for p in clean) >= 0.95 * len(clean)


def test_classifiers_on_odd_rows(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(4, 1, 1), (5, 0, 0), (7, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, some):
        for train, score in ((train_toxicity, score_toxicity), (train_quality, score_quality)):
            rows = score(odd, train(odd, labels)).collect()
            assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
            assert score(empty, train(empty, labels)).count() == 0
    assert drop_toxic(odd, train_toxicity(odd, none)).columns == odd.columns


def test_pipeline_stages(spark, folder):
    import corpus_pipeline
    from riskloom.llm.frames import stored

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, folder), "stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            assert 0 < out.count() <= docs.count()
            docs = out
    assert out.filter("piece = 0").count() == docs.count()
    groups = jaccard_groups(docs)
    assert groups.filter("n_shingles > 0 AND doc_id <> component_id").isEmpty()
    assert find_contaminated(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).isEmpty()
    assert corpus_pipeline.run(spark, folder).agg(F.count("*")).first()[0] == out.count()


def test_commonest_counts_are_taken_without_an_order(spark):
    counts = spark.range(20_000).select(F.col("id").alias("key"), F.when(F.col("id") < 300, 1000 - F.col("id")).otherwise(1 + F.col("id") % 2).alias("n"))
    assert compression.commonest(counts, 20_000).count() == 20_000 and compression.commonest(counts, 0).count() == 0
    some = compression.commonest(counts, 5_000)
    assert abs(some.count() - 5_000) < 300 and some.filter("n > 2").count() == 300 and some.filter("n = 1").isEmpty()


def test_lookups_of_scoring_are_not_ordered_in_the_driver(spark, monkeypatch):
    """A limit after an order brings so many rows of each task to the driver, as objects."""
    plans, slots = [], compression._slots
    monkeypatch.setattr(compression, "_slots", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or slots(df))
    rows = [(i, f"w{i % 7} and w{i % 5} of w{i}") for i in range(60)]
    scored = score_texts(spark.createDataFrame(rows, "doc_id long, text string"), lookup_grams=20, lookup_words=4)
    assert scored.count() == 60 and len(plans) == 2
    assert not any("Limit" in plan or "TakeOrdered" in plan for plan in plans)


def test_the_lookup_of_scoring_is_small(spark):
    """The driver holds it three times over while it is sent; before, it took 128 MB."""
    rows = spark.range(1_000).select("id", (F.col("id") / 2).alias("cost"))
    bits, keys, values = compression._slots(rows)
    assert keys.nbytes + values.nbytes == 16 << bits and 16 << (2 * compression.LOOKUP_GRAMS).bit_length() <= 64 << 20
    assert compression.Table.of((bits, keys, values))(np.array([7, 999, 1_000], np.uint64)).tolist()[:2] == [3.5, 499.5]
