"""Ranked search, the record archive and fill-in-middle against brute force and exact round trips."""

import gzip
import hashlib
import math
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import retrieval
from riskloom.llm.archive import archived_pages, read_archive, rebuild_records, write_archive, write_warc_files
from riskloom.llm.frames import bounded_batches
from riskloom.llm.infilling import Exceptions, fill_in_middle, restore_texts, transform_digests
from riskloom.llm.retrieval import rank_documents
from riskloom.llm.text import text_bytes

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _ranked(documents, items, top=20):
    docs = [(i, Counter(_terms(t))) for i, t in documents]
    docs = [(i, c) for i, c in docs if c]
    total, length = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(w for _, c in docs for w in c)
    out = []
    for item, text in items:
        found = []
        for i, c in docs:
            m = 75 + 25 * sum(c.values()) * total // length
            score = 0
            for w, n in Counter(_terms(text)).items():
                weight = math.floor(1000 * math.log((2 * total + 2) / (2 * df[w] + 1)))
                score += n * weight * (10**9 * c[w] // (1000 * c[w] + 12 * m))
            if score > 0:
                found.append((-score, i is None, i))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(found[:top])]
    return sorted(out, key=str)


def _got(df):
    return sorted((tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in df.collect()), key=str)


@pytest.fixture
def corpus():
    random.seed(11)
    common, rare = [f"c{k}" for k in range(12)], [f"r{k}" for k in range(400)]
    rows = []
    for i in range(900):
        words = random.choices(common, k=random.randrange(40)) + random.choices(rare, k=random.randrange(8))
        rows.append((i, " ".join(words).upper() if i % 7 == 0 else "-".join(words)))
    rows += [(1000 + i, "copy c1 r1 Ünï r1") for i in range(300)]  # a third of all rows, all tied
    rows += [(2000, None), (2001, ""), (2002, "... !"), (2003, "c1 " * 20_000 + "r5"), (None, "c2 r7"), (7, "c2 r7"), (7, "c2 r7")]
    items = [(k, " ".join(random.choices(common, k=4) + random.choices(rare, k=4))) for k in range(25)]
    items += [(100, "copy"), (101, "c1 c1 c1 r1"), (102, None), (103, "unseen"), (104, "ÜNÏ Ünï"), (None, "r5"), (105, " ".join(rare))]
    return rows, items


@pytest.mark.parametrize("bounds", [{}, {"BLOCK_ROWS": 50, "SPAN": 8, "SPANS_AT_ONCE": 2}, {"LONG_SHARE": 0.0}, {"LONG_SHARE": 1.0}])
def test_ranks_are_those_of_brute_force(spark, corpus, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(retrieval, name, value)
    rows, items = corpus
    documents = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit(1), "ids": F.lit("x")})
    queries = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("y"))
    assert _got(rank_documents(documents.repartition(5), queries)) == _ranked(rows, items)


def test_queries_in_several_parts_rank_alike(spark, corpus):
    rows, items = corpus
    documents, queries = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert _got(rank_documents(documents, queries, query_terms=40)) == _ranked(rows, items)
    assert _got(rank_documents(documents, queries, top=3)) == _ranked(rows, items, 3)


def test_search_of_empty_tables(spark):
    documents, items = "doc_id long, text string", "item_id long, text string"
    some = spark.createDataFrame([(1, "a b")], documents)
    asked = spark.createDataFrame([(1, "a")], items)
    for left, right in ((some.limit(0), asked), (some, asked.limit(0)), (spark.createDataFrame([(1, None)], documents), asked)):
        found = rank_documents(left, right)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_two_queries_of_one_id_rank_each(spark):
    documents = spark.createDataFrame([(1, "a b"), (2, "b")], "doc_id long, text string")
    queries = spark.createDataFrame([(5, "a"), (5, "b")], "item_id long, text string")
    assert [r[:3] for r in _got(rank_documents(documents, queries))] == [(5, 1, 1), (5, 1, 2), (5, 2, 1)]


def test_search_gives_the_settings_back(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with pytest.raises(RuntimeError), bounded_batches(spark, rows=3):
        assert spark.conf.get(name) == "3"
        raise RuntimeError
    assert spark.conf.get(name) == before


PAGES = "page_id long, url string, html string, head string, address int"
LONG = "<p>" + "é\r\n" * 600
SOME_PAGES = [
    (1, "http://a/1", LONG, "x", 1),
    (9, "http://a/9", LONG, "x", 1),
    (4, "http://a/4\r\nWARC-Type: metadata", LONG, None, 2),
    (5, None, "short", None, None),
    (6, "http://b", "short", None, None),
    (7, "http://b", None, None, None),
    (8, "http://b", "", None, None),
    (None, "http://c", LONG, None, None),
    (10, "http://d", "x" * 999, None, None),
    (11, "http://d", "x" * 999, None, None),
    (12, "http://d", "y" * 1000, None, None),
    (13, "http://d", "y" * 1000, None, None),
    (14, "http://e", "WARC/1.1\r\nWARC-Type: revisit\r\n\r\n\r\n" * 2000, None, None),
    (15, "http://f", LONG + "z", "r", 3),
    (15, "http://f", LONG + "z", "r", 3),
]


def _described(rows):
    best = {}
    for page, _, html, *_ in rows:
        if len((html or "").encode()) >= 1000:
            best[html] = max(best.get(html, -1), -1 if page is None else page)
    out = []
    for page, _, html, *_ in rows:
        data, leader = (html or "").encode(), best.get(html)
        revisit = leader is not None and leader != page
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", leader if revisit else None))
    return out


def test_archive_reads_back_what_it_wrote(spark, tmp_path):
    pages = spark.createDataFrame(SOME_PAGES, PAGES)
    got = archived_pages(pages, str(tmp_path / "a")).collect()
    got = Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got)
    want = Counter(_described(SOME_PAGES))
    # Of two rows of one id, one is the response and the other revisits it.
    twin = next(x for x in want if x[0] == 15)
    want[twin] = 1
    want[(*twin[:3], "revisit", 15)] = 1
    assert got == want
    payloads = [r["payload"] for r in spark.read.parquet(str(tmp_path / "a/payloads")).collect()]
    assert len(payloads) == len(set(payloads)) == len({html or "" for _, _, html, *_ in SOME_PAGES})


def _parsed(data):
    """Records of WARC bytes by their lengths: (fields, block)."""
    out = []
    while data:
        head, _, data = data.partition(b"\r\n\r\n")
        version, *lines = head.split(b"\r\n")
        assert version == b"WARC/1.1"
        fields = dict(line.split(b": ", 1) for line in lines)
        assert len(fields) == len(lines)
        size = int(fields[b"Content-Length"])
        out.append((fields, data[:size]))
        assert data[size : size + 4] == b"\r\n\r\n"
        data = data[size + 4 :]
    return out


def test_records_are_rebuilt_as_warc_files(spark, tmp_path):
    path = str(tmp_path / "a")
    write_archive(spark.createDataFrame(SOME_PAGES, PAGES).repartition(4), path)
    write_warc_files(rebuild_records(spark, path), str(tmp_path / "files"))
    files = sorted(Path(tmp_path / "files").glob("part-*.gz"))
    records = [r for f in files for r in _parsed(gzip.decompress(f.read_bytes()))]
    assert len(records) == len(SOME_PAGES) and len({f[b"WARC-Record-ID"] for f, _ in records}) == len(records)
    bodies = {}
    for fields, block in records:
        http, _, body = block.partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", http)[1])
        if fields[b"WARC-Type"] == b"response":
            assert length == len(body) and fields[b"WARC-Payload-Digest"] == b"sha1:" + hashlib.sha1(body).hexdigest().encode()
            bodies[fields[b"WARC-Record-ID"]] = body
        else:
            assert body == b"" and b"WARC-Profile" in fields
    for fields, _ in records:
        if fields[b"WARC-Type"] == b"revisit":
            body = bodies[fields[b"WARC-Refers-To"]]
            assert fields[b"WARC-Payload-Digest"] == b"sha1:" + hashlib.sha1(body).hexdigest().encode()
    assert Counter(bodies.values())[b"short"] == 2


def test_a_changed_payload_is_not_read(spark, tmp_path):
    path = str(tmp_path / "a")
    write_archive(spark.createDataFrame(SOME_PAGES, PAGES), path)
    found = spark.read.parquet(f"{path}/payloads")
    found.withColumn("payload", F.concat("payload", F.lit(b"!"))).write.parquet(str(tmp_path / "b/payloads"))
    spark.read.parquet(f"{path}/heads").write.parquet(str(tmp_path / "b/heads"))
    with pytest.raises(Exception, match="does not match its address"):
        read_archive(spark, str(tmp_path / "b")).collect()


def test_archive_of_no_pages(spark, tmp_path):
    empty = spark.createDataFrame([], PAGES)
    assert archived_pages(empty, str(tmp_path / "a")).count() == 0
    assert rebuild_records(spark, str(tmp_path / "a")).count() == 0


def test_archive_of_one_hot_payload(spark, tmp_path):
    pages = spark.range(4000).selectExpr("id AS page_id", "'u' AS url", f"CASE WHEN id % 3 = 0 THEN repeat('h', 2000) ELSE repeat(id, 300) END AS html")
    got = archived_pages(pages, str(tmp_path / "a"))
    assert got.filter("record_type = 'revisit'").agg(F.count("*"), F.min("refers_to"), F.max("refers_to")).first()[:] == (1333, 3999, 3999)


ODD_TEXTS = ["", "a", "é", "日本語", "a😀b", "<P>x", "x<S>", "a<M>b", "<", "<P", "end <", "<<P", "\r\n\x00\t", "é" * 5000 + "a" * 70_000 + "😀" * 3000]


def _cut(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(text), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(text), "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return len(text), "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_texts_are_cut_as_by_brute_force_and_restored(spark):
    random.seed(13)
    letters = "ab <PSM>é日😀\n"
    texts = ODD_TEXTS + ["".join(random.choices(letters, k=random.randrange(60))) for _ in range(400)]
    rows = [*enumerate(texts), (3, None), (None, "null id"), (8, "twice"), (8, "twice")]
    documents = spark.createDataFrame([(*r, i, "f") for i, r in enumerate(rows)], "doc_id long, text string, n int, Form string")
    made = restore_texts(fill_in_middle(documents.repartition(3)))
    assert made.columns == ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output", "restored", "restored_prefix", "restored_middle"]
    got = made.collect()
    assert len(got) == len(rows) and {"plain", "psm", "spm"} == {r["form"] for r in got}
    for r in got:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == _cut(r["doc_id"], r["text"])
        assert r["restored"] == (r["text"] or "")
        assert (r["restored_prefix"], r["restored_middle"]) == (r["prefix_chars"], r["middle_chars"])
    digests = transform_digests(documents).collect()
    assert all(r["restored_sha256"] and len(r["output_sha256"]) == 64 for r in digests) and len(digests) == len(rows)


def test_broken_outputs_restore_to_null(spark):
    rows = [("psm", "<P>a<S>b"), ("spm", "<P>a<S>b<M>c"), ("psm", "a<S>b<M>c"), (None, "a"), ("odd", "a"), ("plain", None), ("psm", "<P><S><M>")]
    got = restore_texts(spark.createDataFrame(rows, "form string, output string")).collect()
    assert [r["restored"] for r in got] == [None] * 5 + ["", ""]


def test_no_texts_to_cut(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fill_in_middle(empty).count() == 0 and transform_digests(empty).count() == 0


def test_exception_index_converts_both_ways():
    import pyarrow as pa

    texts = ODD_TEXTS + ["plain ascii" * 50]
    data, _ = text_bytes(pa.array(texts))
    whole = "".join(texts)
    index = Exceptions(data)
    assert len(index.byte) == sum(ord(c) > 127 for c in whole)
    points = np.arange(len(whole) + 1)
    at = index.to_bytes(points)
    widths = np.array([len(c.encode()) for c in whole])
    assert (at == np.concatenate([[0], np.cumsum(widths)])).all() and (index.to_points(at) == points).all()
