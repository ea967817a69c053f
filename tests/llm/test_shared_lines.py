"""Line dedup of documents: what goes is shared and no one's content; no text is lost."""

import pytest
from pyspark.sql import functions as F

from riskloom.llm.boilerplate import drop_shared_lines
from riskloom.llm.similarity import keep_one_of_each_group

SCHEMA = "doc_id long, text string, source string, row string, lines int, Code int"


def _cut(spark, rows):
    docs = spark.createDataFrame([(i, t, s, "r", 1, 2) for i, (t, s) in enumerate(rows)], SCHEMA).repartition(3)
    out = drop_shared_lines(docs, "source", "text")
    assert out.columns == ["doc_id", "text", "source", "row", "Code", "lines", "dropped_lines"]
    return {r["doc_id"]: r for r in out.collect()}


def _own(i):
    return "\n".join(f"line {k} of text {i} and no other text has it" for k in range(6))


def test_copies_keep_their_text(spark):
    """Five copies, exact ones and near ones, in 300 rows of a source: none is emptied, one of each stays in the end."""
    near = [_own(1000).replace("line 3", f"line 3{k}") for k in range(5)]
    rows = [(_own(i), "s") for i in range(290)] + [(_own(999), "s")] * 5 + [(t, "s") for t in near]
    got = _cut(spark, rows)
    assert all(r["text"] == rows[i][0] and r["dropped_lines"] == 0 for i, r in got.items())
    docs = spark.createDataFrame([(i, r["text"], "s") for i, r in got.items()], "doc_id long, text string, source string")
    kept = {r["doc_id"] for r in keep_one_of_each_group(docs.filter("doc_id >= 280")).collect()}
    assert kept >= set(range(280, 290)) | {290} and len(kept & {295, 296, 297, 298, 299}) >= 1


def test_programs_and_rights_keep_their_lines(spark):
    code = [f"import os\ndef f{i}(x):\n    y = x + {i}\n    return x" for i in range(40)]
    words = [f"{_own(i)}\nLicensed under CC BY-NC 4.0.\nAll rights reserved." for i in range(40)]
    middle = [f"{_own(i)}\nso it is\n{_own(i + 100)}" for i in range(40)]
    rows = [(t, s) for s, of in (("code", code), ("rights", words), ("middle", middle)) for t in of]
    assert all(r["text"] == rows[i][0] for i, r in _cut(spark, rows).items())


def test_banners_and_long_lines_go(spark):
    banner, long = "Read more here", "a line of more than eight words that many texts have in common"
    rows = [(f"{banner}\n{_own(i)}" if i % 20 == 0 else f"{_own(i)}\n  {long} \n{_own(i + 5000)}" if i % 20 == 1 else _own(i), "s") for i in range(300)]
    rows += [(f"{banner}\n{_own(i)}", "two") for i in range(2)] + [(f"{banner}\n{_own(i)}", None) for i in range(9)]
    got = _cut(spark, rows)
    assert all(banner not in got[i]["text"] and long not in got[i]["text"] for i in range(300))
    assert got[20]["dropped_lines"] == 1 and got[20]["lines"] == 7 and got[21]["text"] == f"{_own(21)}\n{_own(5021)}"
    assert all(got[i]["text"] == rows[i][0] for i in range(300, 311))


def test_odd_rows(spark):
    texts = [None, "", " \n\n ", "one", "one", "one", "one\ntwo", "x" * 100_000, "a\r\nb"]
    rows = [(t, "s") for t in texts]
    got = _cut(spark, rows)
    assert [got[i]["text"] for i in range(len(rows))] == texts
    assert got[0]["lines"] == 0 and drop_shared_lines(spark.createDataFrame([], SCHEMA), "source", "text").count() == 0


@pytest.mark.parametrize("name", ["gone", "gone_key", "again", "id", "key", "row", "component"])
def test_group_stage_keeps_columns_of_any_name(spark, name):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, None), (2, "x y z u v w"), (1, "a b c d e f")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], f"doc_id long, text string, `{name}` int")
    out = keep_one_of_each_group(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"], r["text"] or "") for r in out.collect()) == [(1, "a b c d e f"), (2, "x y z u v w"), (3, "")]
    assert out.filter(F.col(name) == 3).count() == 1
