"""Pieces of the given documents against a plain tokenization and cut."""

import os
import random
import sys
import zlib

import numpy as np
import pyarrow as pa

from riskloom.llm import packing
from riskloom.llm.packing import WordTokens, token_pieces, tokenizer_path


def test_pieces_are_those_of_plain_encoding(spark, folder):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    documents = documents.unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "a<|endoftext|>b"), (-4, "x1 " * 9000)], documents.schema))
    want = set()
    for row in documents.collect():
        ids = [*tokenizer.encode(row.text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[start : start + 4096], "<u4")
            want.add((row.doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    assert {tuple(r) for r in token_pieces(documents).collect()} == want


def test_parted_words_encode_like_whole_texts(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "KEPT_WORDS", 300)
    tokenizer, coder = Tokenizer.from_file(tokenizer_path()), WordTokens(tokenizer_path())
    random.seed(3)
    letters = [*"ab cDÉé̸́ß'’<|>.,!0129\n\t\x0b\x1c\x85  日本😀٣ſKİǅ", "'s", "'LL", "don't", "<|endoftext|>", "ﬁ", "Ω", "가", "ᄀ", "ᅡ"]
    texts = ["".join(random.choices(letters, k=random.randrange(30))) for _ in range(4000)] + ["", None]
    for low in range(0, len(texts), 500):
        part = texts[low : low + 500]
        flat, bounds = coder.ids(pa.array(part, pa.string()))
        for i, found in enumerate(tokenizer.encode_batch([t or "" for t in part], add_special_tokens=False)):
            assert flat[bounds[i] : bounds[i + 1]].tolist() == found.ids, part[i]
    assert coder.ids(pa.array([], pa.string()))[0].size == 0


def test_a_task_tokenizes_by_one_thread_and_gives_memory_back(spark, monkeypatch):
    """Takes the task's own function and runs it here."""
    tasks, released, threads, encoded = [], [], [], WordTokens._encoded
    documents = spark.createDataFrame([(1, "some words of a text")], "doc_id long, text string")
    with monkeypatch.context() as patch:
        patch.setattr(type(documents), "mapInArrow", lambda self, task, schema: tasks.append(task) or self)
        token_pieces(documents)
    monkeypatch.setattr(packing, "release_memory", lambda: released.append(True), raising=False)
    monkeypatch.setattr(WordTokens, "_encoded", lambda self, words: threads.append(os.environ["TOKENIZERS_PARALLELISM"]) or encoded(self, words))
    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "true")
    monkeypatch.setitem(vars(sys).setdefault("_word_tokens", {}), tokenizer_path(), None)
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["some words of a text"])], ["doc_id", "text"])
    assert sum(b.num_rows for b in tasks[0](iter([batch]))) == 1
    assert threads == ["false"] and released == [True]
