from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loomtext.llm import queries, token_files

PATH = public_tokenizers.path("word_bpe_49k.json")

TEXTS = [
    "Hello, World! it's THE end's",
    "",
    None,
    "a<|endoftext|>b <|startoftext|>",
    "Ünïcödé Straße ΣΑΣ İstanbul été ﬁn ǅ ½²",
    "日本語 テキスト, emoji 🎉🎉 tab\tand hard spaces\x1cx\x85y",
    "x" * 5000 + " " + "word " * 3000,
    "123 4a5 'll'd ''s $%&/()=?",
    "\x00 nul ‍ joiner",
]


def expected(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def test_words_give_the_ids_of_whole_texts():
    encoder = token_files.WordEncoder(PATH, "<u2")
    for text, ids in zip(TEXTS, expected(TEXTS), strict=True):
        assert np.frombuffer(encoder.encode(text or ""), dtype="<u2").tolist() == ids[:-1]


@pytest.mark.parametrize("vocabulary", [49_408, 100_000])
def test_files_read_back_in_order(spark, vocabulary):
    rows = [(100 - i, t, "x") for i, t in enumerate(TEXTS)] + [(100, TEXTS[0], "again"), (None, "no id", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3)
    store = token_files.write_token_files(docs, PATH, 2, vocabulary)
    got = sorted(map(tuple, token_files.read_token_files(spark, store).collect()))
    texts = [t for _, t in sorted(((i, t) for i, t, _ in rows if i is not None), key=lambda x: x[0])]
    ids = expected(texts)
    starts = np.cumsum([0, *map(len, ids)])
    sums = [zlib.crc32(np.asarray(x, dtype="<u4").tobytes()) for x in ids]
    assert [r[1:] for r in got] == [(int(s), len(x), c) for s, x, c in zip(starts, ids, sums, strict=False)]
    stored = [
        d.tolist()
        for row in spark.read.parquet(f"{store}/manifest").orderBy("base").collect()
        for d in token_files.read_document(store, row.asDict())
    ]
    assert stored == ids


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    store = token_files.write_token_files(docs, PATH, 2, 49_408)
    assert token_files.read_token_files(spark, store).count() == 0


def test_query_against_the_library(spark, sf):
    got = {r.doc_id: r for r in queries.op10_token_files(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    start = 0
    for doc, ids in zip(docs, expected([d.text for d in docs]), strict=True):
        row = got[doc.doc_id]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())
        start += len(ids)


def test_rows_without_an_id_come_first(spark, tmp_path):
    named = [(7 * i + (1 << 60), f"text {i}") for i in range(40)] + [(0, None)]
    unnamed = [(None, f"no id {i % 30}") for i in range(50)] + [(None, None)]
    docs = spark.createDataFrame(named + unnamed, "doc_id long, text string").repartition(5)
    store = token_files.write_token_files(docs, PATH, 2, 49_408, unnamed=True)
    got = sorted(token_files.read_token_files(spark, store).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None] * len(unnamed) + sorted(i for i, _ in named)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    sums = [zlib.crc32(np.asarray(x, dtype="<u4").tobytes()) for x in expected([t for _, t in unnamed])]
    assert sorted(r.ids_crc32 for r in got[: len(unnamed)]) == sorted(sums)
    folder = f"{tmp_path}/sf"
    docs.write.parquet(f"{folder}/documents.parquet")
    assert queries.op10_token_files(spark, folder).count() == len(named) + len(unnamed)
