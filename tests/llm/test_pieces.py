from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from loomtext.llm import pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = "  ▁▁abtheinr\nénö日🎉.,0s\t\x00"


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def random_texts(n, longest=60):
    pick = random.Random(7)
    return ["".join(pick.choice(LETTERS) for _ in range(pick.randint(0, longest))) for _ in range(n)]


def test_ids_are_the_librarys(model, library):
    for text in random_texts(3000):
        assert np.frombuffer(model.encode(text), dtype="<i4").tolist() == library.encode(text)


def test_pairs_fit_as_merging_says(model):
    pick = random.Random(3)
    vocabulary = [p for p in model.ids if len(p) < 6]
    for _ in range(20_000):
        a, b = pick.choice(vocabulary), pick.choice(vocabulary)
        if model.merged(a) == [a]:
            assert model.pair_fits(a, b) == (model.merged(a + b) == [a, b]), (a, b)


def test_a_text_in_parts_gives_the_ids_of_the_whole(model, library):
    pick = random.Random(5)
    for text in [*random_texts(200, 400), "therein" * 3000]:
        whole = "▁" + text.replace(" ", "▁")
        stream, out, at, widest = pieces.PieceStream(model), [], 0, 0
        while at < len(whole):
            step = pick.randint(1, 300)
            out += stream.feed(whole[at : at + step])
            widest = max(widest, len(stream.window))
            at += step
        out += stream.finish()
        assert [i for p in out for i in model.piece_ids(p)] == (library.encode(text) if text else [library.piece_to_id("▁")])
        assert widest < 1000


def test_round_trip(model, library):
    for text in random_texts(1000):
        ids = np.frombuffer(model.encode(text), dtype="<i4").tolist()
        assert model.decode(ids) == text.replace("▁", " ") == library.decode(ids)


def test_any_ids_decode(model):
    assert model.decode([0]) == " ⁇ "[1:]
    assert model.decode([1, 2]) == ""
    assert model.decode([3 + 0xC3, 3 + 0x0A]) == "�\n"


def test_odd_rows(spark):
    rows = [(1, None, "x"), (None, "abc", "y"), (2, "", "z"), (3, "a" * 100_000, ""), (3, "a" * 100_000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    back = pieces.decode_pieces(pieces.encode_pieces(docs, PATH), PATH).collect()
    assert sorted(((r.doc_id or -1, r.text) for r in back)) == sorted((i or -1, t or "") for i, t, _ in rows)
    assert pieces.encode_pieces(docs.limit(0), PATH).count() == 0


def test_query_against_the_library(spark, sf, library):
    import hashlib

    got = {r.doc_id: r for r in queries.op4_sentencepiece(spark, sf).collect()}
    for doc in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids, r = library.encode(doc.text or ""), got[doc.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.text_sha256 == hashlib.sha256((doc.text or "").encode()).hexdigest()
