from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomtext.functions.constants import CHUNK_SEPARATORS
from loomtext.operators import chunking as K

SOME = settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck))
TEXTS = st.text(alphabet="ab é.\n", max_size=120)


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@SOME
@given(st.lists(TEXTS, min_size=1, max_size=5), st.integers(2, 30), st.data())
def test_native_windows_equal_plain_windows(spark, texts, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    got = K.chunk_text(docs(spark, texts), size=size, overlap=overlap, separators=[""]).collect()
    for i, text in enumerate(texts):
        mine = [r["text"] for r in sorted(got, key=lambda r: r["chunk_no"]) if r["doc_id"] == i]
        want, start = [], 0
        while text:
            want.append(text[start : start + size].strip())
            if start + size >= len(text):
                break
            start += size - overlap
        assert mine == [w for w in want if w]


def visible(text):
    return "".join(text.split())


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(2, 40), st.data())
def test_recursive_chunks_stay_in_bounds_and_lose_nothing(text, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    chunks = K.split_recursive(text, size, overlap, CHUNK_SEPARATORS)
    assert all(0 < len(c) <= size and c == c.strip() and c in text for c in chunks)
    assert visible(text).startswith(visible(chunks[0]) if chunks else "")
    assert visible(text).endswith(visible(chunks[-1]) if chunks else "")
    plain = K.split_recursive(text, size, 0, CHUNK_SEPARATORS)
    assert visible("".join(plain)) == visible(text)


def test_separator_preference():
    text = "One two three.\n\nFour five six. Seven eight nine ten.\n\nEnd."
    assert K.split_recursive(text, 20, 0, CHUNK_SEPARATORS) == [
        "One two three.", "Four five six", ". Seven eight nine", "ten.", "End.",
    ]


def test_overlap_carries_whole_pieces():
    # A piece keeps the blank before it, so " dd" is 3 long and " cc dd ee" would be 9.
    assert K.split_recursive("aa bb cc dd ee", 8, 3, [" ", ""]) == ["aa bb cc", "cc dd", "dd ee"]
    assert K.split_recursive("abcdefghij", 4, 1, [""]) == ["abcd", "defg", "ghij"]
    assert K.split_recursive("a\n\n\nb" * 2, 3, 0, ["\n\n", ""]) == ["a", "ba", "b"]


def test_settings_are_checked(spark):
    for size, overlap in ((10, 10), (0, 0), (5, -1)):
        with pytest.raises(ValueError):
            K.chunk_text(docs(spark, ["x"]), size=size, overlap=overlap)


def test_empty_texts_have_no_chunks(spark):
    for separators in ([""], CHUNK_SEPARATORS):
        got = K.chunk_text(docs(spark, ["", None, "  \n ", "x"]), separators=separators).collect()
        assert [(r["doc_id"], r["chunk_no"], r["text"]) for r in got] == [(3, 1, "x")]


def test_metadata_and_audit(spark):
    text = "Rules of the quiet hours. " * 60
    chunks = K.chunk_metadata(K.chunk_text(docs(spark, [text])))
    rows = chunks.orderBy("chunk_no").collect()
    assert rows[0]["chunk_id"] == "CHUNK-01" and rows[0]["source_id"] == "0:CHUNK-01"
    assert all(r["char_length"] == len(r["text"]) for r in rows)
    assert all(r["token_estimate"] == len(r["text"].split()) for r in rows)
    audit = K.chunk_audit(chunks, chunks, 400, at_least=3).first()
    assert audit["has_enough"] and audit["is_in_sync"]
    assert (audit["n_empty"], audit["n_too_long"], audit["n_without_id"]) == (0, 0, 0)


def test_long_ids_outgrow_the_padding(spark):
    chunks = K.chunk_metadata(K.chunk_text(docs(spark, ["x" * 500]), size=4, overlap=0, separators=[""]))
    last = chunks.orderBy(F.desc("chunk_no")).first()
    assert last["chunk_id"] == "CHUNK-125"


def test_sweep_equals_single_runs(spark):
    corpus = docs(spark, ["lorem ipsum dolor. " * 100, "short", ""])
    swept = {r["chunk_size"]: r["n_chunks"] for r in K.chunk_size_sweep(corpus).collect()}
    for size in (100, 400, 1200):
        single = K.chunk_text(corpus, size=size, overlap=int(size * 0.2)).count()
        assert swept[size] == single


def test_recursive_chunks_hold_a_slice_of_a_batch(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(K, "SLICE_BYTES", 10)
    texts = pa.array(["aaaa", None, "bbbb", "c" * 50, "", "dd"])
    assert list(K._slices(texts)) == [(0, 3), (3, 1), (4, 2)]
    assert list(K._slices(texts.slice(2))) == [(0, 1), (1, 1), (2, 2)]


def test_recursive_chunks_of_long_batches(spark):
    texts = [(i, f"{i} " + "word " * (i * 37 % 900)) for i in range(700)] + [(None, "x. y"), (7, None)]
    df = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    expected = sorted(
        (-1 if d is None else d, n, c)
        for d, t in texts
        for n, c in enumerate(K.split_recursive(t, 400, 80, K.CHUNK_SEPARATORS) if t else [], 1)
    )
    found = K.chunk_text(df)
    assert found.schema["chunk_no"].dataType.simpleString() == "int"
    assert sorted((d if d is not None else -1, n, c) for d, n, c in map(tuple, found.collect())) == expected
