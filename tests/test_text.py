from __future__ import annotations

import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomtext.functions import text as X
from loomtext.functions.constants import ENGLISH_STOPWORDS


@pytest.fixture
def value(spark):
    def run(expression, text):
        df = spark.createDataFrame([(text,)], "t string")
        return df.select(expression(F.col("t")).alias("x")).first()["x"]

    return run


def test_tokens_keep_single_characters_and_drop_stopwords(value):
    question = "What is the fee for 2026 bursar wire deposits for F-1 visa students??!"
    tokens = value(X.tokenize_and_clean, question)
    assert tokens == ["fee", "2026", "bursar", "wire", "deposits", "f", "1", "visa", "students"]
    assert all(not re.search(r"[^\w\s]", t) for t in tokens)
    closed = value(X.tokenize_and_clean, "The university is closed for winter break!")
    assert closed == ["university", "closed", "winter", "break"]


def test_clean_turns_accents_into_spaces(value):
    assert value(X.clean_text, "Café N°5\tÉté") == "caf  n 5\t t "


def test_null_and_blank_texts(value):
    assert value(X.tokenize_and_clean, None) == []
    assert value(X.tokenize_and_clean, " \n ") == []
    assert value(X.word_count, " \n ") == 0


def test_fused_words_are_cut(value):
    assert value(X.tokenize, "I cannot, gonna GIMME cannots") == [
        "i", "can", "not", "gon", "na", "gim", "me", "cannots",
    ]


def test_cleaning_then_splitting_gives_the_same_words(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    slow = F.filter(F.split(X.clean_text("text"), r"\s+"), lambda w: w != "")
    assert docs.filter(X.tokenize("text") != slow).count() == 0


def test_stopword_list_of_the_caller(value):
    assert "university" not in ENGLISH_STOPWORDS
    assert len(set(ENGLISH_STOPWORDS)) == len(ENGLISH_STOPWORDS) == 179
    kept = value(lambda c: X.tokenize_and_clean(c, stopwords=["visa"]), "the visa visa desk desk")
    assert kept == ["the", "desk", "desk"]
    assert value(lambda c: X.remove_stopwords(X.tokenize(c), []), "the a") == ["the", "a"]


def test_ngrams_follow_filtered_tokens(value):
    grams = value(lambda c: X.ngrams(X.tokenize_and_clean(c), 1, 3), "the red car is fast")
    assert grams == ["red", "car", "fast", "red car", "car fast", "red car fast"]
    assert value(lambda c: X.ngrams(X.tokenize(c), 2, 3), "one") == []
    with pytest.raises(ValueError):
        X.ngrams("t", 2, 1)


def test_sentences_keep_section_numbers(value):
    cut = value(X.split_sentences, "Section 2.1 says no. Really?!  It is so short. Ok. Fine it is!")
    assert cut == ["Section 2.1 says no.", "It is so short.", "Fine it is!"]


def test_query_terms_and_overlap(value):
    assert value(X.query_terms, "What is the Café fee, the fee_2?") == ["café", "fee", "fee_2"]
    shared = value(lambda c: X.word_overlap(X.query_terms(c), F.lit("A FEE at the café.")), "café fee x")
    assert shared == ["café", "fee"]


def test_token_recall_counts_repeats(spark):
    df = spark.createDataFrame([(["a", "a", "b"], ["a", "c"]), ([], ["a"])], "q array<string>, d array<string>")
    rows = df.select(*X.token_recall("q", "d")).collect()
    assert rows[0] == (["a", "a"], 2 / 3)
    assert rows[1] == ([], None)


def test_excerpt_and_formats(value):
    assert value(X.excerpt, "x" * 200) == "x" * 110 + "..."
    assert value(lambda c: X.format4(F.lit(0.5)), "") == "0.5000"


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from("abcdé "), max_size=12), min_size=1, max_size=6))
def test_run_lengths_count_like_a_counter(spark, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, a array<string>")
    found = df.select("i", X.run_lengths(F.col("a"), "t", "n").alias("r")).collect()
    for row in found:
        assert {x["t"]: x["n"] for x in row["r"]} == dict(Counter(rows[row["i"]]))
