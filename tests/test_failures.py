"""Rows that once failed a job or got lost: nulls, plug-ins that do not load, long conversations."""

from __future__ import annotations

import duckdb

from loomtext.operators.classify import fit_intent
from loomtext.operators.dense import vector_topk
from loomtext.operators.grounding import generate_answers
from loomtext.plans.streaming_plans import USER_TURNS

VECTORS = "id long, embedding array<double>"


def test_null_first_query_vector(spark):
    queries = spark.createDataFrame([(1, None), (2, [1.0, 0.0])], VECTORS).withColumnRenamed("id", "query_id")
    corpus = spark.createDataFrame([(7, [1.0, 0.0]), (8, None)], VECTORS).withColumnRenamed("id", "doc_id")
    got = vector_topk(queries, corpus, 1, "query_id", "doc_id", "embedding").collect()
    assert (2, 7) in [(r.query_id, r.doc_id) for r in got]


def test_a_generator_that_does_not_load(spark):
    def load():
        raise OSError("no service")

    rows = [(1, "p", "q", False), (2, "p", "q", True)]
    asked = spark.createDataFrame(rows, "query_id long, formatted_prompt string, query string, is_refused boolean")
    got = {r.query_id: r for r in generate_answers(asked, load, "m").collect()}
    assert got[1].answer == "[Connection Error]: no service"
    assert got[1].status != got[2].status


def test_null_labels_and_vectors_are_left_out(spark):
    rows = [("a", [0.0, 1.0]), ("b", [1.0, 0.0]), (None, [0.5, 0.5]), ("a", None)]
    train = spark.createDataFrame(rows, "label string, embedding array<double>")
    assert fit_intent(train, "label").labels == ["a", "b"]


def test_long_conversations_keep_their_questions_apart():
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations AS SELECT c AS conv_id, t AS turn, 'user' AS role, 'x' AS text FROM range(3) a(c), range(1500) b(t)")
    assert con.execute(f"SELECT count(DISTINCT query_id) FROM ({USER_TURNS})").fetchone() == (4500,)
