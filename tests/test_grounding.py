from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loomtext.functions.constants import REFUSAL_SENTINEL
from loomtext.operators import grounding as G
from loomtext.operators.hybrid import edge_reorder

HIT = "query_id long, rank int, source_id string, text string, similarity_score double"


@pytest.fixture
def asked(spark, ask):
    def make(*hits, question="What are the parking costs?", **options):
        rows = [(1, i, *h) for i, h in enumerate(hits, 1)]
        return G.ask(spark.createDataFrame(rows, HIT), ask(question), **options)

    return make


PARKING = ("1:CHUNK-02", "Parking costs $185 per year. Parking is free on Sunday. Bring it.", 0.785)
OTHER = ("1:CHUNK-01", "Nothing fits here at all. Parking needs a permit.", 0.421)


@pytest.mark.parametrize("wording", ["short", "long"])
def test_prompt_holds_source_question_and_refusal(asked, wording):
    prompt = asked(PARKING, wording=wording).first()["formatted_prompt"]
    assert "--- SOURCE [1:CHUNK-02] (Score: 0.7850) ---\nParking costs" in prompt
    assert "What are the parking costs?" in prompt and REFUSAL_SENTINEL in prompt


def test_placeholders_in_texts_stay(asked):
    prompt = asked(("1:C", "say {student_query} and {context_block}", 0.9)).first()["formatted_prompt"]
    assert "say {student_query} and {context_block}" in prompt


def test_guardrail(asked, spark, ask):
    low = G.extractive_answers(asked(("1:C", "Parking costs a lot.", 0.12))).first()
    assert (low["status"], low["answer"], low["latency_ms"]) == ("GUARDRAIL_REFUSAL", REFUSAL_SENTINEL, 0.0)
    edge = asked(("1:C", "Parking costs a lot.", 0.25)).first()
    assert not edge["is_refused"]
    assert asked(("1:C", "Parking costs a lot.", None)).first()["is_refused"]
    assert not asked(("1:C", "x", 0.1), enforce=False).first()["is_refused"]
    nothing = G.ask(spark.createDataFrame([], HIT), ask("anything")).first()
    assert nothing["is_refused"] and nothing["max_score"] == 0.0 and nothing["retrieved"] == []


def test_extractive_answer(asked):
    answer = asked(PARKING, OTHER).select(G.extractive_answer()).first()[0]
    assert answer == (
        "Parking costs $185 per year. [1:CHUNK-02] Parking is free on Sunday. [1:CHUNK-02] "
        "Parking needs a permit. [1:CHUNK-01]"
    )
    none = asked(("1:C", "Totally different words here.", 0.9)).select(G.extractive_answer()).first()[0]
    assert none == REFUSAL_SENTINEL


def test_repeats_are_dropped_after_the_first_three(asked):
    twice = ("1:C", "Parking is fine. Parking is fine. Parking is good. Parking is best.", 0.9)
    answer = asked(twice).select(G.extractive_answer()).first()[0]
    assert answer == "Parking is fine. [1:C] Parking is good. [1:C]"


def test_generator_errors_become_statuses(spark, ask):
    hits = spark.createDataFrame([(i, 1, "1:C", "text", 0.9 if i < 4 else 0.1) for i in range(1, 5)], HIT)
    asked = G.ask(hits, ask("good", "api", "down", "refused"))

    def load():
        def generate(prompt, query):
            if query == "api":
                raise G.GeneratorApiError("overloaded", 503)
            if query == "down":
                raise ConnectionError("no route")
            assert query != "refused"
            return f"  {query} answer [1:C] "

        return generate

    rows = {r["query"]: r for r in G.generate_answers(asked, load, "stub").collect()}
    assert (rows["good"]["answer"], rows["good"]["status"]) == ("good answer [1:C]", "SUCCESS")
    assert rows["api"]["status"] == "API_ERROR" and "503" in rows["api"]["answer"]
    assert rows["down"]["status"] == "CONNECTION_ERROR"
    assert rows["refused"]["status"] == "GUARDRAIL_REFUSAL"
    assert {r["model_used"] for r in rows.values()} == {"stub"}
    assert all(r["latency_ms"] >= 0 for r in rows.values())


def test_evidence_appears_with_depth(asked):
    both = asked(OTHER, PARKING)
    rows = G.topk_sweep(both, (1, 2), F.lit("$185")).orderBy("k").collect()
    assert [r["has_evidence"] for r in rows] == [False, True]
    assert rows[0]["answer"] != rows[1]["answer"]


def test_injection_changes_the_prompt_only(asked):
    trials = G.inject_at_rank(asked(PARKING, OTHER), "Quiet hours begin at 6 PM.", (1, 8))
    rows = {r["position"]: r for r in trials.collect()}
    assert rows[1]["is_injected"] and not rows[8]["is_injected"]
    assert rows[1]["retrieved"][0]["text"] == (
        "[STUDENT-INJECTED SECRET RULE - RANK 1]\nQuiet hours begin at 6 PM.\n\n" + PARKING[1]
    )
    assert rows[8]["retrieved"][1]["text"] == OTHER[1]


def test_edges_get_the_best_chunks(asked):
    hits = [(f"1:C{i}", "t", 0.9 - i / 10) for i in range(1, 6)]
    row = edge_reorder(asked(*hits)).first()
    assert [c["rank"] for c in row["retrieved"]] == [1, 3, 5, 4, 2]


def test_audit_and_rates(spark):
    answers = spark.createDataFrame(
        [
            (1, "Fine. [a] Good. [b]", ("SUCCESS", 1.0, "m"), [(1, "a"), (2, "b")]),
            (2, "Made up. [z]", ("SUCCESS", 3.0, "m"), [(1, "a")]),
            (3, REFUSAL_SENTINEL, ("GUARDRAIL_REFUSAL", 0.0, "m"), [(1, "a")]),
        ],
        "query_id long, answer string, generation struct<status:string,latency_ms:double,"
        "model_used:string>, retrieved_chunks array<struct<rank:int,source_id:string>>",
    )
    audit = {r["query_id"]: r for r in G.citation_audit(answers).collect()}
    assert audit[1]["is_supported"] and audit[2]["unsupported"] == ["z"]
    assert audit[3]["is_refusal"] and audit[3]["cited"] == []
    rates = G.citation_rates(G.citation_audit(answers)).first()
    assert (rates["n_answers"], rates["supported_rate"], rates["refusal_rate"]) == (3, 0.6667, 0.3333)
    report = {r["status"]: r for r in G.rag_report(answers).collect()}
    assert report["SUCCESS"]["mean_latency_ms"] == 2.0 and report["GUARDRAIL_REFUSAL"]["n_answers"] == 1


def test_whole_chain_with_a_plug_in_encoder(spark, ask):
    """Hand-made vectors stand in for a semantic encoder: the evidence is found and cited."""
    docs = spark.createDataFrame(
        [(1, "Automobile storage costs $185 per year."), (2, "The library opens at nine.")],
        "doc_id long, text string",
    )

    def encode(df):
        car = F.lower("text").rlike("automobile|park")
        return df.withColumn("embedding", F.when(car, F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0))))

    index = G.build_chunk_index(docs, encode=encode)
    rows = G.rag_answers(index, ask("Where can I park, and at what costs?"), top=2, encode=encode).collect()
    assert rows[0]["generation"]["status"] == "SUCCESS"
    assert rows[0]["retrieved_chunks"][0]["text"] == "Automobile storage costs $185 per year."
    assert rows[0]["answer"].startswith("Automobile storage costs $185 per year. [1:CHUNK-01]")
