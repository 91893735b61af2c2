from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from loomtext.operators import lexical as L
from loomtext.operators import scale, scoring
from loomtext.operators.hybrid import bm25_topk


def test_best_pairs_equal_brute_force(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, [(w, rng.choice([0.25, 0.5])) for w in rng.sample(words, rng.randint(0, 9))]) for i in range(2500)]
    docs += [(None, [("w1", 9.0), ("other", 1.0)])]
    asked = [(q, w, rng.choice([0.5, 1.0])) for q in [*range(30), None] for w in rng.sample(words, 5)]
    asked += asked[:3]  # terms that come twice count twice
    expected = defaultdict(list)
    by_query = defaultdict(list)
    for q, w, x in asked:
        by_query[q].append((w, x))
    for q, terms in by_query.items():
        for d, hits in docs:
            shared = [x * y for w, x in terms for v, y in hits if v == w]
            if shared:
                expected[q].append((-round(sum(shared), 9), d is not None, d or 0))
    wanted = {
        (q, d if known else None, -s, n)
        for q, found in expected.items()
        for n, (s, known, d) in enumerate(sorted(found)[:4], 1)
    }
    weights = spark.createDataFrame(docs, "d long, hits array<struct<term:string,doc_weight:double>>")
    vectors = spark.createDataFrame(asked, "q long, term string, weight double")
    best = scoring.best_pairs(weights.repartition(3), vectors, 4, "d", "q", "s")
    assert {(r["q"], r["d"], round(r["s"], 9), r["rank"]) for r in best.collect()} == wanted
    assert not scoring.best_pairs(weights, vectors.limit(0), 4, "d", "q").collect()
    assert not scoring.best_pairs(weights.limit(0), vectors, 4, "d", "q").collect()


def test_many_questions_go_in_blocks_and_store_no_pairs(faq, ask, monkeypatch):
    queries = ask("bursar fee deposit wire", "river bank", "bank wire bank", "visa forms", "zzz")
    model = L.fit_lexical(faq)
    shown = ["query_id", "rank", "doc_id"]
    few = [L.ranked_hits(faq, queries, model, 2), bm25_topk(faq, queries, model, 2)]
    few = [sorted(tuple(r) for r in f.select(shown).collect()) for f in few]
    monkeypatch.setattr(scoring, "BROADCAST_ROWS", 4)
    monkeypatch.setattr(L, "within_bound", lambda *_, **__: False)
    monkeypatch.setattr("loomtext.operators.hybrid.within_bound", lambda *_, **__: False)
    many = [L.ranked_hits(faq, queries, model, 2), bm25_topk(faq, queries, model, 2)]
    for frame, rows in zip(many, few):
        assert sorted(tuple(r) for r in frame.select(shown).collect()) == rows != []
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") > 1 and not re.search(r"keys=\[query_id#\d+L?, doc_id#\d+\]", plan)


@pytest.mark.parametrize("bounded", [True, False])
def test_shuffles_of_postings_grow_in_number_not_in_size(spark, faq, ask, monkeypatch, bounded):
    fitted = L.fit_lexical(faq)
    assert fitted.n_postings == L.count_words(faq, "doc_id", "text").count()
    model = L.LexicalModel(fitted.idf, fitted.n_docs, bounded, fitted.n_postings)
    vectors, _ = L.query_vectors(ask("river bank"), model)
    monkeypatch.setattr(scale, "TASK_ROWS", 2)
    parts = -(-fitted.n_postings // 2)
    counts = L.count_words(faq, "doc_id", "text")
    for frame in (L.asked_weights(counts, vectors, model), L.tfidf_docs(counts, model)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert re.search(rf"hashpartitioning\(doc_id#\d+, {parts}\)", plan)
        assert bounded or re.search(rf"hashpartitioning\(term#\d+, _part#\d+, {parts}\)", plan)
        assert frame.count()


def test_dealt_leaves_small_tables_to_spark(spark):
    rows = spark.range(100)
    assert scale.dealt(rows, 100, "id") is rows
    assert scale.dealt(rows, 20 * scale.TASK_ROWS, "id").rdd.getNumPartitions() == 20


def test_postings_are_stored_by_tasks_of_bounded_rows(spark, monkeypatch):
    rows = [(i, f"common w{i % 700} " + ("often" if i % 3 else "seldom")) for i in range(3000)] + [(None, "common")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model = L.fit_lexical(docs)
    monkeypatch.setattr(scale, "TASK_ROWS", 500)
    stored = L.store_postings(docs, model)
    part = F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1)
    files = stored.groupBy(part.alias("task"), F.input_file_name().alias("f")).count().collect()
    tasks = Counter()
    for r in files:
        tasks[r["task"]] += r["count"]
    assert max(tasks.values()) <= 650  # "common" alone has 3,001 rows
    assert len(files) <= stored.select("bucket").distinct().count() + len(tasks)
    expected = L.tfidf_docs(L.count_words(docs, "doc_id", "text"), model)
    found = [sorted((r[0] or -1, r[1], round(r[2], 9)) for r in f.collect()) for f in (expected, stored)]
    assert found[0] == found[1] and len(found[0]) == model.n_postings


def test_rows_in_line_fill_their_tasks(spark, monkeypatch):
    monkeypatch.setattr(scale, "TASK_ROWS", 1000)
    sizes = [0, 5, 7000, 0, 20, 1500, 3]
    rows = [(b, i) for b, n in enumerate(sizes) for i in range(n)] + [(2, None)]
    df = spark.createDataFrame(rows, "b int, i int")
    dealt = scale.dealt_in_line(df, "b", sizes, "b", "i")
    held = dealt.groupBy(F.spark_partition_id()).agg(F.count("*"), F.countDistinct("b")).collect()
    assert dealt.count() == len(rows) and dealt.rdd.getNumPartitions() == len(held)
    assert all(n <= 1200 for _, n, _ in held) and sum(k for _, _, k in held) <= 5 + len(held)
    assert scale.dealt_in_line(df.limit(0), "b", [], "b").count() == 0
