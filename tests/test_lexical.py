from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from loomtext.functions.text import tokenize_and_clean
from loomtext.operators import lexical as L
from loomtext.operators import scoring
from loomtext.operators.hybrid import rrf_fuse


@pytest.fixture(scope="module")
def model(faq):
    return L.fit_lexical(faq)


def brute_force(tokens: dict, queries: dict):
    """Unit TF-IDF cosines in plain Python."""
    n = len(tokens)
    df = Counter(t for words in tokens.values() for t in set(words))
    idf = {t: math.log((1 + n) / (1 + d)) + 1 for t, d in df.items()}

    def vector(words):
        w = {t: c * idf[t] for t, c in Counter(words).items() if t in idf}
        length = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / length for t, x in w.items()}

    docs = {d: vector(w) for d, w in tokens.items()}
    scores = defaultdict(dict)
    for q, words in queries.items():
        v = vector(words)
        for d, w in docs.items():
            shared = [v[t] * w[t] for t in v if t in w]
            if shared:
                scores[q][d] = sum(shared)
    return scores


def token_map(df, key):
    rows = df.select(key, tokenize_and_clean("text").alias("t")).collect()
    return {r[0]: r[1] for r in rows}


def test_scores_match_brute_force(spark, faq, ask, model):
    queries = ask("bursar fee deposit wire", "river bank", "bank wire bank", "unknown words")
    pairs = L.cosine_scores(faq, queries, model).collect()
    expected = brute_force(token_map(faq, "doc_id"), token_map(queries, "query_id"))
    assert {(r["query_id"], r["doc_id"]) for r in pairs} == {
        (q, d) for q, ds in expected.items() for d in ds
    }
    for r in pairs:
        assert math.isclose(r["cosine_score"], expected[r["query_id"]][r["doc_id"]], rel_tol=1e-9)


def test_unbounded_paths_give_the_same_scores(faq, ask, model):
    queries = ask("bursar fee deposit wire", "river bank", "the bank bank")
    vectors, _ = L.query_vectors(queries, model)
    counts = L.count_words(faq, "doc_id", "text")
    large = L.LexicalModel(model.idf, model.n_docs, False)

    stored = L.store_postings(faq, model)
    found = [L._asked_postings(stored, vectors, model, b, "doc_id") for b in (True, False)]
    hits = [{(r[0], h["term"]) for r in f.collect() for h in r["hits"]} for f in found]
    assert hits[0] == hits[1] != set()

    def scores(m, bounded):
        weights = L.asked_weights(counts, vectors, m, bounded)
        rows = L.score_pairs(weights, vectors, m, bounded).collect()
        return {(r[0], r[1]): round(r[2], 9) for r in rows}

    assert scores(model, True) == scores(large, False) != {}


def test_stored_postings_give_the_same_hits(faq, ask, model):
    queries = ask("bursar fee deposit wire", "river bank", "unknown words")
    stored = L.store_postings(faq, model)

    def found(**options):
        rows = L.search_topk(faq, queries, model, mode="flag", **options).collect()
        return sorted((r["query_id"], r["rank"], r["doc_id"], round(r["cosine_score"], 9)) for r in rows)

    assert found(postings=stored) == found()


def test_filter_mode(faq, ask, model):
    rows = L.search_topk(faq, ask("bursar fee deposit wire"), model).orderBy("rank").collect()
    scores = [r["cosine_score"] for r in rows]
    assert 1 <= len(rows) <= 3 and scores == sorted(scores, reverse=True)
    assert all(0.1 <= s <= 1 for s in scores)
    assert rows[0]["doc_id"] == "FAQ-01"
    assert rows[0]["matched_keywords"] == ["bursar", "deposit", "fee", "wire"]
    parts = rows[0]["contributions"]
    assert math.isclose(sum(p["contribution"] for p in parts), scores[0])
    assert [p["contribution"] for p in parts] == sorted(
        (p["contribution"] for p in parts), reverse=True
    )


def test_flag_mode_always_fills_k_rows(faq, ask, model):
    queries = ask("bursar fee deposit wire", "xyzqwk123 nonexistingtoken999")
    rows = L.search_topk(faq, queries, model, mode="flag").orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"]) for r in rows] == [(q, k) for q in (1, 2) for k in (1, 2, 3)]
    lost = [r for r in rows if r["query_id"] == 2]
    assert [r["doc_id"] for r in lost] == ["FAQ-01", "FAQ-02", "FAQ-03"]
    assert all(r["cosine_score"] == 0.0 and not r["is_above_threshold"] for r in lost)
    assert L.search_topk(faq, ask("xyzqwk123 nonexistingtoken999"), model).count() == 0
    with pytest.raises(ValueError):
        L.search_topk(faq, queries, model, mode="other")


def test_document_text_scores_one_against_itself(faq, model):
    queries = faq.select(F.col("doc_id").alias("query_id"), "text")
    best = L.search_topk(faq, queries, model, top=1).collect()
    assert len(best) == 6  # the empty document has no vector
    for r in best:
        assert r["query_id"] == r["doc_id"]
        assert math.isclose(r["cosine_score"], 1.0, rel_tol=1e-9)


def test_fallback_is_strict(faq, ask, model):
    queries = ask("bursar fee deposit", "xyzqwk123 nonexistingtoken999")
    rows = {r["query_id"]: r for r in L.search_with_fallback(faq, queries, model, confidence_threshold=0.25).collect()}
    assert rows[1]["status"] == "SUCCESS" and rows[1]["results"][0]["doc_id"] == "FAQ-01"
    assert rows[2]["status"] == "FALLBACK_TRIGGERED"
    assert rows[2]["max_confidence_score"] == 0.0 and rows[2]["results"] is None
    assert len(rows[2]["suggested_actions"]) == 2


def test_fallback_keeps_weak_candidates_and_flags(faq, ask, model):
    queries = ask("bursar fee deposit", "river", "xyzqwk123")
    rows = {r["query_id"]: r for r in L.search_with_fallback(faq, queries, model, confidence_threshold=0.99).collect()}
    weak = rows[2]["low_confidence_candidates"]
    assert rows[2]["results"] is None and [c["doc_id"] for c in weak] == ["FAQ-04"]
    assert weak[0]["cosine_score"] == rows[2]["max_confidence_score"] and weak[0]["matched_keywords"] == ["river"]
    assert rows[3]["low_confidence_candidates"] is None  # nothing was found at all
    flagged = L.search_with_fallback(faq, queries, model, top=3, confidence_threshold=0.25, mode="flag").collect()
    by_id = {r["query_id"]: r for r in flagged}
    assert [c["is_above_threshold"] for c in by_id[1]["results"]][0] is True
    assert len(by_id[1]["results"]) == 3 and by_id[1]["low_confidence_candidates"] is None
    assert [c["is_above_threshold"] for c in by_id[3]["low_confidence_candidates"]] == [False] * 3
    with pytest.raises(ValueError):
        L.search_with_fallback(faq, queries, model, mode="other")


def test_stored_postings_are_pruned_by_bucket(spark, faq, ask, model):
    stored = L.store_postings(faq, model)
    vectors, bounded = L.query_vectors(ask("river fish", "bursar"), model)
    kept = L._asked_postings(stored, vectors, model, bounded, "doc_id")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: [") :]
    assert filters.startswith("PartitionFilters: [bucket#") and " IN (" in filters.split("]")[0]
    terms = {"river", "fish", "bursar"}
    wanted = {(r["doc_id"], r["term"], r["weight"]) for r in stored.collect() if r["term"] in terms}
    assert {(r["doc_id"], h["term"], h["doc_weight"]) for r in kept.collect() for h in r["hits"]} == wanted != set()
    assert not L._asked_postings(stored, vectors.limit(0), model, bounded, "doc_id").collect()


def test_stored_slices_hold_whole_documents(spark, faq, ask, monkeypatch):
    more = [("FAQ-01", "bursar fee again"), (None, "river bank without a name"), (None, "wire")]
    docs = faq.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id string, text string"))
    model = L.fit_lexical(docs)
    queries = ask("bursar fee deposit wire", "river bank", "unknown words")

    def found(**options):
        rows = L.search_topk(docs, queries, model, **options).collect()
        return sorted((r["query_id"], r["rank"], r["doc_id"] or "", round(r["cosine_score"], 9)) for r in rows)

    whole = found(postings=L.store_postings(docs, model))
    monkeypatch.setattr(L, "SLICE_ROWS", 8)
    monkeypatch.setattr(L, "SLICE_WORDS", 0)
    stored = L.store_postings(docs, model)
    slices = stored.groupBy("doc_id").agg(F.countDistinct("slice")).collect()
    assert {n for _, n in slices} == {1} and stored.select("slice").distinct().count() > 1
    expected = L.tfidf_docs(L.count_words(docs, "doc_id", "text"), model)
    rows = [sorted((r[0] or "", r[1], round(r[2], 9)) for r in f.collect()) for f in (expected, stored)]
    assert rows[0] == rows[1] != []
    vectors, bounded = L.query_vectors(queries, model)
    one = L._asked_postings(stored, vectors, model, bounded, "doc_id").collect()
    parts = [f.collect() for f in L._asked_by_slice(stored, vectors, model, bounded, "doc_id")]
    assert len(parts) > 1 and max(map(len, parts)) < len(one)
    hits = [sorted((r[0] or "", h["term"], h["doc_weight"]) for r in f for h in r["hits"]) for f in (one, sum(parts, []))]
    assert hits[0] == hits[1] != []
    assert found(postings=stored) == whole == found() != []


def test_many_queries_are_explained_without_a_shuffle_of_weights(faq, ask, model, monkeypatch):
    queries = ask("bursar fee deposit wire", "river bank", "bank wire", "fee", "deposit river", "unknown")
    stored = L.store_postings(faq, model)

    def found(**options):
        rows = L.search_topk(faq, queries, model, top=2, **options).collect()
        return sorted((r["query_id"], r["rank"], r["doc_id"], r["matched_keywords"]) for r in rows)

    once = found()
    few, explain = [], L.explain_hits

    def watched(best, weights, vectors, vectors_bounded=True, best_bounded=True, *ids):
        few.append(best_bounded)
        return explain(best, weights, vectors, vectors_bounded, best_bounded, *ids)

    monkeypatch.setattr(L, "explain_hits", watched)
    monkeypatch.setattr(L, "within_bound", lambda *_, **__: False)
    monkeypatch.setattr(L, "BROADCAST_ROWS", 8)
    monkeypatch.setattr(scoring, "BROADCAST_ROWS", 4)
    assert found() == once != []
    monkeypatch.setattr(L, "BLOCKS_AT_ONCE", 2)
    assert found(postings=stored) == once
    assert len(few) > 4 and all(few)  # 12 hits in all, at most 8 in a block


def test_threshold_equality_succeeds(spark, ask):
    ranked = spark.createDataFrame(
        [(1, 1, 7, 0.2, ["a"]), (2, 1, 8, 0.1999, ["a"])],
        "query_id long, rank int, doc_id long, cosine_score double, matched_keywords array<string>",
    )
    rows = L.fallback_payloads(ranked, ask("x", "y"), 0.2).orderBy("query_id").collect()
    assert [r["status"] for r in rows] == ["SUCCESS", "FALLBACK_TRIGGERED"]
    assert rows[1]["max_confidence_score"] == 0.1999


def test_vectors_are_unit_and_positive(faq, model):
    postings = L.tfidf_docs(L.count_words(faq, "doc_id", "text"), model)
    audit = L.vector_audit(postings, faq).first()
    assert (audit["n_not_unit"], audit["n_negative"], audit["n_docs"], audit["n_empty"]) == (0, 0, 7, 1)


def test_notes_default(spark, faq, ask, model):
    queries = ask("river bank", "bursar fee")
    notes = spark.createDataFrame([("river bank", "word with two senses")], "query string, note string")
    report = L.scenario_report(L.search_topk(faq, queries, model, top=2), queries, notes).collect()
    notes_found = {r["query"]: r["note"] for r in report}
    assert notes_found == {
        "river bank": "word with two senses",
        "bursar fee": "No diagnostic note available for this scenario.",
    }


def test_repeated_hits_of_a_hot_document_text(spark, ask):
    """A third of all rows are copies: ranks go by id, nothing is lost."""
    rows = [(i, "copied lines about rivers") for i in range(40)] + [(100 + i, f"w{i} bank") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = L.fit_lexical(docs)
    best = L.search_topk(docs, ask("rivers"), model, top=50).orderBy("rank").collect()
    assert [r["doc_id"] for r in best] == list(range(40))


def test_search_plan_is_lean(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    asked = spark.read.parquet(f"{sf}/benchmark.parquet").selectExpr("item_id AS query_id", "text")
    hits = L.search_topk(docs, asked, L.fit_lexical(docs))
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SortMergeJoin"):
        assert word not in plan
    # Pairs are summed where their document lies: no exchange by (query, document).
    pairs = plan[plan.index("WindowGroupLimit") :]
    assert "hashpartitioning(query_id" not in pairs.split("doc_weight")[0].split("Partial")[-1]


def test_fusion_prefers_documents_in_both_lists(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 20, 2)], "query_id long, doc_id long, rank int")
    b = spark.createDataFrame([(1, 20, 1), (1, 30, 2)], "query_id long, doc_id long, rank int")
    fused = rrf_fuse([a, b]).orderBy("rank").collect()
    assert [r["doc_id"] for r in fused] == [20, 10, 30]
    assert math.isclose(fused[0]["rrf_score"], 1 / 62 + 1 / 61)


def test_ngram_metrics_pass_over_the_vocabulary_once_and_unsorted(spark):
    texts = ["red fox red fox", "red fox den", "", None, "éa zoo fox", "fox"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    metrics = L.ngram_space_metrics(docs, n_samples=2)
    plan = metrics._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("hashpartitioning(n#") <= 4
    sets = defaultdict(list)
    for words in token_map(docs, "doc_id").values():
        for n in (1, 2, 3):
            sets[n].append({" ".join(words[i : i + n]) for i in range(len(words) - n + 1)})
    rows = {r["ngram_range"]: r for r in metrics.collect()}
    for lo, hi in ((1, 1), (1, 2), (1, 3), (2, 2)):
        row = rows[f"({lo}, {hi})"]
        distinct = {g for n in range(lo, hi + 1) for grams in sets[n] for g in grams}
        assert row["vocabulary_size"] == len(distinct)
        assert row["non_zero"] == sum(len(grams) for n in range(lo, hi + 1) for grams in sets[n])
        several = sorted(g for g in distinct if " " in g)[:2]
        assert row["sample_features"] == (", ".join(several) or "None (Unigrams only)")
