from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtext.functions import vectors as V
from loomtext.functions.text import tokenize_and_clean
from loomtext.operators import dense as D


def frame(spark, matrix, key="doc_id"):
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{key} long, embedding array<float>")


def unit(rng, n, d):
    m = rng.normal(size=(n, d)).astype(np.float32)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


@pytest.fixture(scope="module")
def corpus_matrix():
    m = unit(np.random.default_rng(1), 300, 16)
    m[200:300] = m[5]  # a third of all rows are copies of one vector
    return m


@pytest.fixture(scope="module")
def query_matrix():
    return unit(np.random.default_rng(2), 40, 16)


def brute_force(queries, corpus, k):
    scores = np.round(queries.astype(np.float64) @ corpus.astype(np.float64).T, 9)
    ids = np.arange(len(corpus))
    return {
        (q, rank + 1): int(ids[np.lexsort((ids, -row))][rank])
        for q, row in enumerate(scores)
        for rank in range(min(k, len(corpus)))
    }


@pytest.mark.parametrize("bounded", [True, False])
@pytest.mark.parametrize("k", [1, 7, 400])
def test_topk_is_exact(spark, corpus_matrix, query_matrix, bounded, k):
    found = D.vector_topk(
        frame(spark, query_matrix, "query_id"), frame(spark, corpus_matrix), k, bounded=bounded
    ).collect()
    assert {(r["query_id"], r["rank"]): r["doc_id"] for r in found} == brute_force(
        query_matrix, corpus_matrix, k
    )


def test_grid_of_many_cells_is_exact(spark, corpus_matrix, query_matrix):
    q, c = D._sides(
        frame(spark, query_matrix, "query_id"), frame(spark, corpus_matrix), "query_id", "doc_id", "embedding"
    )
    found = D._ranked(D.grid_topk(q, c, 5, query_rows=16, corpus_rows=50), 5, "query_id", "doc_id")
    assert {(r["query_id"], r["rank"]): r["doc_id"] for r in found.collect()} == brute_force(
        query_matrix, corpus_matrix, 5
    )


def test_null_vectors_and_empty_sides(spark, query_matrix):
    queries = frame(spark, query_matrix[:2], "query_id")
    schema = "doc_id string, embedding array<float>"
    corpus = spark.createDataFrame([("a", None), ("b", [float(x) for x in query_matrix[0]])], schema)
    for bounded in (True, False):
        found = D.vector_topk(queries, corpus, 3, bounded=bounded).collect()
        assert {(r["query_id"], r["doc_id"]) for r in found} == {(0, "b"), (1, "b")}
        assert D.vector_topk(queries.limit(0), corpus, 3, bounded=bounded).count() == 0
        assert D.vector_topk(queries, corpus.limit(0), 3, bounded=bounded).count() == 0


def test_stored_vectors_retrieve_themselves(spark, corpus_matrix):
    rows = D.self_retrieval(frame(spark, corpus_matrix, "vec_id")).collect()
    assert all(r["is_self_match"] for r in rows)
    assert {r["top_id"] for r in rows if r["query_id"] >= 200} == {5}


def test_cells_probed_in_full_are_exact_and_in_part_are_a_subset(spark, corpus_matrix, query_matrix):
    queries, corpus = frame(spark, query_matrix, "query_id"), frame(spark, corpus_matrix)
    centres = D.fit_cells(corpus, 6)
    every = D.ivf_topk(queries, corpus, 5, n_probe=6, centres=centres).collect()
    exact = brute_force(query_matrix, corpus_matrix, 5)
    assert {(r["query_id"], r["rank"]): r["doc_id"] for r in every} == exact
    some = D.ivf_topk(queries, corpus, 5, n_probe=3, centres=centres).collect()
    hit = sum((r["query_id"], r["doc_id"]) in {(q, d) for (q, _), d in exact.items()} for r in some)
    assert hit / len(exact) > 0.4


def test_stored_cells_are_exact_if_all_are_probed_and_pruned_if_not(spark, corpus_matrix, query_matrix):
    queries = frame(spark, query_matrix, "query_id")
    corpus = frame(spark, corpus_matrix).withColumn("rank", F.col("doc_id") * 2)
    lost = spark.createDataFrame([(9_999, None, 1)], corpus.schema)
    built = D.build_cells(corpus.union(lost), 7)
    index = D.open_cells(spark, built.folder)
    assert np.array_equal(index.centres, built.centres) and index.rows.count() == len(corpus_matrix)
    exact = brute_force(query_matrix, corpus_matrix, 5)
    for bounded in (True, False):
        every = D.search_cells(index, queries, 5, n_probe=7, bounded=bounded).collect()
        assert {(r["query_id"], r["rank"]): r["doc_id"] for r in every} == exact
    kept = [
        sorted(map(tuple, D.search_cells(index, queries, 5, n_probe=2, bounded=b).select("query_id", "rank", "doc_id").collect()))
        for b in (True, False)
    ]
    assert kept[0] == kept[1]
    one = queries.filter("query_id = 0")
    centre = np.argmin(((index.centres - query_matrix[0]) ** 2).sum(1))
    inside = {r["doc_id"] for r in index.rows.filter(F.col("_cell") == int(centre)).collect()}
    found = D.search_cells(index, one, 500, n_probe=1)
    assert {r["doc_id"] for r in found.collect()} == inside
    plan = found._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_cell#", plan)  # other folders are not read


def test_stored_cells_take_ties_empty_tables_and_other_columns(spark):
    rows = [(f"d{i % 90}", [1.0, 0.0], "x" * i) for i in range(100)]
    corpus = spark.createDataFrame(rows, "doc_id string, embedding array<double>, cell string")
    queries = spark.createDataFrame([(1, [0.5, 0.5]), (2, [1.0, 0.0]), (3, None)], "query_id long, embedding array<double>")
    index = D.build_cells(corpus)
    for bounded in (True, False):
        got = D.search_cells(index, queries, 2, bounded=bounded, columns=["cell"]).collect()
        assert {(r["query_id"], r["doc_id"]) for r in got} == {(1, "d0"), (2, "d0")}
        assert {r["cell"] for r in got} == {"", "x" * 90}
        assert D.search_cells(index, queries.limit(0), 2, bounded=bounded).count() == 0
    none = D.build_cells(corpus.limit(0))
    assert len(none.centres) == 0 and none.rows.columns == index.rows.columns
    assert D.search_cells(D.open_cells(spark, none.folder), queries, 2, columns=["cell"]).count() == 0


def test_hash_vector_matches_plain_python(spark):
    import hashlib

    text = "alpha beta beta gamma"
    row = spark.createDataFrame([(text,), ("",)], "text string")
    got = D.embed_text(row, dim=8).collect()
    want = np.zeros(8)
    for word in text.split():
        digest = hashlib.md5(word.encode()).hexdigest()
        want[int(digest[:8], 16) % 8] += 1 if int(digest[8], 16) % 2 == 0 else -1
    np.testing.assert_allclose(got[0]["embedding"], want / np.linalg.norm(want))
    assert got[1]["embedding"] == [0.0] * 8


def test_derived_vectors_are_computed_above_the_spread(spark, sf):
    """No filter on a derived vector may slip below the shuffle and compute it twice."""
    from loomtext.plans import dense_plans as P

    found = D.vector_topk(P.embedded_questions(spark, sf), P.embedded_documents(spark, sf), 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "md5" in plan
    assert [line for line in plan.splitlines() if re.search(r"[- ]Filter .*md5", line)] == []


def test_verdicts_and_distances(spark):
    df = spark.createDataFrame(
        [([1.0, 0.0], [0.8, 0.6]), ([1.0, 0.0], [0.5, 0.8660254]), ([1.0, 0.0], [0.0, 1.0])],
        "a array<double>, b array<double>",
    )
    rows = D.compare_pairs(df, "a", "b").collect()
    assert [r["verdict"] for r in rows] == [
        "Strong Semantic Match", "Ambiguous / Weak", "Unrelated Meaning",
    ]
    assert rows[2]["distance"] == pytest.approx(2**0.5)


def test_normalize_keeps_zero(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    assert [r[0] for r in df.select(V.l2_normalize("v")).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_pca_matches_svd(spark, corpus_matrix):
    df = frame(spark, corpus_matrix)
    model = D.fit_pca(df, 2)
    rows = D.pca_project(df, model).orderBy("doc_id").collect()
    centred = corpus_matrix.astype(np.float64) - corpus_matrix.astype(np.float64).mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    for i in range(2):
        axis = vt[i] * np.sign(vt[i][np.argmax(np.abs(vt[i]))])
        np.testing.assert_allclose([r[f"pc{i + 1}"] for r in rows], centred @ axis, atol=1e-6)
    shares = [r["variance_ratio"] for r in D.explained_variance(df, model).orderBy("component").collect()]
    np.testing.assert_allclose(shares, (s**2 / (s**2).sum())[:2], atol=1e-6)


def test_labels_and_highlight(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "l string")
    ids = {r["l"]: r["label_id"] for r in D.encode_labels(df, "l").collect()}
    assert ids == {"a": 0, "b": 1}
    neutral = D.highlight_label(df, "l").select("opacity").distinct().collect()
    assert [r[0] for r in neutral] == [0.85]
    marked = D.highlight_label(df, "l", "b").filter(F.col("is_highlighted")).count()
    assert marked == 2


def test_tokens_reach_the_encoder(spark):
    df = spark.createDataFrame([("x y",), (None,)], "text string")

    def load():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    assert [list(r["embedding"]) for r in D.embed_with(df, load).collect()] == [[3.0, 1.0], [0.0, 1.0]]
    assert df.select(F.size(tokenize_and_clean("text"))).count() == 2


def test_ties_at_the_cut_keep_the_smallest_ids():
    from loomtext.operators.dense import _scan_block

    ids, vectors = np.arange(100)[::-1].copy(), np.ones((100, 2))
    vectors[:2] = 2.0
    q, found, scores = _scan_block(np.array([[1.0, 0.0], [0.0, 0.0]]), ids, vectors, 4)
    assert [sorted(found[q == n].tolist()) for n in (0, 1)] == [[0, 1, 98, 99], [0, 1, 2, 3]]
    assert len(scores) == 8


def test_scan_memory_depends_on_neither_side():
    import tracemalloc

    from loomtext.operators.dense import _scan_block

    rng = np.random.default_rng(5)
    queries, vectors = rng.normal(size=(1500, 8)), np.round(rng.normal(size=(20_000, 8)), 1)
    ids = rng.permutation(len(vectors))
    tracemalloc.start()
    q, found, scores = _scan_block(queries, ids, vectors, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100_000_000
    exact = np.round(queries @ vectors.T, 9)
    for n in range(0, 1500, 100):
        best = sorted(zip(-exact[n], ids))[:3]
        assert found[q == n].tolist() == [i for _, i in best]


def test_many_cells_with_few_questions_are_scanned_in_place(spark):
    rng = np.random.default_rng(6)
    corpus, asked = rng.normal(size=(300, 4)), rng.normal(size=(60, 4))
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(corpus)], "doc_id long, embedding array<double>")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "query_id long, embedding array<double>")
    index = D.build_cells(c, centres=rng.normal(size=(900, 4)))
    found = D.search_cells(index, q, 2, n_probe=900)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "CoGroup" not in plan
    exact = np.argsort(-(asked @ corpus.T), axis=1)[:, :2]
    assert {(r["query_id"], r["rank"]): r["doc_id"] for r in found.collect()} == {
        (i, j + 1): exact[i, j] for i in range(60) for j in range(2)
    }
