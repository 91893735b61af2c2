"""Queries for the lexical vector space and lexical search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.constants import FALLBACK_ACTIONS, FALLBACK_MESSAGE, NO_NOTE
from ..operators import lexical as L
from ..operators.hybrid import bm25_topk, edge_reorder, rrf_fuse
from . import sql as S
from .tables import Registry, documents, questions

R = Registry()
MATRIX_TERMS = ["des", "die", "la", "por", "thing", "und"]


def model(spark, sf):
    return L.fit_lexical(documents(spark, sf))


def postings(spark, sf):
    docs = documents(spark, sf)
    return L.tfidf_docs(L.count_words(docs, "doc_id", "text"), L.fit_lexical(docs))


def vectors(spark, sf):
    return L.query_vectors(questions(spark, sf), model(spark, sf))[0]


def hits(spark, sf, **options):
    docs = documents(spark, sf)
    return L.search_topk(docs, questions(spark, sf), L.fit_lexical(docs), **options)


def six(name: str):
    return F.round(F.col(name), 6).alias(name)


@R.add("fit_idf", f"WITH {S.COUNTS} SELECT term, df, round(idf, 6) AS idf FROM idf")
def fit_idf(spark, sf):
    docs = documents(spark, sf)
    idf = L.fit_idf(L.count_words(docs, "doc_id", "text"), docs.count())
    return idf.select("term", "df", six("idf"))


@R.add(
    "tfidf_docs",
    f"WITH {S.COUNTS}, {S.DOC_WEIGHTS} SELECT doc_id, term, round(w, 6) AS weight FROM docw",
)
def tfidf_docs(spark, sf):
    return postings(spark, sf).select("doc_id", "term", six("weight"))


@R.add(
    "tfidf_query",
    f"WITH {S.COUNTS}, {S.query_weights()} SELECT query_id, term, round(w, 6) AS weight FROM qw",
)
def tfidf_query(spark, sf):
    return vectors(spark, sf).select("query_id", "term", six("weight"))


@R.add(
    "vector_space_summary",
    f"""WITH {S.COUNTS}, t AS (
          SELECT (SELECT count(*) FROM documents) AS n_docs, count(*) AS vocabulary_size,
                 sum(df)::BIGINT AS non_zero FROM idf)
        SELECT *, n_docs::DOUBLE * vocabulary_size AS total_cells,
          round(non_zero / (n_docs::DOUBLE * vocabulary_size) * 100, 4) AS density_pct,
          round((1 - non_zero / (n_docs::DOUBLE * vocabulary_size)) * 100, 4) AS sparsity_pct
        FROM t""",
)
def vector_space_summary(spark, sf):
    fitted = model(spark, sf)
    return L.vector_space_summary(fitted.idf, fitted.n_docs)


@R.add(
    "vocabulary_sample",
    f"""WITH {S.COUNTS} SELECT term, df, row_number() OVER (ORDER BY term) - 1 AS term_index
        FROM idf ORDER BY term LIMIT 10""",
)
def vocabulary_sample(spark, sf):
    return L.vocabulary_sample(model(spark, sf).idf)


@R.add(
    "vocabulary_index",
    f"""WITH {S.COUNTS}
        SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_index FROM idf""",
)
def vocabulary_index(spark, sf):
    return L.vocabulary_index(model(spark, sf).idf).select("term", "term_index")


@R.add(
    "query_term_weights",
    f"""WITH {S.COUNTS}, {S.query_weights()}, r AS (
          SELECT *, row_number() OVER (
            PARTITION BY query_id ORDER BY round(w, 9) DESC, term) AS rank FROM qw)
        SELECT query_id, rank, term, round(w, 6) AS weight FROM r WHERE rank <= 12""",
)
def query_term_weights(spark, sf):
    weights = L.query_term_weights(vectors(spark, sf))
    return weights.select("query_id", "rank", "term", six("weight"))


@R.add(
    "doc_term_matrix",
    f"WITH {S.COUNTS}, {S.DOC_WEIGHTS} SELECT d.doc_id, "
    + ", ".join(
        f"round(coalesce(max(CASE WHEN term = '{t}' THEN w END), 0.0), 6) AS \"{t}\""
        for t in MATRIX_TERMS
    )
    + " FROM documents d LEFT JOIN docw USING (doc_id) GROUP BY d.doc_id",
)
def doc_term_matrix(spark, sf):
    wide = L.doc_term_matrix(postings(spark, sf), documents(spark, sf), MATRIX_TERMS)
    return wide.select("doc_id", *[six(t) for t in MATRIX_TERMS])


@R.add(
    "cosine_scores",
    f"{S.search()} SELECT query_id, doc_id, round(score, 6) AS cosine_score FROM pairs",
)
def cosine_scores(spark, sf):
    docs = documents(spark, sf)
    pairs = L.cosine_scores(docs, questions(spark, sf), L.fit_lexical(docs))
    return pairs.select("query_id", "doc_id", six("cosine_score"))


@R.add(
    "search_topk",
    f"""{S.search()} SELECT query_id, rank, doc_id, round(score, 6) AS cosine_score
        FROM ranked WHERE rank <= 3 AND round(score, 9) >= 0.1""",
)
def search_topk(spark, sf):
    return hits(spark, sf).select("query_id", "rank", "doc_id", six("cosine_score"))


@R.add(
    "search_stored_postings",
    f"""{S.search()} SELECT query_id, rank, doc_id, round(score, 6) AS cosine_score
        FROM ranked WHERE rank <= 3 AND round(score, 9) >= 0.1""",
)
def search_stored(spark, sf):
    docs = documents(spark, sf)
    fitted = L.fit_lexical(docs)
    stored = L.store_postings(docs, fitted)
    found = L.search_topk(docs, questions(spark, sf), fitted, postings=stored)
    return found.select("query_id", "rank", "doc_id", six("cosine_score"))


@R.add(
    "search_topk_flag",
    f"""{S.search()}, padded AS (
          SELECT query_id, doc_id, score, 0 AS pad FROM pairs
          UNION ALL
          SELECT b.item_id, d.doc_id, 0.0, 1
          FROM benchmark b, (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 3) d
          WHERE NOT EXISTS (SELECT 1 FROM pairs p
                            WHERE p.query_id = b.item_id AND p.doc_id = d.doc_id)),
        numbered AS (
          SELECT *, row_number() OVER (PARTITION BY query_id
                      ORDER BY pad, round(score, 9) DESC, doc_id) AS rank FROM padded)
        SELECT query_id, rank, doc_id, round(score, 6) AS cosine_score,
               round(score, 9) >= 0.1 AS is_above_threshold
        FROM numbered WHERE rank <= 3""",
)
def search_topk_flag(spark, sf):
    flagged = hits(spark, sf, mode="flag")
    return flagged.select("query_id", "rank", "doc_id", six("cosine_score"), "is_above_threshold")


@R.add(
    "matched_keywords",
    f"""{S.search()} SELECT query_id, rank, r.doc_id,
          string_agg(q.term, ' ' ORDER BY q.term) AS matched_keywords
        FROM ranked r JOIN qw q USING (query_id) JOIN docw d ON d.doc_id = r.doc_id
          AND d.term = q.term
        WHERE rank <= 3 AND round(score, 9) >= 0.1 GROUP BY 1, 2, 3""",
)
def matched_keywords(spark, sf):
    return hits(spark, sf).select(
        "query_id",
        "rank",
        "doc_id",
        F.array_join("matched_keywords", " ").alias("matched_keywords"),
    )


@R.add(
    "term_contributions",
    f"""{S.search()}, parts AS (
          SELECT query_id, rank, r.doc_id, q.term, q.w AS qw, d.w AS dw, q.w * d.w AS c
          FROM ranked r JOIN qw q USING (query_id) JOIN docw d ON d.doc_id = r.doc_id
            AND d.term = q.term
          WHERE rank <= 3 AND round(score, 9) >= 0.1)
        SELECT query_id, rank, doc_id, term, round(qw, 6) AS query_weight,
          round(dw, 6) AS doc_weight, round(c, 6) AS contribution,
          row_number() OVER (PARTITION BY query_id, doc_id
                             ORDER BY round(c, 9) DESC, term) AS term_rank
        FROM parts""",
)
def term_contributions(spark, sf):
    parts = L.term_contributions(hits(spark, sf))
    return parts.select(
        "query_id",
        "rank",
        "doc_id",
        "term",
        "term_rank",
        six("query_weight"),
        six("doc_weight"),
        six("contribution"),
    )


def flat_payloads(payloads):
    """Payloads with the nested results as text."""

    def shown(hits):
        entry = F.transform(
            hits,
            lambda r: F.concat_ws(
                ":",
                r["rank"].cast("string"),
                r["doc_id"].cast("string"),
                F.format_string("%.4f", r["cosine_score"]),
                F.array_join(r["matched_keywords"], ","),
            ),
        )
        return F.array_join(entry, ";").alias(hits)

    return payloads.select(
        "query_id",
        "status",
        F.round("max_confidence_score", 6).alias("max_confidence_score"),
        "fallback_message",
        F.array_join("suggested_actions", "|").alias("suggested_actions"),
        shown("results"),
        shown("low_confidence_candidates"),
    )


def fallback_sql(source: str = "SELECT item_id AS query_id, text FROM benchmark") -> str:
    return f"""{S.search(source)}, parts AS (
          SELECT query_id, rank, r.doc_id, score,
            rank || ':' || r.doc_id || ':' || printf('%.4f', score) || ':' ||
              string_agg(q.term, ',' ORDER BY q.term) AS entry
          FROM ranked r JOIN qw q USING (query_id) JOIN docw d ON d.doc_id = r.doc_id
            AND d.term = q.term
          WHERE rank <= 3 GROUP BY query_id, rank, r.doc_id, score),
        grouped AS (
          SELECT query_id, max(score) AS top,
            string_agg(entry, ';' ORDER BY rank) FILTER (round(score, 9) >= 0.2) AS results,
            string_agg(entry, ';' ORDER BY rank) AS hits
          FROM parts GROUP BY query_id),
        decided AS (
          SELECT query_id, coalesce(top, 0.0) AS top, results, hits,
                 round(coalesce(top, 0.0), 9) < 0.2 AS weak
          FROM ({source}) LEFT JOIN grouped USING (query_id))
        SELECT query_id, round(top, 6) AS max_confidence_score,
          CASE WHEN weak THEN 'FALLBACK_TRIGGERED' ELSE 'SUCCESS' END AS status,
          CASE WHEN weak THEN {S.quote(FALLBACK_MESSAGE)} END AS fallback_message,
          CASE WHEN weak THEN {S.quote('|'.join(FALLBACK_ACTIONS))} END AS suggested_actions,
          CASE WHEN NOT weak THEN results END AS results,
          CASE WHEN weak THEN hits END AS low_confidence_candidates
        FROM decided"""


@R.add("search_with_fallback", fallback_sql())
def search_with_fallback(spark, sf):
    docs = documents(spark, sf)
    return flat_payloads(
        L.search_with_fallback(docs, questions(spark, sf), L.fit_lexical(docs))
    )


@R.add(
    "scenario_report",
    f"""{S.search()} SELECT b.item_id AS query_id, rank, doc_id, round(score, 6) AS cosine_score,
          CASE WHEN length(b.text) > 200 THEN 'long question'
               ELSE {S.quote(NO_NOTE)} END AS note
        FROM benchmark b LEFT JOIN (
          SELECT * FROM ranked WHERE rank <= 2 AND round(score, 9) >= 0.1) r
          ON r.query_id = b.item_id""",
)
def scenario_report(spark, sf):
    asked = questions(spark, sf)
    long_ones = asked.filter(F.length("text") > 200)
    notes = long_ones.select(F.col("text").alias("query"), F.lit("long question").alias("note"))
    report = L.scenario_report(hits(spark, sf, top=2), asked, notes)
    return report.select("query_id", "rank", "doc_id", six("cosine_score"), "note")


@R.add(
    "ngram_space_metrics",
    f"""WITH t AS MATERIALIZED (SELECT doc_id, {S.content('text')} AS w FROM documents),
        g AS (
          SELECT doc_id, 1 AS n, unnest(w) AS gram FROM t
          UNION ALL SELECT doc_id, 2, unnest(list_transform(generate_series(1, len(w) - 1),
            lambda i: w[i] || ' ' || w[i + 1])) FROM t WHERE len(w) >= 2
          UNION ALL SELECT doc_id, 3, unnest(list_transform(generate_series(1, len(w) - 2),
            lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM t WHERE len(w) >= 3),
        v AS MATERIALIZED (SELECT n, gram, count(DISTINCT doc_id) AS df FROM g GROUP BY 1, 2),
        c AS (SELECT * FROM (VALUES (1, 1), (1, 2), (1, 3), (2, 2)) AS x(lo, hi)),
        m AS (SELECT lo, hi, count(*) AS vocabulary_size, sum(df)::BIGINT AS non_zero
              FROM c JOIN v ON n BETWEEN lo AND hi GROUP BY 1, 2),
        s AS (SELECT lo, hi, gram, row_number() OVER (PARTITION BY lo, hi ORDER BY gram) AS i
              FROM c JOIN v ON n BETWEEN lo AND hi WHERE n > 1),
        f AS (SELECT lo, hi, string_agg(gram, ', ' ORDER BY gram) AS sample_features
              FROM s WHERE i <= 3 GROUP BY 1, 2)
        SELECT '(' || m.lo || ', ' || m.hi || ')' AS ngram_range, vocabulary_size, non_zero,
          round((1 - non_zero / ((SELECT count(*) FROM documents)::DOUBLE * vocabulary_size))
                * 100, 2) AS sparsity_pct,
          coalesce(sample_features, 'None (Unigrams only)') AS sample_features
        FROM m LEFT JOIN f ON f.lo = m.lo AND f.hi = m.hi""",
)
def ngram_space_metrics(spark, sf):
    return L.ngram_space_metrics(documents(spark, sf))


@R.add(
    "vector_audit",
    f"""WITH {S.COUNTS}, {S.DOC_WEIGHTS},
        n AS (SELECT doc_id, sqrt(sum(w * w)) AS norm, min(w) AS low FROM docw GROUP BY 1)
        SELECT (SELECT count(*) FROM documents) AS n_docs, count(*) AS n_vectors,
          (SELECT count(*) FROM documents) - count(*) AS n_empty,
          count(*) FILTER (abs(norm - 1) > 1e-5) AS n_not_unit,
          count(*) FILTER (low < 0) AS n_negative FROM n""",
)
def vector_audit(spark, sf):
    return L.vector_audit(postings(spark, sf), documents(spark, sf))


@R.add(
    "self_similarity",
    f"""WITH {S.COUNTS}, {S.DOC_WEIGHTS}
        SELECT doc_id, round(sum(w * w), 6) AS cosine_score FROM docw GROUP BY 1""",
)
def self_similarity(spark, sf):
    return L.self_similarity(postings(spark, sf)).select("doc_id", six("cosine_score"))


BM25 = f"""WITH {S.COUNTS}, {S.query_weights()},
  lengths AS (SELECT doc_id, sum(tf)::BIGINT AS dl FROM counts GROUP BY 1),
  total AS (SELECT sum(dl) / (SELECT count(*) FROM documents)::DOUBLE AS avgdl FROM lengths),
  bm AS (
    SELECT query_id, doc_id,
      sum(ln(1 + ((SELECT count(*) FROM documents) - df + 0.5) / (df + 0.5)) * c.tf * 2.2
          / (c.tf + 1.2 * (0.25 + 0.75 * dl / avgdl))) AS score
    FROM qcounts q JOIN idf USING (term) JOIN counts c USING (term) JOIN lengths USING (doc_id),
         total GROUP BY 1, 2),
  bmr AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY query_id
              ORDER BY round(score, 9) DESC, doc_id) AS rank FROM bm)"""


@R.add(
    "bm25_topk",
    f"""{BM25} SELECT query_id, doc_id, rank, round(score, 6) AS bm25_score
        FROM bmr WHERE rank <= 3""",
)
def bm25(spark, sf):
    docs = documents(spark, sf)
    best = bm25_topk(docs, questions(spark, sf), L.fit_lexical(docs))
    return best.select("query_id", "doc_id", "rank", six("bm25_score"))


@R.add(
    "rrf_fuse",
    f"""{BM25}, {S.DOC_WEIGHTS}, {S.PAIRS},
        lists AS (SELECT query_id, doc_id, rank FROM bmr WHERE rank <= 10
                  UNION ALL SELECT query_id, doc_id, rank FROM ranked WHERE rank <= 10),
        fused AS (SELECT query_id, doc_id, sum(1.0 / (60 + rank)) AS score, count(*) AS n_lists
                  FROM lists GROUP BY 1, 2),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id
                ORDER BY round(score, 9) DESC, doc_id) AS place FROM fused)
        SELECT query_id, doc_id, place AS rank, n_lists, round(score, 6) AS rrf_score
        FROM r WHERE place <= 3""",
)
def fuse(spark, sf):
    docs, asked = documents(spark, sf), questions(spark, sf)
    fitted = L.fit_lexical(docs)
    lexical = L.ranked_hits(docs, asked, fitted, top=10)
    okapi = bm25_topk(docs, asked, fitted, top=10)
    fused = rrf_fuse([lexical, okapi])
    return fused.select("query_id", "doc_id", "rank", "n_lists", six("rrf_score"))


@R.add(
    "edge_reorder",
    f"""{S.search()} SELECT query_id, string_agg(doc_id::VARCHAR, ' ' ORDER BY
          CASE WHEN rank % 2 = 1 THEN rank ELSE 1000 - rank END) AS context_order
        FROM ranked WHERE rank <= 7 GROUP BY 1""",
)
def reorder(spark, sf):
    docs = documents(spark, sf)
    best = L.ranked_hits(docs, questions(spark, sf), L.fit_lexical(docs), top=7)
    asked = best.groupBy("query_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "doc_id"))).alias("retrieved")
    )
    placed = edge_reorder(asked)
    ids = F.transform("retrieved", lambda c: c["doc_id"].cast("string"))
    return placed.select("query_id", F.array_join(ids, " ").alias("context_order"))
