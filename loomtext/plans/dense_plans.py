"""Queries for dense vectors, vector search, projection and classification."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.constants import (
    OOD_MESSAGE,
    VERDICT_AMBIGUOUS,
    VERDICT_STRONG,
    VERDICT_UNRELATED,
)
from ..operators import classify as C
from ..operators import dense as D
from ..operators import evaluate as E
from ..operators.scale import written

from . import sql as S
from .tables import Registry, documents, questions, table, texts

R = Registry()


def vectors(spark, sf):
    return table(spark, sf, "embeddings")


def six(name: str):
    return F.round(F.col(name), 6).alias(name)


def embedded_documents(spark, sf):
    return D.embed_text(texts(spark, sf)).select("doc_id", "embedding")


def embedded_questions(spark, sf):
    return D.embed_text(questions(spark, sf)).select("query_id", "embedding")


DOCUMENT_VECTORS = S.hashed("dv", "SELECT doc_id, text FROM documents", "doc_id")
QUESTION_VECTORS = S.hashed("qv", "SELECT item_id AS query_id, text FROM benchmark", "query_id")


@R.add(
    "embed_text",
    f"""WITH {DOCUMENT_VECTORS} SELECT doc_id, bucket, round(v, 6) AS v FROM dv WHERE v <> 0""",
)
def embed_text(spark, sf):
    long = embedded_documents(spark, sf).select(
        "doc_id", F.posexplode_outer("embedding").alias("bucket", "v")
    )
    return long.filter(F.col("v") != 0).select("doc_id", "bucket", six("v"))


def letter_encoder():
    """A plug-in encoder: unit vectors of letter counts."""

    def encode(texts: list[str]) -> np.ndarray:
        counts = np.array(
            [[t.lower().count(c) for c in "abcdefghijklmnop"] for t in texts], dtype=np.float64
        ).reshape(len(texts), 16)
        lengths = np.linalg.norm(counts, axis=1, keepdims=True)
        return counts / np.where(lengths == 0, 1, lengths)

    return encode


@R.add(
    "embed_with",
    "WITH c AS (SELECT doc_id, list_transform(['"
    + "','".join("abcdefghijklmnop")
    + """'], lambda c: (length(lower(text)) - length(replace(lower(text), c, '')))::DOUBLE) AS v
           FROM documents),
         n AS (SELECT doc_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM c)
       SELECT doc_id, round(CASE WHEN norm = 0 THEN 0 ELSE v[1] / norm END, 4) AS first,
         round(CASE WHEN norm = 0 THEN 0 ELSE v[16] / norm END, 4) AS last FROM n""",
)
def embed_with(spark, sf):
    encoded = D.embed_with(texts(spark, sf), letter_encoder)
    return encoded.select(
        "doc_id",
        F.round(F.get("embedding", F.lit(0)).cast("double"), 4).alias("first"),
        F.round(F.get("embedding", F.lit(15)).cast("double"), 4).alias("last"),
    )


@R.add(
    "l2_normalize",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * 3) AS e
                  FROM embeddings),
       n AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS len FROM v),
       u AS (SELECT vec_id, unnest(list_transform(e, lambda x: x / len)) AS x,
                    generate_subscripts(e, 1) - 1 AS i FROM n)
       SELECT vec_id, i, round(x, 6) AS x FROM u""",
)
def l2_normalize(spark, sf):
    tripled = vectors(spark, sf).select(
        "vec_id",
        F.transform(F.col("embedding").cast("array<double>"), lambda x: x * 3).alias("embedding"),
    )
    return (
        D.normalize_vectors(tripled)
        .select("vec_id", F.posexplode_outer("embedding").alias("i", "x"))
        .select("vec_id", "i", six("x"))
    )


@R.add(
    "compare_pairs",
    f"""WITH p AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e,
                 row_number() OVER (ORDER BY md5('42:' || vec_id), vec_id) - 1 AS i
               FROM embeddings),
        m AS (SELECT a.vec_id AS left_id, b.vec_id AS right_id,
                list_inner_product(a.e, b.e) AS c, list_distance(a.e, b.e) AS d
              FROM p a JOIN p b ON a.i % 2 = 0 AND b.i = a.i + 1)
        SELECT left_id, right_id, round(c, 6) AS cosine, round(d, 6) AS distance,
          CASE WHEN c > 0.65 THEN '{VERDICT_STRONG}' WHEN c > 0.35 THEN '{VERDICT_AMBIGUOUS}'
               ELSE '{VERDICT_UNRELATED}' END AS verdict FROM m""",
)
def compare_pairs(spark, sf):
    pairs = D.seeded_pairs(vectors(spark, sf), "vec_id", "embedding")
    compared = D.compare_pairs(pairs, "left_vector", "right_vector")
    return compared.select("left_id", "right_id", six("cosine"), six("distance"), "verdict")


@R.add(
    "embedding_profile",
    "SELECT count(*) AS n_vectors, max(len(embedding)) AS dimension, "
    "sum(len(embedding) * 4)::BIGINT AS n_bytes, count(*) FILTER (abs(sqrt(list_sum("
    "list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) - 1) > 1e-5) AS n_not_unit, "
    + ", ".join(
        f"round(arg_min(embedding[{i}]::DOUBLE, vec_id), 4) AS c{i:02d}" for i in range(1, 13)
    )
    + " FROM embeddings",
)
def embedding_profile(spark, sf):
    return D.embedding_profile(vectors(spark, sf), "vec_id")


@R.add(
    "encode_labels",
    """SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS label_id
       FROM (SELECT DISTINCT lang FROM documents)""",
)
def encode_labels(spark, sf):
    return D.encode_labels(documents(spark, sf), "lang")


TOPK = f"""WITH {DOCUMENT_VECTORS}, {QUESTION_VECTORS},
  dots AS (SELECT query_id, doc_id, sum(q.v * d.v) AS score
           FROM qv q JOIN dv d USING (bucket) GROUP BY 1, 2),
  every AS (SELECT q.query_id, d.doc_id, coalesce(score, 0.0) AS score
            FROM (SELECT item_id AS query_id FROM benchmark) q CROSS JOIN documents d
            LEFT JOIN dots s ON s.query_id = q.query_id AND s.doc_id = d.doc_id),
  near AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY query_id
              ORDER BY round(score, 9) DESC, doc_id) AS rank FROM every)"""


@R.add(
    "vector_topk",
    f"""{TOPK} SELECT query_id, doc_id, rank, round(score, 6) AS similarity_score
        FROM near WHERE rank <= 5""",
)
def vector_topk(spark, sf):
    best = D.vector_topk(embedded_questions(spark, sf), embedded_documents(spark, sf), 5)
    return best.select("query_id", "doc_id", "rank", six("similarity_score"))


@R.add(
    "ivf_topk_all_cells",
    f"""{TOPK} SELECT query_id, doc_id, rank, round(score, 6) AS similarity_score
        FROM near WHERE rank <= 5""",
)
def ivf_all(spark, sf):
    index = written(embedded_documents(spark, sf), "vectors")
    best = D.ivf_topk(embedded_questions(spark, sf), index, 5, n_cells=8, n_probe=8)
    return best.select("query_id", "doc_id", "rank", six("similarity_score"))


@R.add("ivf_topk")
def ivf(spark, sf):
    index = written(embedded_documents(spark, sf), "vectors")
    best = D.ivf_topk(embedded_questions(spark, sf), index, 5, n_cells=8, n_probe=2)
    return best.select("query_id", "doc_id", "rank", six("similarity_score"))


@R.add(
    "search_cells",
    f"""{TOPK} SELECT query_id, doc_id, rank, round(score, 6) AS similarity_score
        FROM near WHERE rank <= 5""",
)
def search_cells(spark, sf):
    """A stored index, opened by its folder; all cells probed, so the rows are those of exact search."""
    vectors = written(embedded_documents(spark, sf), "vectors")
    index = D.open_cells(spark, D.build_cells(vectors).folder)
    best = D.search_cells(index, embedded_questions(spark, sf), 5, n_probe=len(index.centres))
    return best.select("query_id", "doc_id", "rank", six("similarity_score"))


SELF = """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v
                     FROM embeddings),
  s AS (SELECT a.vec_id AS query_id, b.vec_id AS top_id, list_inner_product(a.v, b.v) AS score
        FROM e a CROSS JOIN e b),
  r AS (SELECT *, row_number() OVER (PARTITION BY query_id
                  ORDER BY round(score, 9) DESC, top_id) AS rank FROM s)"""


@R.add(
    "self_retrieval",
    f"""{SELF} SELECT query_id, top_id, round(score, 6) AS similarity_score,
          abs(score - 1) < 1e-4 AS is_self_match FROM r WHERE rank = 1""",
)
def self_retrieval(spark, sf):
    found = D.self_retrieval(vectors(spark, sf))
    return found.select("query_id", "top_id", six("similarity_score"), "is_self_match")


@R.add(
    "index_profile",
    """SELECT count(embedding) AS n_indexed, count(*) AS n_source,
         count(embedding) = count(*) AS is_in_sync, max(len(embedding)) AS dimension,
         max(len(embedding)) = min(len(embedding)) AS is_uniform, 'inner_product' AS metric
       FROM embeddings""",
)
def index_profile(spark, sf):
    return D.index_profile(vectors(spark, sf), vectors(spark, sf))


@R.add("pca_project")
def pca_project(spark, sf):
    rows = vectors(spark, sf)
    projected = D.pca_project(rows, D.fit_pca(rows, 3))
    return projected.select("vec_id", "label", six("pc1"), six("pc2"), six("pc3"))


@R.add("explained_variance")
def explained_variance(spark, sf):
    rows = vectors(spark, sf)
    shares = D.explained_variance(rows, D.fit_pca(rows, 3))
    return shares.select("component", six("variance_ratio"), six("total_pct"))


@R.add(
    "highlight_label",
    """SELECT vec_id, label = 3 AS is_highlighted,
         CASE WHEN label = 3 THEN 1.0 ELSE 0.12 END::DOUBLE AS opacity FROM embeddings""",
)
def highlight(spark, sf):
    marked = D.highlight_label(vectors(spark, sf), "label", "3")
    return marked.select("vec_id", "is_highlighted", "opacity")


# ---------------------------------------------------------------- classification


@R.add(
    "stratified_split",
    """WITH r AS (SELECT vec_id, label, count(*) OVER (PARTITION BY label) AS n,
         row_number() OVER (PARTITION BY label ORDER BY md5('42:' || vec_id), vec_id) AS i
       FROM embeddings)
       SELECT vec_id, label::BIGINT AS label, i <= round(0.2 * n) AS is_test FROM r""",
)
def stratified_split(spark, sf):
    split = C.stratified_split(vectors(spark, sf), "label", "vec_id")
    return split.select("vec_id", "label", "is_test")


def split_and_fit(spark, sf):
    split = C.stratified_split(vectors(spark, sf), "label", "vec_id")
    return split, C.fit_intent(split.filter(~F.col("is_test")), "label")


@R.add("fit_intent")
def fit_intent(spark, sf):
    split, model = split_and_fit(spark, sf)
    predicted = C.predict_intent(split, model)
    return E.accuracy(predicted, "label", "predicted_intent", by="is_test").select(
        "is_test", "n_rows", "n_correct", six("accuracy")
    )


@R.add("predict_intent")
def predict_intent(spark, sf):
    split, model = split_and_fit(spark, sf)
    predicted = C.predict_intent(split.filter("is_test"), model)
    return predicted.select(
        "vec_id",
        "predicted_intent",
        "confidence_score",
        F.size("class_distribution").alias("n_classes"),
        F.round(
            F.aggregate("class_distribution", F.lit(0.0), lambda a, c: a + c["probability"]), 2
        ).alias("total"),
    )


@R.add("predict_with_fallback")
def predict_with_fallback(spark, sf):
    split, model = split_and_fit(spark, sf)
    decided = C.predict_with_fallback(split.filter("is_test"), model, threshold=0.2)
    return decided.select(
        "vec_id",
        "status",
        "confidence_score",
        "predicted_intent",
        "provisional_intent",
        "fallback_message",
    )


@R.add("retrain_with_new_class")
def retrain(spark, sf):
    labelled = documents(spark, sf).select("doc_id", "lang", "text")
    # Embedded once, read by every pass of the fit and by the prediction.
    train = written(
        D.embed_text(labelled).select(F.col("lang").alias("intent"), "embedding"), "train"
    )
    extra = D.embed_text(
        questions(spark, sf).select(F.lit("question").alias("intent"), "text")
    ).select("intent", "embedding")
    model = C.retrain_with_new_class(train, extra, "intent")
    predicted = C.predict_intent(train.unionByName(extra), model)
    return predicted.groupBy("intent", "predicted_intent").agg(F.count(F.lit(1)).alias("n"))


# Deterministic predictions for the metrics: the language guessed from special letters.
RULE = """predictions AS (SELECT doc_id, lang AS actual,
  CASE WHEN regexp_matches(text, '[ßüäö]') THEN 'de' WHEN regexp_matches(text, '[ñó]') THEN 'es'
       WHEN regexp_matches(text, '[éèêç]') THEN 'fr' ELSE 'en' END AS predicted,
  round(1 - 1 / (1 + n_chars / 500.0), 4) AS confidence_score FROM documents)"""


def predictions(spark, sf):
    text = F.col("text")
    guess = (
        F.when(text.rlike("[ßüäö]"), "de")
        .when(text.rlike("[ñó]"), "es")
        .when(text.rlike("[éèêç]"), "fr")
        .otherwise("en")
    )
    confidence = F.round(1 - 1 / (1 + F.col("n_chars") / 500.0), 4)
    return documents(spark, sf).select(
        "doc_id",
        F.col("lang").alias("actual"),
        guess.alias("predicted"),
        confidence.alias("confidence_score"),
    )


@R.add(
    "reject_unsure",
    f"""WITH {RULE} SELECT doc_id, confidence_score,
          CASE WHEN confidence_score < 0.5 THEN 'OOD_FALLBACK_TRIGGERED'
               ELSE 'CONFIRMED_INTENT' END AS status,
          CASE WHEN confidence_score >= 0.5 THEN predicted END AS predicted_intent,
          CASE WHEN confidence_score < 0.5 THEN predicted END AS provisional_intent,
          CASE WHEN confidence_score < 0.5 THEN {S.quote(OOD_MESSAGE)} END AS fallback_message
        FROM predictions""",
)
def reject_unsure(spark, sf):
    rows = predictions(spark, sf).withColumnRenamed("predicted", "predicted_intent").drop("actual")
    return C.reject_unsure(rows)


@R.add(
    "accuracy",
    f"""WITH {RULE} SELECT count(*) AS n_rows,
          count(*) FILTER (actual = predicted) AS n_correct,
          round(count(*) FILTER (actual = predicted) / count(*)::DOUBLE, 6) AS accuracy
        FROM predictions""",
)
def accuracy(spark, sf):
    return E.accuracy(predictions(spark, sf)).select("n_rows", "n_correct", six("accuracy"))


@R.add(
    "classification_report",
    f"""WITH {RULE}, names AS (SELECT actual AS class FROM predictions
                               UNION SELECT predicted FROM predictions),
        c AS (SELECT class, count(*) FILTER (actual = class AND predicted = class) AS hits,
                count(*) FILTER (actual = class) AS support,
                count(*) FILTER (predicted = class) AS claimed
              FROM names, predictions GROUP BY 1),
        m AS (SELECT class, support, hits,
                CASE WHEN claimed = 0 THEN 0 ELSE hits / claimed::DOUBLE END AS precision,
                CASE WHEN support = 0 THEN 0 ELSE hits / support::DOUBLE END AS recall FROM c),
        f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0
                ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM m),
        t AS (
          SELECT class, precision, recall, f1, support FROM f
          UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM f
          UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
            sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)
            FROM f
          UNION ALL SELECT 'accuracy', sum(hits) / sum(support)::DOUBLE,
            sum(hits) / sum(support)::DOUBLE, sum(hits) / sum(support)::DOUBLE, sum(support)
            FROM f)
        SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall,
          round(f1, 6) AS f1, support::BIGINT AS support FROM t""",
)
def classification_report(spark, sf):
    report = E.classification_report(predictions(spark, sf))
    return report.select("class", six("precision"), six("recall"), six("f1"), "support")


@R.add(
    "confusion_matrix",
    f"""WITH {RULE}, names AS (SELECT actual AS class FROM predictions
                               UNION SELECT predicted FROM predictions)
        SELECT a.class AS actual, p.class AS predicted, count(x.doc_id) AS n
        FROM names a CROSS JOIN names p
        LEFT JOIN predictions x ON x.actual = a.class AND x.predicted = p.class GROUP BY 1, 2""",
)
def confusion_matrix(spark, sf):
    return E.confusion_matrix(predictions(spark, sf))


@R.add(
    "confusion_table",
    f"""WITH {RULE} SELECT actual, count(*) FILTER (predicted = 'de') AS de,
          count(*) FILTER (predicted = 'en') AS en, count(*) FILTER (predicted = 'es') AS es,
          count(*) FILTER (predicted = 'fr') AS fr FROM predictions GROUP BY 1""",
)
def confusion_table(spark, sf):
    return E.confusion_table(predictions(spark, sf), ["de", "en", "es", "fr"])
