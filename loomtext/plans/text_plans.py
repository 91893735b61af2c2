"""Queries for the text functions, over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.lexical import fit_lexical, search_topk
from ..operators.scale import within_bound
from . import sql as S
from .tables import Registry, documents, questions, texts

R = Registry()


def joined(c, by=" "):
    return F.array_join(c, by)


@R.add("clean_text", f"SELECT doc_id, {S.clean('text')} AS cleaned FROM documents")
def clean_text(spark, sf):
    return texts(spark, sf).select("doc_id", X.clean_text("text").alias("cleaned"))


@R.add(
    "tokenize",
    f"SELECT doc_id, array_to_string({S.tokens('text')}, ' ') AS tokens FROM documents",
)
def tokenize(spark, sf):
    return texts(spark, sf).select("doc_id", joined(X.tokenize("text")).alias("tokens"))


@R.add(
    "remove_stopwords",
    f"""SELECT doc_id, array_to_string(list_filter({S.tokens('text')},
          lambda x: x NOT IN ({S.STOP}, 'que') OR x = 'few'), ' ') AS kept
        FROM documents""",
)
def remove_stopwords(spark, sf):
    # The list is the caller's: one word more, one word less.
    custom = [w for w in X.ENGLISH_STOPWORDS if w != "few"] + ["que"]
    kept = X.remove_stopwords(X.tokenize("text"), custom)
    return texts(spark, sf).select("doc_id", joined(kept).alias("kept"))


@R.add(
    "tokenize_and_clean",
    f"""SELECT doc_id, array_to_string({S.content('text')}, ' ') AS tokens,
          len({S.content('text')}) AS n_tokens, len({S.tokens('text')}) AS n_raw
        FROM documents""",
)
def tokenize_and_clean(spark, sf):
    content = X.tokenize_and_clean("text")
    return (
        texts(spark, sf)
        .select(
            "doc_id",
            content.alias("c"),
            F.size(X.tokenize_and_clean("text", remove_stopwords=False)).alias("n_raw"),
        )
        .select("doc_id", joined("c").alias("tokens"), F.size("c").alias("n_tokens"), "n_raw")
    )


@R.add(
    "preview_stages",
    f"""SELECT item_id AS query_id, lower(text) AS lowered,
          array_to_string({S.tokens('text')}, '|') AS raw_tokens,
          array_to_string({S.content('text')}, '|') AS content_tokens
        FROM benchmark""",
)
def preview_stages(spark, sf):
    return (
        questions(spark, sf)
        .select("query_id", *X.preview_stages("text"))
        .withColumn("raw_tokens", joined("raw_tokens", "|"))
        .withColumn("content_tokens", joined("content_tokens", "|"))
    )


@R.add(
    "ngrams",
    f"""WITH t AS (SELECT doc_id, {S.content('text')} AS w FROM documents),
        g AS (
          SELECT doc_id, w AS grams FROM t
          UNION ALL
          SELECT doc_id, list_transform(generate_series(1, len(w) - 1),
                   lambda i: w[i] || ' ' || w[i + 1]) FROM t WHERE len(w) >= 2)
        SELECT doc_id, sum(len(grams))::BIGINT AS n_grams,
          md5(array_to_string(list_sort(flatten(list(grams))), '|')) AS digest
        FROM g GROUP BY doc_id""",
)
def ngrams(spark, sf):
    grams = X.ngrams(X.tokenize_and_clean("text"), 1, 2)
    return (
        texts(spark, sf)
        .select("doc_id", grams.alias("g"))
        .select(
            "doc_id",
            F.size("g").alias("n_grams"),
            F.md5(joined(F.sort_array("g"), "|")).alias("digest"),
        )
    )


@R.add(
    "text_lengths",
    f"""SELECT doc_id, length({S.strip('text')}) AS char_length,
          {S.word_count('text')} AS token_estimate FROM documents""",
)
def text_lengths(spark, sf):
    return texts(spark, sf).select("doc_id", *X.text_lengths("text"))


@R.add(
    "split_sentences",
    f"""SELECT doc_id, len({S.sentences('text')}) AS n_sentences,
          array_to_string({S.sentences('text')}, '|') AS sentences FROM documents""",
)
def split_sentences(spark, sf):
    return (
        texts(spark, sf)
        .select("doc_id", X.split_sentences("text").alias("s"))
        .select("doc_id", F.size("s").alias("n_sentences"), joined("s", "|").alias("sentences"))
    )


@R.add(
    "query_terms",
    f"""SELECT item_id AS query_id, array_to_string(list_sort(list_filter({S.words('text')},
          lambda x: x NOT IN ({S.ASKING}))), ' ') AS terms FROM benchmark""",
)
def query_terms(spark, sf):
    terms = F.sort_array(X.query_terms("text"))
    return questions(spark, sf).select("query_id", joined(terms).alias("terms"))


def best_documents(spark, sf):
    """Each question with its best document."""
    docs, asked = documents(spark, sf), questions(spark, sf)
    best = search_topk(docs, asked, fit_lexical(docs), top=1, threshold=0.0)
    chosen = docs.select("doc_id", F.col("text").alias("doc_text"))
    pairs = best.select("query_id", "doc_id").join(asked, "query_id")
    return chosen.join(F.broadcast(pairs) if within_bound(asked) else pairs, "doc_id")


BEST = f"""{S.search()},
  best AS (SELECT query_id, r.doc_id, b.text, d.text AS doc_text
           FROM ranked r JOIN benchmark b ON b.item_id = query_id
           JOIN documents d ON d.doc_id = r.doc_id WHERE rank = 1)"""


@R.add(
    "word_overlap",
    f"""{BEST}, cut AS (
          SELECT query_id, doc_id, list_filter({S.words('text')},
                   lambda x: x NOT IN ({S.ASKING})) AS terms,
                 unnest({S.sentences('doc_text')}) AS sentence,
                 generate_subscripts({S.sentences('doc_text')}, 1) AS sentence_no
          FROM best),
        found AS (SELECT *, list_intersect(terms, {S.words('sentence')}) AS shared FROM cut)
        SELECT query_id, doc_id, sentence_no,
               array_to_string(list_sort(shared), ' ') AS shared
        FROM found WHERE len(shared) > 0""",
)
def word_overlap(spark, sf):
    cut = best_documents(spark, sf).select(
        "query_id",
        "doc_id",
        X.query_terms("text").alias("terms"),
        F.posexplode(X.split_sentences("doc_text")).alias("i", "sentence"),
    )
    shared = cut.withColumn("s", X.word_overlap("terms", "sentence")).filter(F.size("s") > 0)
    return shared.select(
        "query_id",
        "doc_id",
        (F.col("i") + 1).alias("sentence_no"),
        joined(F.sort_array("s")).alias("shared"),
    )


@R.add(
    "token_recall",
    f"""{BEST}, t AS (SELECT query_id, doc_id, {S.content('text')} AS q,
                         {S.content('doc_text')} AS d FROM best)
        SELECT query_id, doc_id,
          array_to_string(list_filter(q, lambda x: list_contains(d, x)), ' ') AS matched_tokens,
          round(len(list_filter(q, lambda x: list_contains(d, x))) / nullif(len(q), 0)::DOUBLE, 6)
            AS token_recall
        FROM t""",
)
def token_recall(spark, sf):
    pairs = best_documents(spark, sf).select(
        "query_id",
        "doc_id",
        X.tokenize_and_clean("text").alias("q"),
        X.tokenize_and_clean("doc_text").alias("d"),
    )
    return pairs.select("query_id", "doc_id", *X.token_recall("q", "d")).select(
        "query_id",
        "doc_id",
        joined("matched_tokens").alias("matched_tokens"),
        F.round("token_recall", 6).alias("token_recall"),
    )


@R.add(
    "excerpt",
    """SELECT d.doc_id, substr(text, 1, 110) || '...' AS excerpt,
         round(n_chars / 7.0, 4) AS rounded, printf('%.4f', n_chars / 8.0) AS formatted
       FROM documents d""",
)
def excerpt(spark, sf):
    return documents(spark, sf).select(
        "doc_id",
        X.excerpt("text").alias("excerpt"),
        X.round4(F.col("n_chars") / 7.0).alias("rounded"),
        X.format4(F.col("n_chars") / 8.0).alias("formatted"),
    )
