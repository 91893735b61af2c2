"""Pieces of the SQL twins shared by several queries."""

from __future__ import annotations

from ..functions.constants import ENGLISH_STOPWORDS, QUESTION_WORDS
from ..operators.dense import DIM


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def text_literal(text: str) -> str:
    """A literal that may hold line breaks."""
    return " || chr(10) || ".join(quote(part) for part in text.split("\n"))


BLANKS = "(' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))"
STOP = ", ".join(quote(w) for w in ENGLISH_STOPWORDS)
ASKING = ", ".join(quote(w) for w in QUESTION_WORDS)


def strip(c: str) -> str:
    return f"trim({c}, {BLANKS})"


def clean(c: str) -> str:
    return rf"regexp_replace(lower({c}), '[^a-zA-Z0-9 \t\n\r\f\v]', ' ', 'g')"


def tokens(c: str) -> str:
    """Words of a text, stop words included."""
    parts = rf"'\b(?:(can)(not)|(gim|lem)(me)|(gon|wan)(na)|(got)(ta))\b', '\1\3\5\7 \2\4\6\8', 'g'"
    whole = f"regexp_replace({clean(c)}, {parts})"
    return rf"list_filter(regexp_split_to_array({whole}, '\s+'), lambda x: x <> '')"


def content(c: str) -> str:
    """Words of a text without stop words."""
    return f"list_filter({tokens(c)}, lambda x: x NOT IN ({STOP}))"


def words(c: str) -> str:
    """Distinct words in any script."""
    return rf"list_distinct(regexp_extract_all(lower({c}), '[\p{{L}}\p{{N}}_]+'))"


def sentences(c: str) -> str:
    marked = rf"regexp_replace({c}, '([.!?])[ \t\n\r\f\v]+', '\1' || chr(1), 'g')"
    pieces = f"list_transform(string_split({marked}, chr(1)), lambda s: {strip('s')})"
    return f"list_filter({pieces}, lambda s: length(s) > 10)"


def word_count(c: str) -> str:
    parts = rf"regexp_split_to_array({strip(c)}, '[ \t\n\r\f\v]+')"
    return f"(CASE WHEN {strip(c)} = '' THEN 0 ELSE len({parts}) END)"


# Term counts of documents and queries, idf, unit weights, scores: one CTE after the other.
COUNTS = f"""
words AS (SELECT doc_id, unnest({tokens('text')}) AS term FROM documents),
counts AS MATERIALIZED (
  SELECT doc_id, term, count(*) AS tf FROM words WHERE term NOT IN ({STOP}) GROUP BY 1, 2),
idf AS MATERIALIZED (
  SELECT term, count(*) AS df,
         ln((1.0 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf
  FROM counts GROUP BY 1)"""
DOC_WEIGHTS = """
docw AS MATERIALIZED (
  SELECT doc_id, term,
         tf * idf / sqrt(sum((tf * idf) * (tf * idf)) OVER (PARTITION BY doc_id)) AS w
  FROM counts JOIN idf USING (term))"""


def query_weights(source: str = "SELECT item_id AS query_id, text FROM benchmark") -> str:
    return f"""
qwords AS (SELECT query_id, unnest({tokens('text')}) AS term FROM ({source})),
qcounts AS (
  SELECT query_id, term, count(*) AS tf FROM qwords WHERE term NOT IN ({STOP}) GROUP BY 1, 2),
qw AS MATERIALIZED (
  SELECT query_id, term,
         tf * idf / sqrt(sum((tf * idf) * (tf * idf)) OVER (PARTITION BY query_id)) AS w
  FROM qcounts JOIN idf USING (term))"""


PAIRS = """
pairs AS MATERIALIZED (
  SELECT query_id, doc_id, sum(q.w * d.w) AS score
  FROM qw q JOIN docw d USING (term) GROUP BY 1, 2),
ranked AS MATERIALIZED (
  SELECT *, row_number() OVER (
    PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank
  FROM pairs)"""


def search(source: str = "SELECT item_id AS query_id, text FROM benchmark") -> str:
    return f"WITH {COUNTS}, {DOC_WEIGHTS}, {query_weights(source)}, {PAIRS}"


def hashed(name: str, source: str, key: str, dim: int = DIM) -> str:
    """Unit hashed vectors in long form: (key, bucket, v)."""
    return f"""
{name}_tokens AS (SELECT {key}, unnest({content('text')}) AS t FROM ({source})),
{name}_sums AS (
  SELECT {key}, ('0x' || substr(md5(t), 1, 8))::BIGINT % {dim} AS bucket,
         sum(CASE WHEN ('0x' || substr(md5(t), 9, 1))::BIGINT % 2 = 0 THEN 1 ELSE -1 END)
           ::DOUBLE AS s
  FROM {name}_tokens GROUP BY 1, 2),
{name} AS MATERIALIZED (
  SELECT {key}, bucket,
         CASE WHEN s = 0 THEN 0.0 ELSE s / sqrt(sum(s * s) OVER (PARTITION BY {key})) END AS v
  FROM {name}_sums)"""


def windows(size: int = 400, overlap: int = 80) -> str:
    """Character windows of documents as a CTE (doc_id, chunk_no, text)."""
    step = size - overlap
    return f"""
starts AS (
  SELECT doc_id, text, unnest(generate_series(
           0, CAST(ceil(greatest(length(text) - {size}, 0) / {step}.0) AS BIGINT))) AS i
  FROM documents WHERE length(text) > 0),
pieces AS (SELECT doc_id, i, {strip(f'substr(text, i * {step} + 1, {size})')} AS text FROM starts),
chunks AS MATERIALIZED (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS chunk_no, text
  FROM pieces WHERE text <> '')"""
