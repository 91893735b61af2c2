"""Queries for chunking, retrieval, prompts and grounded answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.constants import PROMPTS, REFUSAL_SENTINEL
from ..operators import chunking as K
from ..operators import grounding as G
from ..operators.dense import build_cells
from ..operators.hybrid import edge_reorder
from . import sql as S
from .tables import Registry, documents, questions

R = Registry()
WINDOWS = [""]


def six(name: str):
    return F.round(F.col(name), 6).alias(name)


def chunks(spark, sf):
    return K.chunk_text(documents(spark, sf), separators=WINDOWS)


@R.add("chunk_text")
def chunk_text(spark, sf):
    return K.chunk_text(documents(spark, sf))


@R.add(
    "chunk_text_windows", f"WITH {S.windows()} SELECT doc_id, chunk_no, text FROM chunks"
)
def chunk_windows(spark, sf):
    return chunks(spark, sf)


@R.add(
    "chunk_metadata",
    f"""WITH {S.windows()} SELECT doc_id, chunk_no, text,
          printf('CHUNK-%02d', chunk_no) AS chunk_id,
          doc_id || ':' || printf('CHUNK-%02d', chunk_no) AS source_id,
          length(text) AS char_length, {S.word_count('text')} AS token_estimate FROM chunks""",
)
def chunk_metadata(spark, sf):
    return K.chunk_metadata(chunks(spark, sf))


@R.add(
    "chunk_summary",
    f"""WITH {S.windows()} SELECT 400::BIGINT AS chunk_size, 80::BIGINT AS chunk_overlap, count(*) AS n_chunks,
          round(avg(length(text)), 1) AS mean_chars FROM chunks""",
)
def chunk_summary(spark, sf):
    return K.chunk_summary(chunks(spark, sf), 400, 80)


SWEEP = " UNION ALL ".join(
    f"""SELECT * FROM (WITH {S.windows(size, size // 5)}
        SELECT {size}::BIGINT AS chunk_size, {size // 5}::BIGINT AS chunk_overlap, count(*) AS n_chunks,
               round(avg({S.word_count('text')}), 1) AS mean_words FROM chunks)"""
    for size in (100, 400, 1200)
)


@R.add("chunk_size_sweep", SWEEP)
def chunk_size_sweep(spark, sf):
    return K.chunk_size_sweep(documents(spark, sf), separators=WINDOWS)


@R.add("chunk_size_sweep_recursive")
def chunk_size_sweep_recursive(spark, sf):
    return K.chunk_size_sweep(documents(spark, sf))


@R.add(
    "chunk_audit",
    f"""WITH {S.windows()} SELECT count(*) AS n_chunks,
          count(*) FILTER ({S.strip('text')} = '') AS n_empty,
          count(*) FILTER (length(text) > 400) AS n_too_long, 0::BIGINT AS n_without_id,
          count(*) AS n_indexed, count(*) >= 5 AS has_enough, true AS is_in_sync FROM chunks""",
)
def chunk_audit(spark, sf):
    index = G.build_chunk_index(documents(spark, sf), separators=WINDOWS)
    return K.chunk_audit(K.chunk_metadata(chunks(spark, sf)), index, 400)


# ---------------------------------------------------------------- retrieval

RETRIEVED = f"""WITH {S.windows()},
  numbered AS MATERIALIZED (
    SELECT *, doc_id || ':' || printf('CHUNK-%02d', chunk_no) AS source_id FROM chunks),
  {S.hashed('cv', 'SELECT source_id, text FROM numbered', 'source_id')},
  {S.hashed('qv', 'SELECT item_id AS query_id, text FROM benchmark', 'query_id')},
  dots AS (SELECT query_id, source_id, sum(q.v * c.v) AS score
           FROM qv q JOIN cv c USING (bucket) GROUP BY 1, 2),
  placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY query_id
              ORDER BY round(score, 9) DESC, source_id) AS rank FROM dots),
  hits AS MATERIALIZED (
    SELECT query_id, rank, source_id, doc_id, chunk_no, text, score
    FROM placed JOIN numbered USING (source_id) WHERE rank <= 15)"""


def retrieval(spark, sf, top):
    docs, asked = documents(spark, sf), questions(spark, sf)
    index = G.build_chunk_index(docs, separators=WINDOWS)
    return G.retrieve_chunks(index, asked, top), asked


def asked_queries(spark, sf, top=3, threshold=0.25, wording="short"):
    hits, asked = retrieval(spark, sf, top)
    return G.ask(hits, asked, threshold, wording=wording)


def answers(spark, sf, top=3, threshold=0.25, **options):
    docs, asked = documents(spark, sf), questions(spark, sf)
    index = G.build_chunk_index(docs, separators=WINDOWS)
    return G.rag_answers(index, asked, top, threshold, **options)


@R.add(
    "retrieve_chunks",
    f"""{RETRIEVED} SELECT query_id, rank, source_id, doc_id, chunk_no, text,
          round(score, 6) AS similarity_score FROM hits WHERE rank <= 3""",
)
def retrieve_chunks(spark, sf):
    hits, _ = retrieval(spark, sf, 3)
    return hits.select(
        "query_id", "rank", "source_id", "doc_id", "chunk_no", "text", six("similarity_score")
    )


@R.add(
    "retrieve_chunks_by_cell",
    f"""{RETRIEVED} SELECT query_id, rank, source_id, doc_id, chunk_no, text,
          round(score, 6) AS similarity_score FROM hits WHERE rank <= 3""",
)
def retrieve_chunks_by_cell(spark, sf):
    """Texts by a stored cell index of the chunks; all cells probed, so the rows are the scan's."""
    chunks = G.build_chunk_index(documents(spark, sf), separators=WINDOWS)
    index = build_cells(chunks, corpus_id="source_id")
    hits = G.retrieve_chunks(index, questions(spark, sf), 3, n_probe=len(index.centres))
    return hits.select(
        "query_id", "rank", "source_id", "doc_id", "chunk_no", "text", six("similarity_score")
    )


CONTEXT = """string_agg('--- SOURCE [' || source_id || '] (Score: ' || printf('%.4f', score)
    || ') ---' || chr(10) || text, chr(10) || chr(10) ORDER BY {order})"""


@R.add(
    "build_context",
    f"""{RETRIEVED} SELECT query_id, {CONTEXT.format(order='rank')} AS context
        FROM hits WHERE rank <= 3 GROUP BY 1""",
)
def build_context(spark, sf):
    return asked_queries(spark, sf).select("query_id", G.build_context().alias("context"))


def prompt_sql(wording: str) -> str:
    before, between, after = (S.text_literal(p) for p in PROMPTS[wording])
    return f"""{RETRIEVED}, c AS (
          SELECT query_id, {CONTEXT.format(order='rank')} AS context
          FROM hits WHERE rank <= 3 GROUP BY 1)
        SELECT query_id, {before} || context || {between} || b.text || {after} AS prompt
        FROM c JOIN benchmark b ON b.item_id = query_id"""


@R.add("build_prompt", prompt_sql("short"))
def build_prompt(spark, sf):
    return asked_queries(spark, sf).select("query_id", F.col("formatted_prompt").alias("prompt"))


@R.add("build_prompt_long", prompt_sql("long"))
def build_prompt_long(spark, sf):
    asked = asked_queries(spark, sf, wording="long")
    return asked.select("query_id", F.col("formatted_prompt").alias("prompt"))


@R.add(
    "guardrail",
    f"""{RETRIEVED}, t AS (SELECT query_id, max(score) AS s FROM hits GROUP BY 1)
        SELECT b.item_id AS query_id, round(coalesce(s, 0.0), 6) AS max_score,
          round(coalesce(s, 0.0), 9) < 0.6 AS is_refused
        FROM benchmark b LEFT JOIN t ON t.query_id = b.item_id""",
)
def guardrail(spark, sf):
    asked = asked_queries(spark, sf, threshold=0.6)
    return asked.select("query_id", six("max_score"), "is_refused")


def answer_sql(depth: str = "3") -> str:
    """CTE from hits to one extractive answer per query."""
    return f"""
  terms AS (SELECT item_id AS query_id, text AS query, list_filter({S.words('text')},
              lambda x: x NOT IN ({S.ASKING})) AS terms FROM benchmark),
  cut AS (SELECT query_id, rank, source_id, terms, unnest({S.sentences('text')}) AS sentence,
                 generate_subscripts({S.sentences('text')}, 1) AS i
          FROM hits JOIN terms USING (query_id) WHERE rank <= {depth}),
  fitting AS (SELECT *, sentence || ' [' || source_id || ']' AS entry,
                row_number() OVER (PARTITION BY query_id ORDER BY rank, i) AS n
              FROM cut WHERE len(list_intersect(terms, {S.words('sentence')})) > 0),
  firsts AS (SELECT query_id, entry, min(n) AS n FROM fitting WHERE n <= 3 GROUP BY 1, 2),
  bodies AS (SELECT query_id, string_agg(entry, ' ' ORDER BY n) AS body FROM firsts GROUP BY 1),
  extracted AS (SELECT query_id, coalesce(body, {S.quote(REFUSAL_SENTINEL)}) AS answer
                FROM terms LEFT JOIN bodies USING (query_id))"""


@R.add(
    "extractive_answer",
    f"{RETRIEVED}, {answer_sql()} SELECT query_id, answer FROM extracted",
)
def extractive_answer(spark, sf):
    return asked_queries(spark, sf).select("query_id", G.extractive_answer().alias("answer"))


ANSWERS = f"""{RETRIEVED}, {answer_sql()},
  tops AS (SELECT query_id, max(score) AS s,
             string_agg(source_id, ' ' ORDER BY rank) AS sources,
             {CONTEXT.format(order='rank')} AS context
           FROM hits WHERE rank <= 3 GROUP BY 1),
  answered AS (
    SELECT query_id, query, coalesce(sources, '') AS sources, coalesce(s, 0.0) AS s,
      {S.text_literal(PROMPTS['short'][0])} || coalesce(context, '') ||
      {S.text_literal(PROMPTS['short'][1])} || query || {S.text_literal(PROMPTS['short'][2])}
        AS formatted_prompt,
      round(coalesce(s, 0.0), 9) < 0.6 AS refused,
      CASE WHEN round(coalesce(s, 0.0), 9) < 0.6 THEN {S.quote(REFUSAL_SENTINEL)}
           ELSE answer END AS answer
    FROM extracted JOIN terms USING (query_id) LEFT JOIN tops USING (query_id))"""


@R.add(
    "rag_answers",
    f"""{ANSWERS} SELECT query_id, query, answer, sources, formatted_prompt,
          round(s, 6) AS max_score,
          CASE WHEN refused THEN 'GUARDRAIL_REFUSAL' ELSE 'SUCCESS' END AS status,
          'extractive' AS model_used FROM answered""",
)
def rag_answers(spark, sf):
    return answers(spark, sf, threshold=0.6).select(
        "query_id",
        "query",
        "answer",
        F.array_join(F.transform("retrieved_chunks", lambda c: c["source_id"]), " ").alias(
            "sources"
        ),
        "formatted_prompt",
        six("max_score"),
        "generation.status",
        "generation.model_used",
    )


def echo_generator():
    """A plug-in generator that answers with the first source, or fails on short questions."""

    def generate(prompt: str, query: str) -> str:
        if len(query) < 80:
            raise G.GeneratorApiError("question too short", 400)
        if len(query) < 120:
            raise TimeoutError("no reply")
        return " " + prompt[prompt.index("[") : prompt.index("]") + 1] + " "

    return generate


@R.add(
    "generate_answers",
    f"""{ANSWERS}, g AS (SELECT query_id, CASE WHEN refused THEN 'GUARDRAIL_REFUSAL'
            WHEN length(query) < 80 THEN 'API_ERROR' WHEN length(query) < 120
            THEN 'CONNECTION_ERROR' ELSE 'SUCCESS' END AS status, sources FROM answered)
        SELECT query_id, status, 'echo' AS model_used, CASE status
          WHEN 'GUARDRAIL_REFUSAL' THEN {S.quote(REFUSAL_SENTINEL)}
          WHEN 'API_ERROR' THEN '[API Error]: question too short (Status code: 400)'
          WHEN 'CONNECTION_ERROR' THEN '[Connection Error]: no reply'
          ELSE '[' || split_part(sources, ' ', 1) || ']' END AS answer FROM g""",
)
def generate_answers(spark, sf):
    given = answers(spark, sf, threshold=0.6, load=echo_generator, model="echo")
    return given.select("query_id", "generation.status", "generation.model_used", "answer")


@R.add(
    "topk_sweep",
    f"{RETRIEVED}"
    + "".join(f", x{k} AS (WITH x AS (SELECT 1), {answer_sql(str(k))} SELECT {k}::BIGINT AS k, "
              "query_id, answer FROM extracted)" for k in (1, 2, 5))
    + ", every AS (SELECT * FROM x1 UNION ALL SELECT * FROM x2 UNION ALL SELECT * FROM x5) "
    """SELECT e.query_id, e.k, e.answer, count(h.rank) AS n_retrieved,
         coalesce(bool_or(contains(h.text, b.text)), false) AS has_evidence
       FROM every e JOIN benchmark b ON b.item_id = e.query_id
       LEFT JOIN hits h ON h.query_id = e.query_id AND h.rank <= e.k GROUP BY 1, 2, 3""",
)
def topk_sweep(spark, sf):
    return G.topk_sweep(asked_queries(spark, sf, top=5), (1, 2, 5), F.col("query"))


RULE = "The reading room closes at noon on Fridays."


@R.add(
    "inject_at_rank",
    f"""{RETRIEVED}, p AS (SELECT unnest([1, 8])::BIGINT AS position),
        t AS (SELECT query_id, position, rank, CASE WHEN rank = position
                THEN '[STUDENT-INJECTED SECRET RULE - RANK ' || position || ']' || chr(10) ||
                     {S.quote(RULE)} || chr(10) || chr(10) || text ELSE text END AS text
              FROM hits, p WHERE rank <= 15)
        SELECT query_id, position, max(rank) >= position AS is_injected,
          md5(string_agg(text, '|' ORDER BY rank)) AS digest FROM t GROUP BY 1, 2""",
)
def inject_at_rank(spark, sf):
    trials = G.inject_at_rank(asked_queries(spark, sf, top=15), RULE)
    texts = F.array_join(F.transform("retrieved", lambda c: c["text"]), "|")
    return trials.select("query_id", "position", "is_injected", F.md5(texts).alias("digest"))


@R.add(
    "rag_report",
    f"""{ANSWERS} SELECT CASE WHEN refused THEN 'GUARDRAIL_REFUSAL' ELSE 'SUCCESS' END AS status,
          count(*) AS n_answers FROM answered GROUP BY 1""",
)
def rag_report(spark, sf):
    return G.rag_report(answers(spark, sf, threshold=0.6)).select("status", "n_answers")


@R.add(
    "source_rows",
    f"""{RETRIEVED} SELECT query_id, rank, source_id, printf('%.4f', score) AS cosine_score,
          substr(text, 1, 110) || '...' AS excerpt FROM hits WHERE rank <= 3""",
)
def source_rows(spark, sf):
    return G.source_rows(answers(spark, sf))


AUDIT = rf"""{ANSWERS}, a AS (SELECT query_id, answer, string_split(sources, ' ') AS retrieved,
    list_distinct(regexp_extract_all(answer, '\[([^\]]+)\]', 1)) AS cited FROM answered),
  audit AS (SELECT query_id, array_to_string(list_sort(cited), ' ') AS cited,
      len(list_filter(cited, lambda c: NOT list_contains(retrieved, c))) = 0 AS is_supported,
      answer = {S.quote(REFUSAL_SENTINEL)} AS is_refusal FROM a)"""


@R.add(
    "citation_audit",
    f"{AUDIT} SELECT query_id, 'extractive' AS model_used, cited, is_supported, is_refusal "
    "FROM audit",
)
def citation_audit(spark, sf):
    audit = G.citation_audit(answers(spark, sf, threshold=0.6))
    return audit.select(
        "query_id",
        "model_used",
        F.array_join(F.sort_array("cited"), " ").alias("cited"),
        "is_supported",
        "is_refusal",
    )


@R.add(
    "citation_rates",
    f"""{AUDIT} SELECT 'extractive' AS model_used, count(*) AS n_answers,
          round(avg(is_supported::INT), 4) AS supported_rate,
          round(avg(is_refusal::INT), 4) AS refusal_rate FROM audit""",
)
def citation_rates(spark, sf):
    return G.citation_rates(G.citation_audit(answers(spark, sf, threshold=0.6)))


@R.add(
    "edge_reorder_context",
    f"""{RETRIEVED} SELECT query_id, {CONTEXT.format(
        order='CASE WHEN rank % 2 = 1 THEN rank ELSE 1000 - rank END')} AS context
        FROM hits WHERE rank <= 5 GROUP BY 1""",
)
def edge_reorder_context(spark, sf):
    placed = edge_reorder(asked_queries(spark, sf, top=5))
    return placed.select("query_id", G.build_context().alias("context"))
