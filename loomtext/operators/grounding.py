"""Retrieval of chunks, prompts, guardrail, answers with citations, reports."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import (
    CHUNK_OVERLAP,
    CHUNK_SEPARATORS,
    CHUNK_SIZE,
    GUARDRAIL_THRESHOLD,
    PROMPTS,
    REFUSAL_SENTINEL,
    STATUS_API_ERROR,
    STATUS_CONNECTION_ERROR,
    STATUS_REFUSAL,
    STATUS_SUCCESS,
)
from ..functions.text import excerpt, let, query_terms, split_sentences, word_overlap
from .chunking import chunk_metadata, chunk_text
from .dense import DIM, CellIndex, embed_text, search_cells, vector_topk
from .scale import BROADCAST_ROWS, within_bound, written

Generator = Callable[[str, str], str]


class GeneratorApiError(Exception):
    """Raised by a generator plug-in when its service answered with an error."""

    def __init__(self, message: str, status_code: int | None = None):
        super().__init__(message)
        self.status_code = status_code


# ---------------------------------------------------------------- index and retrieval


def build_chunk_index(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: Sequence[str] = CHUNK_SEPARATORS,
    dim: int = DIM,
    encode: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Chunks with ids and embeddings, written once to the shared folder and read back.

    ``encode`` may add another ``embedding`` column from ``text``; the default hashes words.
    """
    chunks = chunk_metadata(chunk_text(docs, id_col, text_col, size, overlap, separators), id_col)
    return written(encode(chunks) if encode else embed_text(chunks, dim=dim), "chunks")


def retrieve_chunks(
    index: DataFrame | CellIndex,
    queries: DataFrame,
    top: int = 3,
    query_id: str = "query_id",
    query_text: str = "text",
    dim: int = DIM,
    encode: Callable[[DataFrame], DataFrame] | None = None,
    key: str = "source_id",
    n_probe: int | None = None,
) -> DataFrame:
    """Best chunks per query by inner product: ids travel through the ranking, text joins last.

    A chunk index that ``build_cells`` stored is searched in each query's ``n_probe`` nearest
    cells, and vectors and texts of those cells alone are read.
    """
    asked = queries.select(query_id, F.col(query_text).alias("text"))
    vectors = encode(asked) if encode else embed_text(asked, dim=dim)
    if isinstance(index, CellIndex):
        columns = [c for c in index.rows.columns if c not in ("embedding", "_cell", key)]
        return search_cells(index, vectors, top, n_probe, query_id, key, "embedding", columns)
    hits = vector_topk(vectors, index, top, query_id, key, "embedding")
    few = within_bound(asked, max_rows=BROADCAST_ROWS // max(top, 1))
    side = F.broadcast(hits) if few else hits
    return index.drop("embedding").join(side, key)


def attach_queries(
    hits: DataFrame, queries: DataFrame, query_id: str = "query_id", query_text: str = "text"
) -> DataFrame:
    """Every query with its ranked chunks as one array (empty if it has none), <= k each."""
    entry = F.struct(
        "rank",
        F.col("source_id"),
        F.col("text"),
        F.col("similarity_score"),
    )
    grouped = hits.groupBy(query_id).agg(F.sort_array(F.collect_list(entry)).alias("retrieved"))
    none = F.array().cast(grouped.schema["retrieved"].dataType)
    return (
        queries.select(query_id, F.col(query_text).alias("query"))
        .join(grouped, query_id, "left")
        .withColumn("retrieved", F.coalesce("retrieved", none))
    )


# ---------------------------------------------------------------- prompts and guardrail


def build_context(retrieved: Column | str = "retrieved") -> Column:
    """Ranked sources under their headers, with blank lines between."""
    chunks = F.col(retrieved) if isinstance(retrieved, str) else retrieved

    def block(c: Column) -> Column:
        score = F.format_string("%.4f", c["similarity_score"])
        head = F.concat(F.lit("--- SOURCE ["), c["source_id"], F.lit("] (Score: "), score)
        return F.concat(head, F.lit(") ---\n"), c["text"])

    return F.array_join(F.transform(chunks, block), "\n\n")


def build_prompt(
    context: Column | str = "context", query: Column | str = "query", wording: str = "short"
) -> Column:
    """Role, grounding and refusal rules, context, question. Plain joining, so that text which
    looks like a placeholder stays as it is."""
    before, between, after = PROMPTS[wording]
    c = F.col(context) if isinstance(context, str) else context
    q = F.col(query) if isinstance(query, str) else query
    return F.concat(F.lit(before), c, F.lit(between), q, F.lit(after))


def top_score(retrieved: Column | str = "retrieved") -> Column:
    """Best score, 0 if nothing was retrieved; a missing score counts as 0."""
    chunks = F.col(retrieved) if isinstance(retrieved, str) else retrieved
    scores = F.transform(chunks, lambda c: F.coalesce(c["similarity_score"], F.lit(0.0)))
    return F.coalesce(F.array_max(scores), F.lit(0.0))


def guardrail(
    asked: DataFrame, threshold: float = GUARDRAIL_THRESHOLD, enforce: bool = True
) -> DataFrame:
    """Add max_score and is_refused: nothing similar enough was retrieved."""
    scored = asked.withColumn("max_score", top_score("retrieved"))
    refused = F.lit(enforce) & (F.round("max_score", 9) < threshold)
    return scored.withColumn("is_refused", refused)


# ---------------------------------------------------------------- answers


def extractive_answer(
    query: Column | str = "query",
    retrieved: Column | str = "retrieved",
    n_sentences: int = 3,
    refusal: str = REFUSAL_SENTINEL,
) -> Column:
    """The first sentences, in rank order, that share a word with the query, each with its source.

    Three are taken before repeats are dropped; without any the answer is the refusal.
    """
    chunks = F.col(retrieved) if isinstance(retrieved, str) else retrieved

    def answer(terms: Column) -> Column:
        def cited(c: Column) -> Column:
            fitting = F.filter(
                split_sentences(c["text"]), lambda s: F.size(word_overlap(terms, s)) > 0
            )
            return F.transform(
                fitting, lambda s: F.concat(s, F.lit(" ["), c["source_id"], F.lit("]"))
            )

        first = F.slice(F.flatten(F.transform(chunks, cited)), 1, n_sentences)
        body = F.array_join(F.array_distinct(first), " ")
        return F.when(body == "", F.lit(refusal)).otherwise(body)

    return let(query_terms(query), answer)


def extractive_answers(asked: DataFrame, model: str = "extractive") -> DataFrame:
    """Answer, status, latency and model of guarded queries, all in expressions."""
    refused = F.col("is_refused")
    return asked.select(
        "*",
        F.when(refused, REFUSAL_SENTINEL).otherwise(extractive_answer()).alias("answer"),
        F.when(refused, STATUS_REFUSAL).otherwise(STATUS_SUCCESS).alias("status"),
        F.lit(0.0).alias("latency_ms"),
        F.lit(model).alias("model_used"),
    )


def generate_answers(
    asked: DataFrame,
    load: Callable[[], Generator],
    model: str,
    prompt: str = "formatted_prompt",
    query: str = "query",
) -> DataFrame:
    """Answers of a plug-in generator(prompt, query), loaded once per task.

    Refused rows never reach the generator. A failing load or call becomes a status of its row,
    never a failing task; the next row tries to load again.
    """
    schema = T.StructType(
        [
            *asked.schema.fields,
            T.StructField("answer", T.StringType()),
            T.StructField("status", T.StringType()),
            T.StructField("latency_ms", T.DoubleType()),
            T.StructField("model_used", T.StringType()),
        ]
    )

    def one(loaded: list[Generator], text: str, question: str) -> tuple[str, str]:
        try:
            if not loaded:
                loaded.append(load())
            return str(loaded[0](text, question)).strip(), STATUS_SUCCESS
        except GeneratorApiError as error:
            return f"[API Error]: {error} (Status code: {error.status_code})", STATUS_API_ERROR
        except Exception as error:
            return f"[Connection Error]: {error}", STATUS_CONNECTION_ERROR

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        loaded: list[Generator] = []
        for batch in batches:
            rows = []
            for text, question, refused in zip(batch[prompt], batch[query], batch["is_refused"]):
                if refused:
                    rows.append((REFUSAL_SENTINEL, STATUS_REFUSAL, 0.0, model))
                    continue
                started = time.perf_counter()
                answer, status = one(loaded, text, question)
                spent = round((time.perf_counter() - started) * 1000.0, 2)
                rows.append((answer, status, spent, model))
            columns = ["answer", "status", "latency_ms", "model_used"]
            yield pd.concat(
                [batch.reset_index(drop=True), pd.DataFrame(rows, columns=columns)], axis=1
            )

    return asked.mapInPandas(run, schema)


def ask(
    hits: DataFrame,
    queries: DataFrame,
    threshold: float = GUARDRAIL_THRESHOLD,
    enforce: bool = True,
    wording: str = "short",
    query_id: str = "query_id",
    query_text: str = "text",
) -> DataFrame:
    """Queries with their chunks, prompt and guardrail decision."""
    asked = attach_queries(hits, queries, query_id, query_text)
    prompted = asked.withColumn("formatted_prompt", build_prompt(build_context(), "query", wording))
    return guardrail(prompted, threshold, enforce)


def rag_answers(
    index: DataFrame | CellIndex,
    queries: DataFrame,
    top: int = 3,
    threshold: float = GUARDRAIL_THRESHOLD,
    enforce: bool = True,
    wording: str = "short",
    load: Callable[[], Generator] | None = None,
    model: str = "extractive",
    query_id: str = "query_id",
    query_text: str = "text",
    **retrieval,
) -> DataFrame:
    """Retrieve, prompt, guard, answer: one row per query with its sources."""
    hits = retrieve_chunks(index, queries, top, query_id, query_text, **retrieval)
    asked = ask(hits, queries, threshold, enforce, wording, query_id, query_text)
    answered = generate_answers(asked, load, model) if load else extractive_answers(asked, model)
    return answered.select(
        query_id,
        "query",
        "answer",
        F.struct("status", "latency_ms", "model_used").alias("generation"),
        F.col("retrieved").alias("retrieved_chunks"),
        "formatted_prompt",
        "max_score",
    )


# ---------------------------------------------------------------- experiments on retrieved chunks


def topk_sweep(
    asked: DataFrame, depths: Sequence[int], evidence: Column, query_id: str = "query_id"
) -> DataFrame:
    """Cut one retrieval at several depths: is the evidence there, and what is the answer."""
    cuts = asked.withColumn("k", F.explode(F.array(*[F.lit(k) for k in depths])))
    cut = cuts.withColumn("retrieved", F.slice("retrieved", F.lit(1), F.col("k")))
    return cut.select(
        query_id,
        "k",
        F.size("retrieved").alias("n_retrieved"),
        F.exists(
            "retrieved", lambda c: F.coalesce(F.contains(c["text"], evidence), F.lit(False))
        ).alias("has_evidence"),
        extractive_answer().alias("answer"),
    )


def inject_at_rank(
    asked: DataFrame, rule: str, positions: Sequence[int] = (1, 8), query_id: str = "query_id"
) -> DataFrame:
    """Put a marked rule before the text of the chunk at each position, in the prompt only.

    A query with fewer chunks is reported with ``is_injected`` false.
    """
    trials = asked.withColumn("position", F.explode(F.array(*[F.lit(p) for p in positions])))
    mark = F.concat(
        F.lit("[STUDENT-INJECTED SECRET RULE - RANK "),
        F.col("position").cast("string"),
        F.lit("]\n" + rule + "\n\n"),
    )
    changed = F.transform(
        "retrieved",
        lambda c: c.withField(
            "text",
            F.when(c["rank"] == F.col("position"), F.concat(mark, c["text"])).otherwise(c["text"]),
        ),
    )
    return trials.withColumn("retrieved", changed).withColumn(
        "is_injected", F.size("retrieved") >= F.col("position")
    )


# ---------------------------------------------------------------- reports


def rag_report(answers: DataFrame) -> DataFrame:
    """Answers and mean latency by status."""
    return answers.groupBy("generation.status").agg(
        F.count(F.lit(1)).alias("n_answers"),
        F.round(F.avg("generation.latency_ms"), 2).alias("mean_latency_ms"),
    )


def source_rows(answers: DataFrame, query_id: str = "query_id") -> DataFrame:
    """One display row per retrieved source, with a short excerpt."""
    return answers.select(query_id, F.inline("retrieved_chunks")).select(
        query_id,
        "rank",
        "source_id",
        F.format_string("%.4f", "similarity_score").alias("cosine_score"),
        excerpt("text").alias("excerpt"),
    )


def citation_audit(answers: DataFrame, query_id: str = "query_id") -> DataFrame:
    """Cited sources of every answer, which of them were not retrieved, and refusals."""
    retrieved = F.transform("retrieved_chunks", lambda c: c["source_id"])
    cited = F.array_distinct(F.regexp_extract_all("answer", F.lit(r"\[([^\]]+)\]")))
    return answers.select(
        query_id,
        F.col("generation.model_used").alias("model_used"),
        cited.alias("cited"),
        F.array_except(cited, retrieved).alias("unsupported"),
        (F.size(F.array_except(cited, retrieved)) == 0).alias("is_supported"),
        (F.col("answer") == REFUSAL_SENTINEL).alias("is_refusal"),
    )


def citation_rates(audit: DataFrame) -> DataFrame:
    """Rates per model over an audit."""
    return audit.groupBy("model_used").agg(
        F.count(F.lit(1)).alias("n_answers"),
        F.round(F.avg(F.col("is_supported").cast("int")), 4).alias("supported_rate"),
        F.round(F.avg(F.col("is_refusal").cast("int")), 4).alias("refusal_rate"),
    )
