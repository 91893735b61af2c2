"""BM25, rank fusion and context order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import run_lengths, tokenize_and_clean
from .lexical import LexicalModel, count_words
from .scale import BROADCAST_BYTES, dealt, lookup_join, top_k, within_bound, written
from .scoring import best_pairs, query_blocks


def bm25_topk(
    docs: DataFrame,
    queries: DataFrame,
    model: LexicalModel,
    top: int = 3,
    k1: float = 1.2,
    b: float = 0.75,
    doc_id: str = "doc_id",
    query_id: str = "query_id",
    text_col: str = "text",
    **options,
) -> DataFrame:
    """Best documents per query by BM25, summed over the distinct words of the query.

    Lengths and counts come from the document's own row and the mean length from the fitted
    vocabulary; only words that some query uses leave the scan. Those words are brought together by
    document before they meet the queries, block by block of a broadcast's size, so that scores are
    summed and cut to the best in place and no pair of query and document is shuffled.
    """
    tokens = docs.select(doc_id, tokenize_and_clean(text_col, **options).alias("_t"))
    mean_length = model.idf.agg((F.sum("cf") / model.n_docs).alias("a")).scalar()
    terms = tokens.select(
        doc_id,
        F.size("_t").alias("_length"),
        F.inline_outer(run_lengths(F.col("_t"), "term", "tf")),
    )
    bounded = within_bound(queries.select(query_id, text_col), max_bytes=BROADCAST_BYTES // 4)
    words = count_words(queries, query_id, text_col, **options).select(query_id, "term")
    side = F.broadcast(words) if bounded else words
    rarity = F.log(1 + (F.lit(float(model.n_docs)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    asked = model.idf.join(side, "term").select(query_id, "term", rarity.alias("_rarity"))
    asked = written(asked, "asked")
    bounded = within_bound(asked)
    used = lookup_join(
        terms,
        asked.select("term").distinct(),
        "term",
        doc_id,
        model.idf.select("term", F.col("df").alias("n_rows")),
        small_is_bounded=bounded,
        rows=model.n_postings,
    )
    damped = F.col("tf") + k1 * (1 - b + b * F.col("_length") / mean_length)
    hit = F.struct("term", (F.col("tf") * (k1 + 1) / damped).alias("doc_weight"))
    by_document = dealt(used, model.n_postings, doc_id).groupBy(doc_id)
    weights = by_document.agg(F.collect_list(hit).alias("hits"))  # at most the words of one text
    if not bounded:
        weights = written(weights, "okapi")
    vectors = asked.withColumnRenamed("_rarity", "weight")
    best = [
        best_pairs(weights, block, top, doc_id, query_id, "bm25_score")
        for block in query_blocks(vectors, bounded, query_id)
    ]
    return reduce(DataFrame.unionByName, best)


def rrf_fuse(
    rankings: list[DataFrame],
    top: int = 3,
    constant: int = 60,
    doc_id: str = "doc_id",
    query_id: str = "query_id",
) -> DataFrame:
    """Reciprocal rank fusion of several (query, doc, rank) lists."""
    merged = rankings[0].select(query_id, doc_id, "rank")
    for ranking in rankings[1:]:
        merged = merged.unionByName(ranking.select(query_id, doc_id, "rank"))
    fused = merged.groupBy(query_id, doc_id).agg(
        F.sum(1.0 / (constant + F.col("rank"))).alias("rrf_score"),
        F.count(F.lit(1)).alias("n_lists"),
    )
    return top_k(fused, query_id, "rrf_score", doc_id, top)


def edge_reorder(asked: DataFrame, retrieved: str = "retrieved") -> DataFrame:
    """Best chunks at both ends of the context: odd ranks ascending, then even ranks descending."""
    odd = F.filter(retrieved, lambda c: c["rank"] % 2 == 1)
    even = F.filter(retrieved, lambda c: c["rank"] % 2 == 0)
    return asked.withColumn(retrieved, F.concat(odd, F.reverse(even)))
