"""TF-IDF vector space and lexical search over postings.

Documents are (doc_id, text) rows with unique ids. A document's term counts are taken inside its
own row, so building postings needs no shuffle; the corpus statistics are one partial aggregate
per term; a search keeps, per document, one norm and the few weights that queries ask for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.constants import (
    FALLBACK_ACTIONS,
    FALLBACK_MESSAGE,
    FALLBACK_THRESHOLD,
    NO_NOTE,
    SEARCH_THRESHOLD,
    SEARCH_TOP_K,
    STATUS_FALLBACK,
    STATUS_SUCCESS,
)
from ..functions.text import let, ngrams, run_lengths, tokenize_and_clean
from .scale import (
    BROADCAST_BYTES,
    BROADCAST_ROWS,
    dealt,
    dealt_in_line,
    lookup_join,
    ordered_number,
    salted_join,
    top_k,
    within_bound,
    written_in_parts,
)
from .scoring import best_pairs, query_blocks


# Folders of a stored index; more would mean small files, fewer more to read for a few words.
TERM_BUCKETS = 256

# Documents of a stored index go through its shuffles in slices of about so many postings, or of so
# many times the words of the vocabulary, which every slice meets whole.
SLICE_ROWS, SLICE_WORDS = 8_000_000, 4

# Blocks of queries that one job ranks; the hits of more are written job by job.
BLOCKS_AT_ONCE = 4


def term_counts(df: DataFrame, id_col: str, tokens: Column) -> DataFrame:
    """(id, term, tf): counts taken inside each row, no shuffle."""
    # The outer form keeps Catalyst from adding a second evaluation of the tokeniser as a filter.
    exploded = df.select(id_col, F.inline_outer(run_lengths(tokens, "term", "tf")))
    return exploded.filter(F.col("tf").isNotNull())


def count_words(df: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    return term_counts(df, id_col, tokenize_and_clean(text_col, **options))


def fit_idf(counts: DataFrame, n_docs: int) -> DataFrame:
    """(term, df, cf, idf): documents and occurrences of a term, and idf = ln((1+N)/(1+df)) + 1.

    Expects one row per (document, term); rows of a frequent term are folded before the shuffle.
    """
    smooth = F.log(F.lit(1.0 + n_docs) / (F.col("df") + 1)) + 1
    sizes = counts.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").cast("long").alias("cf")
    )
    return sizes.withColumn("idf", smooth)


@dataclass(frozen=True)
class LexicalModel:
    """Fitted corpus statistics: a written (term, df, cf, idf) table, the corpus size and the number
    of its (document, term) pairs, which sizes shuffles (0: not known)."""

    idf: DataFrame
    n_docs: int
    bounded: bool
    n_postings: int = 0


def fit_lexical(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> LexicalModel:
    """Fit the vocabulary once; like an ML fit, this runs a job and writes a small table."""
    n_docs = docs.count()
    fitted = fit_idf(count_words(docs, id_col, text_col, **options), n_docs)
    idf = written_in_parts([fitted], "idf")
    n_postings = idf.agg(F.sum("df")).first()[0] or 0
    return LexicalModel(idf, n_docs, within_bound(idf), n_postings)


def _weigh(counts: DataFrame, model: LexicalModel, id_col: str) -> DataFrame:
    """Raw tf * idf weights; terms outside the vocabulary drop out."""
    known = lookup_join(
        counts,
        model.idf,
        "term",
        id_col,
        weights=model.idf.select("term", F.col("df").alias("n_rows")),
        small_is_bounded=model.bounded,
        rows=model.n_postings,
    )
    return known.withColumn("weight", F.col("tf") * F.col("idf"))


def _unit(weighted: DataFrame, id_col: str) -> DataFrame:
    # The window holds one text's vocabulary at a time.
    squares = F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(id_col))
    return weighted.withColumn("weight", F.col("weight") / F.sqrt(squares))


def tfidf_docs(counts: DataFrame, model: LexicalModel, id_col: str = "doc_id") -> DataFrame:
    """Unit-length postings (id, term, weight)."""
    weighted = dealt(_weigh(counts, model, id_col), model.n_postings, id_col)
    return _unit(weighted, id_col).select(id_col, "term", "weight")


def tfidf_query(
    counts: DataFrame, model: LexicalModel, id_col: str = "query_id", queries_bounded: bool = True
) -> DataFrame:
    """Unit-length query vectors under the fitted idf; a query of unknown words has no rows.

    A bounded query side is broadcast against the vocabulary, which may be of any size.
    """
    if queries_bounded:
        known = model.idf.join(F.broadcast(counts), "term").withColumn(
            "weight", F.col("tf") * F.col("idf")
        )
    else:
        known = _weigh(counts, model, id_col)
    return _unit(known, id_col).select(id_col, "term", "weight")


def query_vectors(
    queries: DataFrame,
    model: LexicalModel,
    id_col: str = "query_id",
    text_col: str = "text",
    **options,
) -> tuple[DataFrame, bool]:
    """Query vectors, and whether they were measured small enough to broadcast.

    They are written once, as scoring and explaining read them several times.
    """
    texts = queries.select(id_col, text_col)
    bounded = within_bound(texts, max_bytes=BROADCAST_BYTES // 4)  # words outweigh their text
    counts = count_words(queries, id_col, text_col, **options)
    vectors = written_in_parts([tfidf_query(counts, model, id_col, bounded)], "vectors")
    return vectors, within_bound(vectors)


def vector_space_summary(idf: DataFrame, n_docs: int) -> DataFrame:
    """N, V, non-zeros and sparsity; all of them follow from the vocabulary table."""
    cells = F.col("n_docs").cast("double") * F.col("vocabulary_size")
    totals = idf.agg(
        F.lit(n_docs).cast("long").alias("n_docs"),
        F.count(F.lit(1)).alias("vocabulary_size"),
        F.sum("df").alias("non_zero"),
    )
    density = F.round(F.col("non_zero") / cells * 100, 4)
    return totals.select(
        "*",
        cells.alias("total_cells"),
        density.alias("density_pct"),
        F.round((1 - F.col("non_zero") / cells) * 100, 4).alias("sparsity_pct"),
    )


def vocabulary_index(idf: DataFrame) -> DataFrame:
    """Every term with its 0-based alphabetical index."""
    numbered = ordered_number(idf, "term", "_number")
    return numbered.withColumn("term_index", F.col("_number") - 1).drop("_number")


def vocabulary_sample(idf: DataFrame, n: int = 10) -> DataFrame:
    """The first n dictionary entries with their alphabetical index."""
    first = idf.select("term", "df").orderBy("term").limit(n)
    index = F.row_number().over(Window.orderBy("term")) - 1  # n rows
    return first.withColumn("term_index", index)


def query_term_weights(vectors: DataFrame, n: int = 12, id_col: str = "query_id") -> DataFrame:
    """The heaviest terms of each query."""
    return top_k(vectors, id_col, "weight", "term", n)


def doc_term_matrix(
    postings: DataFrame, docs: DataFrame, terms: Sequence[str], id_col: str = "doc_id"
) -> DataFrame:
    """Dense sub-matrix: chosen documents by chosen terms, 0 where absent."""
    wanted = postings.filter(F.col("term").isin(*terms))
    wide = wanted.groupBy(id_col).pivot("term", list(terms)).agg(F.first("weight"))
    return docs.select(id_col).join(wide, id_col, "left").na.fill(0.0, subset=list(terms))


def asked_weights(
    doc_counts: DataFrame,
    vectors: DataFrame,
    model: LexicalModel,
    vectors_bounded: bool = True,
    doc_id: str = "doc_id",
) -> DataFrame:
    """(id, hits): per document the unit weights of those terms that some query uses.

    One pass over the documents gives both the norm, which needs every term, and the few weights
    that a search needs; nothing else leaves the scan.
    """
    weights = _weigh(doc_counts, _flag_query_terms(model, vectors, vectors_bounded), doc_id)
    hit = F.when(F.col("_asked"), F.struct("term", F.col("weight").alias("doc_weight")))
    reduced = dealt(weights, model.n_postings, doc_id).groupBy(doc_id).agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("_norm"),
        F.collect_list(hit).alias("_hits"),  # at most the words of one text
    )

    def unit(h: Column) -> Column:
        weight = h["doc_weight"] / F.col("_norm")
        return F.struct(h["term"].alias("term"), weight.alias("doc_weight"))

    return reduced.select(doc_id, F.transform("_hits", unit).alias("hits"))


def store_postings(
    docs: DataFrame,
    model: LexicalModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    **options,
) -> DataFrame:
    """Unit postings of a corpus, written once for many searches: (id, term, weight, slice, bucket).

    Terms are dealt to buckets by a hash, a folder each, so a search reads only the buckets of its
    words. The vocabulary tells the rows of each bucket, so tasks get neighbouring buckets of a
    bounded number of rows together, which leaves few files in a folder and cuts the bucket of a
    word that fills a third of the corpus among several tasks. Documents go in slices by a hash of
    their id, each with folders of its own, so the disk holds the shuffles of one slice at a time.
    """
    counted = model.idf.groupBy(_bucket("term")).agg(F.sum("df"), F.count(F.lit(1))).collect()
    rows = {b: n for b, n, _ in counted}  # at most TERM_BUCKETS
    n = _slices(sum(rows.values()), sum(words for *_, words in counted))
    sizes = [math.ceil(rows.get(b, 0) / n) for b in range(TERM_BUCKETS)]
    share = _share(model, n)

    def postings(i: int) -> DataFrame:
        some = docs.filter(F.pmod(F.xxhash64(id_col), F.lit(n)) == i) if n > 1 else docs
        unit = tfidf_docs(count_words(some, id_col, text_col, **options), share, id_col)
        placed = unit.withColumn("slice", F.lit(i)).withColumn("bucket", _bucket("term"))
        in_line = dealt_in_line(placed, "bucket", sizes, "term", id_col)
        return in_line.sortWithinPartitions("bucket", "term", id_col)  # runs take less room

    return written_in_parts(map(postings, range(n)), "postings", ("slice", "bucket"))


def _slices(rows: int, words: int) -> int:
    return max(1, math.ceil(rows / max(SLICE_ROWS, SLICE_WORDS * words)))


def _share(model: LexicalModel, slices: int) -> LexicalModel:
    """The model as it sizes the shuffles of one slice."""
    return replace(model, n_postings=math.ceil(model.n_postings / slices))


def _bucket(term: str) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(TERM_BUCKETS)).cast("int")


def _asked_terms(vectors: DataFrame, bounded: bool) -> tuple[DataFrame, bool, list[int]]:
    """The distinct terms of the queries, whether they fit a broadcast, and their buckets."""
    asked = vectors.select("term").distinct()
    if not bounded:  # many queries may share few words
        asked = written_in_parts([asked], "asked")
        bounded = within_bound(asked)
    buckets = asked.select(_bucket("term")).distinct().collect()  # at most TERM_BUCKETS
    return asked, bounded, [r[0] for r in buckets]


def _asked_postings(
    postings: DataFrame, vectors: DataFrame, model: LexicalModel, bounded: bool, doc_id: str
) -> DataFrame:
    """The same (id, hits) as ``asked_weights``, from stored postings instead of texts.

    The folders of buckets that hold no asked term are not read.
    """
    return _kept_postings(postings, *_asked_terms(vectors, bounded), model, doc_id)


def _kept_postings(
    postings: DataFrame,
    asked: DataFrame,
    bounded: bool,
    buckets: list[int],
    model: LexicalModel,
    doc_id: str,
) -> DataFrame:
    postings = postings.filter(F.col("bucket").isin(buckets)).drop("slice", "bucket")
    frequency = model.idf.select("term", F.col("df").alias("n_rows"))
    rows = model.n_postings
    kept = lookup_join(
        postings, asked, "term", doc_id, frequency, small_is_bounded=bounded, rows=rows
    )
    hit = F.struct("term", F.col("weight").alias("doc_weight"))
    return dealt(kept, rows, doc_id).groupBy(doc_id).agg(F.collect_list(hit).alias("hits"))


def _asked_by_slice(
    postings: DataFrame, vectors: DataFrame, model: LexicalModel, bounded: bool, doc_id: str
) -> Iterator[DataFrame]:
    """The frames of ``_asked_postings`` for one slice of the documents after the other."""
    asked = _asked_terms(vectors, bounded)
    slices = sorted(r[0] for r in postings.select("slice").distinct().collect())
    if len(slices) < 2:
        yield _kept_postings(postings, *asked, model, doc_id)
        return
    share = _share(model, len(slices))
    for i in slices:
        yield _kept_postings(postings.filter(F.col("slice") == i), *asked, share, doc_id)


def _parts(
    weights: DataFrame, vectors: DataFrame, model: LexicalModel, bounded: bool, doc_id: str
) -> DataFrame:
    """One row per query, document and shared term."""
    hits = weights.select(doc_id, F.inline_outer("hits")).filter(F.col("term").isNotNull())
    asked = vectors.withColumnRenamed("weight", "query_weight")
    if bounded:
        joined = hits.join(F.broadcast(asked), "term")
    else:
        frequency = model.idf.select("term", F.col("df").alias("n_rows"))
        joined = salted_join(
            hits, asked, "term", doc_id, weights=frequency, rows=model.n_postings
        )
    return joined.withColumn("contribution", F.col("query_weight") * F.col("doc_weight"))


def score_pairs(
    weights: DataFrame,
    vectors: DataFrame,
    model: LexicalModel,
    vectors_bounded: bool = True,
    doc_id: str = "doc_id",
    query_id: str = "query_id",
) -> DataFrame:
    """Cosine of every (query, document) pair that shares a term."""
    parts = _parts(weights, vectors, model, vectors_bounded, doc_id)
    return parts.groupBy(query_id, doc_id).agg(F.sum("contribution").alias("cosine_score"))


def explain_hits(
    best: DataFrame,
    weights: DataFrame,
    vectors: DataFrame,
    vectors_bounded: bool = True,
    best_bounded: bool = True,
    doc_id: str = "doc_id",
    query_id: str = "query_id",
) -> DataFrame:
    """Add the per-term parts of the score, for ranked hits only."""
    side = F.broadcast(best) if best_bounded else best
    hits = weights.join(side, doc_id).select(*best.columns, F.inline_outer("hits"))
    asked = vectors.withColumnRenamed("weight", "query_weight")
    asked = F.broadcast(asked) if vectors_bounded else asked
    parts = hits.join(asked, [query_id, "term"]).withColumn(
        "contribution", F.col("query_weight") * F.col("doc_weight")
    )
    detail = F.struct("term", "query_weight", "doc_weight", "contribution")
    return parts.groupBy(*best.columns).agg(F.collect_list(detail).alias("contributions"))


def _flag_query_terms(
    model: LexicalModel, vectors: DataFrame, vectors_bounded: bool
) -> LexicalModel:
    asked = vectors.select("term").distinct().withColumn("_asked", F.lit(True))
    side = F.broadcast(asked) if vectors_bounded else asked
    flagged = model.idf.join(side, "term", "left")
    return LexicalModel(flagged, model.n_docs, model.bounded, model.n_postings)


def cosine_scores(
    docs: DataFrame,
    queries: DataFrame,
    model: LexicalModel,
    doc_id: str = "doc_id",
    query_id: str = "query_id",
    text_col: str = "text",
    **options,
) -> DataFrame:
    vectors, bounded = query_vectors(queries, model, query_id, text_col, **options)
    counts = count_words(docs, doc_id, text_col, **options)
    weights = asked_weights(counts, vectors, model, bounded, doc_id)
    return score_pairs(weights, vectors, model, bounded, doc_id, query_id)


def ranked_hits(
    docs: DataFrame,
    queries: DataFrame,
    model: LexicalModel,
    top: int = SEARCH_TOP_K,
    doc_id: str = "doc_id",
    query_id: str = "query_id",
    text_col: str = "text",
    postings: DataFrame | None = None,
    **options,
) -> DataFrame:
    """The top documents per query with their per-term parts.

    The asked weights are written once: ranking reads them for all pairs, explaining for the few
    hits, and the texts are passed over a single time. Queries beyond a broadcast go in blocks that
    fit one, each with a scan of the weights, so pairs of queries and documents are never stored.
    Many blocks are ranked a few at a time, and their hits are written before the next start. With
    ``postings`` from ``store_postings`` the texts are not read at all.
    """
    vectors, bounded = query_vectors(queries, model, query_id, text_col, **options)
    if postings is None:
        counts = count_words(docs, doc_id, text_col, **options)
        parts = [asked_weights(counts, vectors, model, bounded, doc_id)]
    else:
        parts = _asked_by_slice(postings, vectors, model, bounded, doc_id)
    weights = written_in_parts(parts, "weights")
    blocks = query_blocks(vectors, bounded, query_id)
    few = math.ceil(queries.count() / len(blocks)) * top <= BROADCAST_ROWS

    def explained(some: list[DataFrame]) -> DataFrame:
        def hits(block: DataFrame) -> DataFrame:
            best = best_pairs(weights, block, top, doc_id, query_id)
            return explain_hits(best, weights, block, True, few, doc_id, query_id)

        return reduce(DataFrame.unionByName, map(hits, some))

    if len(blocks) <= BLOCKS_AT_ONCE:
        return explained(blocks)
    jobs = (blocks[i : i + BLOCKS_AT_ONCE] for i in range(0, len(blocks), BLOCKS_AT_ONCE))
    return written_in_parts(map(explained, jobs), "explained")


def matched_keywords(contributions: Column) -> Column:
    """Matched terms in vocabulary order."""
    return F.array_sort(F.transform(contributions, lambda c: c["term"]))


def by_contribution(contributions: Column) -> Column:
    """Term parts of a score, largest first, ties alphabetical."""
    keyed = F.transform(
        contributions,
        lambda c: F.struct(
            (-F.round(c["contribution"], 9)).alias("k"), c["term"].alias("t"), c.alias("c")
        ),
    )
    return F.transform(F.array_sort(keyed), lambda x: x["c"])


def search_topk(
    docs: DataFrame,
    queries: DataFrame,
    model: LexicalModel,
    top: int = SEARCH_TOP_K,
    threshold: float = SEARCH_THRESHOLD,
    mode: str = "filter",
    doc_id: str = "doc_id",
    query_id: str = "query_id",
    **options,
) -> DataFrame:
    """Best documents per query with score, rank, matched keywords and term contributions.

    ``filter`` keeps only hits at or above the threshold (ranks are given before). ``flag`` returns
    exactly ``top`` rows per query, marks those above, and fills up with zero-score documents of
    the smallest ids.
    """
    if mode not in ("filter", "flag"):
        raise ValueError("mode must be 'filter' or 'flag'")
    best = ranked_hits(docs, queries, model, top, doc_id, query_id, **options)
    if mode == "flag":
        best = _fill_up(best, docs, queries, top, doc_id, query_id)
    above = F.round(F.col("cosine_score"), 9) >= threshold
    hits = best.select(
        query_id,
        "rank",
        doc_id,
        "cosine_score",
        above.alias("is_above_threshold"),
        matched_keywords(F.col("contributions")).alias("matched_keywords"),
        by_contribution(F.col("contributions")).alias("contributions"),
    )
    return hits if mode == "flag" else hits.filter(F.col("is_above_threshold"))


def _fill_up(
    best: DataFrame, docs: DataFrame, queries: DataFrame, top: int, doc_id: str, query_id: str
) -> DataFrame:
    # A query with m < top hits needs top - m documents, all found among the top smallest ids.
    smallest = [r[0] for r in docs.select(doc_id).orderBy(doc_id).limit(top).collect()]
    id_type = docs.schema[doc_id].dataType
    candidates = F.array(*[F.lit(i).cast(id_type) for i in smallest])
    found = best.groupBy(query_id).agg(F.collect_list(doc_id).alias("_found"))  # <= top each
    missing = (
        queries.select(query_id)
        .join(found, query_id, "left")
        .withColumn("_found", F.coalesce("_found", F.array().cast(found.schema["_found"].dataType)))
        .withColumn("_pad", F.array_except(candidates, F.col("_found")))
        .select(query_id, F.size("_found").alias("_have"), F.posexplode("_pad").alias("_i", doc_id))
        .withColumn("rank", F.col("_have") + F.col("_i") + 1)
        .filter(F.col("rank") <= top)
    )
    blank = missing.select(
        query_id,
        doc_id,
        F.lit(0.0).alias("cosine_score"),
        F.array().cast(best.schema["contributions"].dataType).alias("contributions"),
        "rank",
    )
    return best.select(*blank.columns).unionByName(blank)


def term_contributions(
    hits: DataFrame, doc_id: str = "doc_id", query_id: str = "query_id"
) -> DataFrame:
    """One row per hit and matched term, numbered by contribution."""
    return hits.select(
        query_id, "rank", doc_id, F.posexplode("contributions").alias("_i", "_c")
    ).select(
        query_id,
        "rank",
        doc_id,
        (F.col("_i") + 1).alias("term_rank"),
        "_c.term",
        "_c.query_weight",
        "_c.doc_weight",
        "_c.contribution",
    )


def search_with_fallback(
    docs: DataFrame,
    queries: DataFrame,
    model: LexicalModel,
    top: int = SEARCH_TOP_K,
    confidence_threshold: float = FALLBACK_THRESHOLD,
    message: str = FALLBACK_MESSAGE,
    actions: Sequence[str] = FALLBACK_ACTIONS,
    doc_id: str = "doc_id",
    query_id: str = "query_id",
    mode: str = "filter",
    **options,
) -> DataFrame:
    """One payload per query: results, or a message and suggested actions when the search guesses.

    The top score is taken before hits below the threshold are dropped; equality succeeds. With
    ``flag`` all ``top`` rows stay, filled up as in ``search_topk``, each with its flag.
    """
    if mode not in ("filter", "flag"):
        raise ValueError("mode must be 'filter' or 'flag'")
    best = ranked_hits(docs, queries, model, top, doc_id, query_id, **options)
    if mode == "flag":
        best = _fill_up(best, docs, queries, top, doc_id, query_id)
    return fallback_payloads(
        best, queries, confidence_threshold, message, actions, doc_id, query_id, mode
    )


def fallback_payloads(
    ranked: DataFrame,
    queries: DataFrame,
    confidence_threshold: float = FALLBACK_THRESHOLD,
    message: str = FALLBACK_MESSAGE,
    actions: Sequence[str] = FALLBACK_ACTIONS,
    doc_id: str = "doc_id",
    query_id: str = "query_id",
    mode: str = "filter",
) -> DataFrame:
    """Decide per query from its ranked hits (at most a few rows each).

    A query that falls back has its hits as ``low_confidence_candidates`` instead of ``results``.
    With ``flag`` results keep the hits below the threshold, and every hit says which it is.
    """
    sure = F.round(F.col("cosine_score"), 9) >= confidence_threshold
    flag = [sure.alias("is_above_threshold")] if mode == "flag" else []
    entry = F.struct("rank", doc_id, "cosine_score", _keywords_of(ranked), *flag)
    per_query = ranked.groupBy(query_id).agg(
        F.max("cosine_score").alias("_top"),
        F.sort_array(F.collect_list(entry if mode == "flag" else F.when(sure, entry))).alias("results"),
        F.sort_array(F.collect_list(entry)).alias("_all"),
    )
    top_score = F.coalesce(F.col("_top"), F.lit(0.0))
    weak = F.round(top_score, 9) < confidence_threshold
    return queries.join(per_query, query_id, "left").select(
        *queries.columns,
        F.when(weak, STATUS_FALLBACK).otherwise(STATUS_SUCCESS).alias("status"),
        top_score.alias("max_confidence_score"),
        F.when(weak, message).alias("fallback_message"),
        F.when(weak, F.array(*[F.lit(a) for a in actions])).alias("suggested_actions"),
        F.when(~weak, F.col("results")).alias("results"),
        F.when(weak, F.col("_all")).alias("low_confidence_candidates"),
    )


def _keywords_of(ranked: DataFrame) -> Column:
    if "contributions" in ranked.columns:
        return matched_keywords(F.col("contributions")).alias("matched_keywords")
    return F.col("matched_keywords")


def scenario_report(
    hits: DataFrame,
    queries: DataFrame,
    notes: DataFrame,
    query_id: str = "query_id",
    text_col: str = "text",
    default_note: str = NO_NOTE,
) -> DataFrame:
    """Hits of labelled queries with the diagnostic note of the query text, or a default note."""
    noted = queries.select(query_id, F.col(text_col).alias("query")).join(notes, "query", "left")
    labelled = noted.withColumn("note", F.coalesce("note", F.lit(default_note)))
    return labelled.join(hits, query_id, "left")


def ngram_space_metrics(
    docs: DataFrame,
    text_col: str = "text",
    configs: Sequence[tuple[int, int]] = ((1, 1), (1, 2), (1, 3), (2, 2)),
    n_samples: int = 3,
    id_col: str = "doc_id",
    **options,
) -> DataFrame:
    """Vocabulary size, non-zeros, sparsity and sample multi-word features per n-gram range.

    N-grams of different length never coincide, so each length is counted once and the ranges
    are sums over lengths; non-zeros are counted inside the row.
    """
    longest = max(hi for _, hi in configs)
    per_length = let(
        tokenize_and_clean(text_col, **options),
        lambda t: F.array(
            *[
                F.struct(F.lit(n).alias("n"), F.array_distinct(ngrams(t, n, n)).alias("grams"))
                for n in range(1, longest + 1)
            ]
        ),
    )
    lengths = docs.select(F.inline_outer(per_length))
    grams = lengths.select("n", F.explode_outer("grams").alias("gram")).filter(
        F.col("gram").isNotNull()
    )
    vocabulary = grams.groupBy("n", "gram").agg(F.count(F.lit(1)).alias("df"))
    # One pass over the shuffled vocabulary; a few rows leave each task.
    parts = vocabulary.mapInArrow(
        _vocabulary_parts(n_samples), "n int, v long, nnz long, first array<string>"
    )
    every = F.sort_array(F.flatten(F.collect_list("first")))
    sizes = parts.groupBy("n").agg(
        F.sum("v").alias("v"), F.sum("nnz").alias("nnz"), F.slice(every, 1, n_samples).alias("first")
    )
    # One row per n-gram length from here on.
    ranges = F.array(
        *[
            F.struct(F.lit(i).alias("config_no"), F.lit(lo).alias("min_n"), F.lit(hi).alias("max_n"))
            for i, (lo, hi) in enumerate(configs, 1)
        ]
    )
    per_range = (
        sizes.select("*", F.inline(ranges))
        .filter(F.col("n").between(F.col("min_n"), F.col("max_n")))
        .groupBy("config_no", "min_n", "max_n")
        .agg(
            F.sum("v").alias("vocabulary_size"),
            F.sum("nnz").alias("non_zero"),
            F.flatten(F.collect_list(F.when(F.col("n") > 1, F.col("first")))).alias("_multi"),
        )
    )
    n_docs = docs.agg(F.count(F.lit(1)).cast("double").alias("n")).scalar()
    samples = F.array_join(F.slice(F.array_sort("_multi"), 1, n_samples), ", ")
    return per_range.select(
        F.format_string("(%d, %d)", "min_n", "max_n").alias("ngram_range"),
        "vocabulary_size",
        "non_zero",
        F.round(
            (1 - F.col("non_zero") / (n_docs * F.col("vocabulary_size"))) * 100, 2
        ).alias("sparsity_pct"),
        F.when(F.size("_multi") > 0, samples)
        .otherwise(F.lit("None (Unigrams only)"))
        .alias("sample_features"),
    )


def _vocabulary_parts(k: int):
    """Per task and n-gram length: terms, documents summed over them, and the k first terms."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, int, list[str]]] = {}
        for batch in batches:
            for n in pc.unique(batch.column(0)).to_pylist():
                rows = batch.filter(pc.equal(batch.column(0), n))
                v, nnz, first = found.get(n, (0, 0, []))
                grams = rows.column(1)
                if first and len(first) == k:
                    grams = grams.filter(pc.less(grams, pa.scalar(first[-1], grams.type)))
                order = pc.sort_indices(grams)[:k]
                # Code points sort as UTF-8 bytes do.
                first = sorted([*first, *grams.take(order).to_pylist()])[:k]
                found[n] = v + rows.num_rows, nnz + pc.sum(rows.column(2)).as_py(), first
        if found:
            v, nnz, first = zip(*found.values())
            columns = [
                pa.array(list(found), pa.int32()),
                pa.array(v, pa.int64()),
                pa.array(nnz, pa.int64()),
                pa.array(first, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["n", "v", "nnz", "first"])

    return scan


def vector_audit(postings: DataFrame, docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counted violations: vectors that are not of norm 1 or have a negative weight."""
    n_docs = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    norms = postings.groupBy(id_col).agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"),
        F.min("weight").alias("low"),
    )
    return norms.agg(
        F.count(F.lit(1)).alias("n_vectors"),
        F.count(F.when(F.abs(F.col("norm") - 1) > 1e-5, 1)).alias("n_not_unit"),
        F.count(F.when(F.col("low") < 0, 1)).alias("n_negative"),
    ).select("*", n_docs.alias("n_docs"), (n_docs - F.col("n_vectors")).alias("n_empty"))


def self_similarity(postings: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Score of each document against itself; its query vector is its own unit vector."""
    return postings.groupBy(id_col).agg(
        F.sum(F.col("weight") * F.col("weight")).alias("cosine_score")
    )
