"""Dense vectors: hashing encoder, exact top-k search, cells, projection."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, PCAModel, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import let, run_lengths, tokenize_and_clean
from ..functions.vectors import as_double, dot, euclidean, l2_normalize, norm, verdict
from .scale import (
    BROADCAST_BYTES,
    hash_key,
    hash_rank,
    ordered_number,
    scratch_path,
    top_k,
    within_bound,
    written,
)

DIM = 64
FIT_PER_CELL = 256  # rows that cell centres are fitted on, per cell
LEAST_BLOCK = 4096  # query rows of a grid's block that is not cut to occupy more tasks
MANY_CELLS = 128  # more centres than this start from random rows
# Query rows and corpus rows multiplied at once inside a task; their scores take 16 MB.
_ROW_BLOCK, _CORPUS_BLOCK = 1024, 2048
_CELL_GAPS = 1 << 21  # distances to centres that a task holds at once

Encoder = Callable[[list[str]], np.ndarray]


# ---------------------------------------------------------------- encoding


def _code(token: Column, dim: int) -> Column:
    """2 * bucket + sign bit of a token, from its md5: the bucket from 8 digits, the sign from the next."""
    head = F.conv(F.substring(F.md5(token), 1, 9), 16, 10).cast("long")
    return let(head, lambda h: (F.shiftright(h, 4) % dim * 2 + h % 2).cast("int"))


def hash_vector(tokens: Column, dim: int = DIM) -> Column:
    """Signed feature hashing of a token array into ``dim`` buckets, scaled to norm 1.

    Works inside the row: bucket codes are sorted and counted, at most 2 * dim of them.
    """
    runs = run_lengths(F.transform(tokens, lambda t: _code(t, dim)), "code", "n")

    def dense(counts: Column) -> Column:
        def of(code: Column) -> Column:
            return F.coalesce(F.try_element_at(counts, code), F.lit(0))

        buckets = F.sequence(F.lit(0), F.lit(dim - 1))
        return F.transform(buckets, lambda b: (of(b * 2) - of(b * 2 + 1)).cast("double"))

    return l2_normalize(let(F.map_from_entries(runs), dense))


def embed_text(
    df: DataFrame, text: str = "text", name: str = "embedding", dim: int = DIM, **options
) -> DataFrame:
    """Add the default embedding: hashed content words, no model and no Python."""
    return df.withColumn(name, hash_vector(tokenize_and_clean(text, **options), dim))


def embed_with(
    df: DataFrame, load: Callable[[], Encoder], text: str = "text", name: str = "embedding"
) -> DataFrame:
    """Add embeddings of a plug-in encoder, loaded once per task and fed Arrow batches."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = load()
        for batch in batches:
            matrix = np.asarray(encoder(batch.fillna("").tolist()), dtype=np.float32)
            yield pd.Series(list(matrix))

    return df.withColumn(name, encode(F.col(text)))


def normalize_vectors(df: DataFrame, vector: str = "embedding") -> DataFrame:
    return df.withColumn(vector, l2_normalize(vector))


# ---------------------------------------------------------------- comparison and profile


def compare_pairs(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Cosine of unit vectors, Euclidean distance and a verdict per pair."""
    scored = pairs.withColumn("cosine", dot(left, right))
    return scored.withColumn("distance", euclidean(left, right)).withColumn(
        "verdict", verdict("cosine")
    )


def seeded_pairs(df: DataFrame, row_id: str, vector: str, seed: int = 42) -> DataFrame:
    """Neighbours in a reproducible shuffle, two rows to a pair; an odd last row stays out."""
    keyed = df.select(row_id, vector).withColumn("_key", hash_key(seed, row_id))
    placed = hash_rank(keyed, "_key", row_id, "_position")
    pair = F.floor((F.col("_position") - 1) / 2)
    is_left = F.col("_position") % 2 == 1
    entry = F.struct(F.col(row_id).alias("id"), F.col(vector).alias("vector"))
    return (
        placed.groupBy(pair.alias("pair_no"))
        .agg(F.max(F.when(is_left, entry)).alias("a"), F.max(F.when(~is_left, entry)).alias("b"))
        .filter(F.col("b").isNotNull())
        .select(
            F.col("a.id").alias("left_id"),
            F.col("b.id").alias("right_id"),
            F.col("a.vector").alias("left_vector"),
            F.col("b.vector").alias("right_vector"),
        )
    )


def embedding_profile(
    df: DataFrame, row_id: str, vector: str = "embedding", n_coordinates: int = 12
) -> DataFrame:
    """Rows, dimension, bytes as 32-bit floats, norm check, first coordinates of the first row."""
    length = norm(vector)
    first = F.min_by(F.slice(as_double(vector), 1, n_coordinates), row_id)
    summary = df.agg(
        F.count(F.lit(1)).alias("n_vectors"),
        F.max(F.size(vector)).alias("dimension"),
        F.sum(F.size(vector) * 4).alias("n_bytes"),
        F.count(F.when(F.abs(length - 1) > 1e-5, 1)).alias("n_not_unit"),
        first.alias("_first"),
    )
    coordinates = [
        F.round(F.get("_first", F.lit(i)), 4).alias(f"c{i + 1:02d}") for i in range(n_coordinates)
    ]
    return summary.select("n_vectors", "dimension", "n_bytes", "n_not_unit", *coordinates)


def index_profile(
    index: DataFrame, source: DataFrame, vector: str = "embedding", metric: str = "inner_product"
) -> DataFrame:
    """Indexed count against source count, dimension and metric name."""
    n_source = source.agg(F.count(F.lit(1)).alias("n")).scalar()
    return index.agg(
        F.count(vector).alias("n_indexed"),
        F.max(F.size(vector)).alias("dimension"),
        F.min(F.size(vector)).alias("min_dimension"),
    ).select(
        "n_indexed",
        n_source.alias("n_source"),
        (F.col("n_indexed") == n_source).alias("is_in_sync"),
        "dimension",
        (F.col("dimension") == F.col("min_dimension")).alias("is_uniform"),
        F.lit(metric).alias("metric"),
    )


# ---------------------------------------------------------------- exact search


def _matrix(vectors: pa.Array, dim: int | None = None) -> np.ndarray:
    flat = np.asarray(vectors.flatten(), dtype=np.float64)
    n = len(vectors)
    width = dim if dim is not None else (len(flat) // n if n else 0)
    if len(flat) != n * width:
        raise ValueError(f"vectors must all have the same length ({width})")
    return flat.reshape(n, width)


def _best(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int):
    """The k best (query, id, score) triples per query: score down, then id up."""
    order = np.lexsort((ids, -np.round(scores, 9), q))
    q, ids, scores = q[order], ids[order], scores[order]
    start = np.r_[True, q[1:] != q[:-1]] if len(q) else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(start, np.arange(len(q)), 0))
    keep = np.arange(len(q)) - first < k
    return q[keep], ids[keep], scores[keep]


def _scan_block(queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
    """Best k rows of one block of vectors for each query, of ties at the cut the smallest ids.

    A part of the queries meets a part of the vectors at a time, so memory does not depend on
    either side. A score below the k-th best found before is not looked at again.
    """
    found = []
    for lo in range(0, len(queries), _ROW_BLOCK):
        part = queries[lo : lo + _ROW_BLOCK]
        least = np.full(len(part), -np.inf)
        best = None
        for at in range(0, len(vectors), _CORPUS_BLOCK):
            end = at + _CORPUS_BLOCK
            new = _scan_part(part, ids[at:end], vectors[at:end], k, least)
            if best is not None:
                if not len(new[0]):
                    continue
                new = _best(*(np.concatenate(p) for p in zip(best, new)), k)
            best = new
            ends = np.cumsum(np.bincount(best[0], minlength=len(part)))
            full = np.flatnonzero(np.diff(ends, prepend=0) == k)
            least[full] = np.round(best[2][ends[full] - 1], 9) - 1e-9
        if best is not None:
            found.append((best[0] + lo, *best[1:]))
    if not found:
        return np.zeros(0, np.int64), ids[:0], np.zeros(0)
    return tuple(np.concatenate(part) for part in zip(*found))


def _scan_part(queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, least: np.ndarray):
    """The rows of a part of the vectors that are among the k best of it and not below ``least``."""
    scores = queries @ vectors.T
    kept = ~(scores < least[:, None])
    if scores.shape[1] > k and np.count_nonzero(kept) > 2 * k * len(queries):
        rounded = np.round(scores, 9)
        cut = np.partition(rounded, -k, axis=1)[:, -k, None]
        kept &= rounded >= cut
        crowded = np.flatnonzero(np.count_nonzero(kept, axis=1) > k)
        if len(crowded):
            places = np.argsort(ids, kind="stable")
            ordered = rounded[crowded][:, places]
            above, tied = ordered > cut[crowded], ordered == cut[crowded]
            room = k - np.count_nonzero(above, axis=1)
            few = np.empty_like(above)
            few[:, places] = above | (tied & (np.cumsum(tied, axis=1, dtype=np.int32) <= room[:, None]))
            kept[crowded] &= few
    q, i = np.nonzero(kept)
    return _best(q, ids[i], scores[q, i], k)


def _ids(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _sides(
    queries: DataFrame, corpus: DataFrame, query_id: str, corpus_id: str, vector: str, extra=()
) -> tuple[DataFrame, DataFrame]:
    # Null vectors are dropped by the tasks that read them: a filter here would make Catalyst
    # compute a derived vector twice, once below any shuffle.
    wide = F.col(vector).cast("array<double>").alias("_v")
    q = queries.select(F.col(query_id).alias("_q"), wide, *extra)
    c = corpus.select(F.col(corpus_id).alias("_c"), wide, *extra)
    return q, c


def _present(rows):
    """Rows of an Arrow table or batch that have a vector."""
    vectors = rows.column(rows.schema.get_field_index("_v"))
    return rows.filter(vectors.is_valid()) if vectors.null_count else rows


def vector_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    query_id: str = "query_id",
    corpus_id: str = "doc_id",
    vector: str = "embedding",
    bounded: bool | None = None,
) -> DataFrame:
    """Exact inner-product top-k of every query: (query_id, corpus_id, similarity_score, rank).

    If the queries were measured to be small, they go to every task and the corpus is scanned in
    place; only k rows per query and task are shuffled. Else both sides meet in a grid of cells
    of bounded size. Both ways score every pair and give the same rows.
    """
    q, c = _sides(queries, corpus, query_id, corpus_id, vector)
    if bounded is None:
        bounded = _fits(q)
    found = _scan_topk(q, c, k) if bounded else grid_topk(q, c, k)
    return _ranked(found, k, query_id, corpus_id)


def _fits(q: DataFrame, max_rows: int = 50_000) -> bool:
    """Whether all query vectors fit in one broadcast, by their count and all their values."""
    n, values = q.agg(F.count(F.lit(1)), F.sum(F.size("_v"))).first()
    return n <= max_rows and 8 * (values or 0) <= BROADCAST_BYTES


def _ranked(found: DataFrame, k: int, query_id: str, corpus_id: str) -> DataFrame:
    return top_k(found, "_q", "similarity_score", "_c", k).select(
        F.col("_q").alias(query_id), F.col("_c").alias(corpus_id), "similarity_score", "rank"
    )


def _result_schema(q: DataFrame, c: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("_q", q.schema["_q"].dataType),
            T.StructField("_c", c.schema["_c"].dataType),
            T.StructField("similarity_score", T.DoubleType()),
        ]
    )


def _scan_topk(q: DataFrame, c: DataFrame, k: int) -> DataFrame:
    table = _present(q.toArrow()).combine_chunks()  # measured by the caller
    vectors = table.column("_v").combine_chunks()
    query_type = table.schema.field("_q").type
    shared = q.sparkSession.sparkContext.broadcast(
        (_ids(table.column("_q").combine_chunks()), _matrix(vectors))
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, matrix = shared.value
        best = None
        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            batch = _present(batch)
            if not batch.num_rows or not len(query_ids):
                continue
            block = _matrix(batch.column(1), matrix.shape[1])
            found = _scan_block(matrix, _ids(batch.column(0)), block, k)
            if best is not None:
                found = _best(*(np.concatenate(p) for p in zip(best, found)), k)
            best = found
        if best is not None:
            rows, ids, scores = best
            yield pa.RecordBatch.from_arrays(
                [pa.array(query_ids[rows], query_type), pa.array(ids, id_type), pa.array(scores)],
                names=["_q", "_c", "similarity_score"],
            )

    return c.mapInArrow(scan, _result_schema(q, c))


def grid_topk(
    q: DataFrame,
    c: DataFrame,
    k: int,
    part: str | None = None,
    query_rows: int = 32_768,
    corpus_rows: int = 65_536,
) -> DataFrame:
    """Top-k candidates from a grid of (query block, corpus slab) cells, each of bounded size.

    With ``part`` only rows of the same part meet; parts are cut by the size of the largest one,
    so a hot part becomes many cells.
    """
    by = [part] if part else []

    def largest(side: DataFrame) -> int:
        sizes = side.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
        return sizes.agg(F.max("n")).first()[0] or 0

    asking = largest(q)
    slabs = max(1, math.ceil(largest(c) / corpus_rows))
    # Smaller blocks where there would be fewer cells than tasks.
    spare = math.ceil(2 * q.sparkSession.sparkContext.defaultParallelism / slabs)
    blocks = max(1, math.ceil(asking / query_rows), min(spare, asking // LEAST_BLOCK))
    block_of = F.pmod(F.xxhash64("_q"), F.lit(blocks)).cast("int")
    slab_of = F.pmod(F.xxhash64("_c"), F.lit(slabs)).cast("int")
    left = q.withColumn("_block", block_of).withColumn(
        "_slab", F.explode(F.sequence(F.lit(0), F.lit(slabs - 1)))
    )
    right = c.withColumn("_slab", slab_of).withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )

    def cell(query_side: pa.Table, corpus_side: pa.Table) -> pa.Table:
        query_side, corpus_side = _present(query_side), _present(corpus_side)
        query_ids = _ids(query_side.column("_q").combine_chunks())
        ids = _ids(corpus_side.column("_c").combine_chunks())
        if len(query_ids) and len(ids):
            matrix = _matrix(query_side.column("_v").combine_chunks())
            block = _matrix(corpus_side.column("_v").combine_chunks(), matrix.shape[1])
            rows, ids, scores = _scan_block(matrix, ids, block, k)
        else:
            rows, ids, scores = np.zeros(0, np.int64), ids[:0], np.zeros(0)
        return pa.table(
            [
                pa.array(query_ids[rows], query_side.schema.field("_q").type),
                pa.array(ids, corpus_side.schema.field("_c").type),
                pa.array(scores, pa.float64()),
            ],
            names=["_q", "_c", "similarity_score"],
        )

    keys = [*by, "_block", "_slab"]
    meet = left.groupBy(*keys).cogroup(right.groupBy(*keys))
    return meet.applyInArrow(cell, _result_schema(q, c))


def self_retrieval(
    corpus: DataFrame, probes: DataFrame | None = None, row_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Per stored vector: what it retrieves at rank 1, and whether that is itself with score 1.

    An exact copy with a smaller id may come first, so a hit of equal score counts as itself.
    """
    asked = (corpus if probes is None else probes).select(F.col(row_id).alias("query_id"), vector)
    best = vector_topk(asked, corpus, 1, "query_id", row_id, vector)
    return best.select(
        "query_id",
        F.col(row_id).alias("top_id"),
        "similarity_score",
        (F.abs(F.col("similarity_score") - 1) < 1e-4).alias("is_self_match"),
    )


# ---------------------------------------------------------------- cells


@dataclass(frozen=True)
class CellIndex:
    """A stored cell index: ``rows`` are the corpus and its ``_cell``, one folder per cell."""

    rows: DataFrame
    centres: np.ndarray
    folder: str


def fit_cells(corpus: DataFrame, n_cells: int, vector: str = "embedding", seed: int = 42):
    """k-means centres of the corpus, as an (n_cells, d) array; the centres are all that is kept.

    Many centres start from random rows: choosing spread ones takes a clustering in the driver that
    grows with the square of their number.
    """
    features = corpus.select(array_to_vector(as_double(vector)).alias("features"))
    means = KMeans(k=n_cells, seed=seed, featuresCol="features")
    if n_cells > MANY_CELLS:
        means = means.setInitMode("random")
    return np.array(means.fit(features).clusterCenters())


def nearest_cells(
    df: DataFrame, centres: np.ndarray, n: int, vector: str = "embedding", name: str = "cell"
):
    """Add the cell: one row per row and each of its n nearest centres."""
    exploded = df.select("*", F.explode_outer(_cells_of(df, centres, n, vector)).alias(name))
    return exploded.filter(F.col(name).isNotNull())


def _cells_of(df: DataFrame, centres: np.ndarray, n: int, vector: str) -> Column:
    """The n nearest centres as an array, null without a vector or without centres."""
    shared = df.sparkSession.sparkContext.broadcast(centres)

    @F.pandas_udf("array<int>")
    def pick(vectors: pd.Series) -> pd.Series:
        c = shared.value
        cells = pd.Series([None] * len(vectors), dtype=object)
        present = np.flatnonzero(vectors.notna())
        step = max(1, _CELL_GAPS // max(1, len(c)))
        for lo in range(0, len(present) if len(c) else 0, step):
            rows = present[lo : lo + step]
            m = np.vstack([np.asarray(vectors.iloc[i], dtype=np.float64) for i in rows])
            cells.iloc[rows] = list(_nearest(m, c, n).astype(np.int32))
        return cells

    return pick(vector)


def _nearest(m: np.ndarray, c: np.ndarray, n: int) -> np.ndarray:
    """The n nearest centres of each row, equal distances to 12 places by number."""
    gaps = (c * c).sum(1)[None, :] - 2.0 * (m @ c.T)
    if n > 1:
        return np.argsort(np.round(gaps, 12), axis=1, kind="stable")[:, :n]
    first = gaps.argmin(axis=1)
    near = gaps <= gaps[np.arange(len(m)), first][:, None] + 1e-11
    for i in np.flatnonzero(np.count_nonzero(near, axis=1) > 1):
        first[i] = np.round(gaps[i], 12).argmin()
    return first[:, None]


def build_cells(
    corpus: DataFrame,
    n_cells: int | None = None,
    vector: str = "embedding",
    corpus_id: str = "doc_id",
    centres: np.ndarray | None = None,
    folder: str | None = None,
    seed: int = 42,
) -> CellIndex:
    """Store a corpus by cell, once for many searches; ``open_cells`` finds it again by its folder.

    Without ``n_cells`` there are as many cells as the square root of the rows, so cells and what
    a cell holds grow alike; never more than centres fit in one broadcast. Centres are fitted on
    about ``FIT_PER_CELL`` rows per cell, chosen by a hash of the id; every row is stored, with all
    its columns. Rows are rebalanced by cell, which leaves few files in a folder and cuts a hot cell
    among several tasks. The corpus is read up to three times, so write a derived one first.

    Rows without a vector cannot be found and are not stored. An empty corpus gives an index
    without cells.
    """
    spark = corpus.sparkSession
    folder = folder or scratch_path(spark, "cell-index")
    if centres is None:
        n, width = corpus.agg(F.count(vector), F.max(F.size(vector))).first()
        most = max(1, BROADCAST_BYTES // (8 * max(width or 1, 1)))
        cells = min(n_cells or math.ceil(math.sqrt(n)), n, most)
        share = math.ceil(min(1.0, cells * FIT_PER_CELL / max(n, 1)) * 1_000_000)
        chosen = F.pmod(F.xxhash64(corpus_id), F.lit(1_000_000)) < share
        sample = corpus.filter(F.col(vector).isNotNull() & chosen)
        centres = fit_cells(sample, cells, vector, seed) if cells else np.zeros((0, 0))
    dealt = nearest_cells(corpus, centres, 1, vector, "_cell")
    dealt.hint("rebalance", "_cell").write.partitionBy("_cell").parquet(f"{folder}/rows")
    listed = [(i, [float(x) for x in c]) for i, c in enumerate(centres)]  # bounded, as above
    spark.createDataFrame(listed, "cell int, centre array<double>").write.parquet(f"{folder}/centres")
    shape = [(dealt.schema.json(),)]
    spark.createDataFrame(shape, "schema string").write.parquet(f"{folder}/manifest")
    return open_cells(spark, folder)


def open_cells(spark: SparkSession, folder: str) -> CellIndex:
    """A cell index that ``build_cells`` stored."""
    schema = spark.read.parquet(f"{folder}/manifest").first()["schema"]
    rows = spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(f"{folder}/rows")
    found = spark.read.parquet(f"{folder}/centres").orderBy("cell").collect()  # fits in a broadcast
    return CellIndex(rows, np.array([r["centre"] for r in found]), folder)


def search_cells(
    index: CellIndex,
    queries: DataFrame,
    k: int,
    n_probe: int | None = None,
    query_id: str = "query_id",
    corpus_id: str = "doc_id",
    vector: str = "embedding",
    columns: Sequence[str] = (),
    bounded: bool | None = None,
) -> DataFrame:
    """Top-k among the rows of each query's n_probe nearest cells; all cells give exact search.

    Returns (query_id, corpus_id, similarity_score, rank) and the stored ``columns``. Only the folders
    of probed cells are read, for the vectors and for the columns. Queries that were measured to
    be small go to every task, which scans its cells in place for the queries that probe them; k
    rows per query and task are shuffled. Else both sides meet in a grid by cell. Without
    ``n_probe``: the square root of the number of cells, 4 at least.

    Queries without a vector find nothing. An index without cells gives no rows.
    """
    n_probe = n_probe or max(4, math.ceil(math.sqrt(len(index.centres))))
    asked = queries.select(query_id, vector)
    asked = asked.withColumn("_cells", _cells_of(asked, index.centres, n_probe, vector))
    asked = written(asked, "probes").filter(F.col("_cells").isNotNull())
    probes = asked.select("*", F.explode("_cells").alias("_cell"))
    probed = [r[0] for r in probes.select("_cell").distinct().collect()]  # at most as many as centres
    near = index.rows.filter(F.col("_cell").isin(probed))
    q, c = _sides(probes, near, query_id, corpus_id, vector, extra=["_cell"])
    wide = F.col(vector).cast("array<double>").alias("_v")
    rows = asked.select(F.col(query_id).alias("_q"), wide, "_cells")
    if bounded is None:
        n_probes = asked.agg(F.sum(F.size("_cells"))).first()[0] or 0
        bounded = _fits(rows) and 16 * n_probes <= BROADCAST_BYTES
    found = _scan_cells(rows, c, k) if bounded else grid_topk(q, c, k, part="_cell")
    hits = _ranked(found, k, query_id, corpus_id)
    if not columns:
        return hits
    hits = written(hits, "cell-hits")
    side = F.broadcast(hits) if within_bound(hits) else hits
    return near.select(corpus_id, *columns).join(side, corpus_id).select(*hits.columns, *columns)


def _scan_cells(q: DataFrame, c: DataFrame, k: int) -> DataFrame:
    table = _present(q.toArrow()).combine_chunks()  # measured by the caller
    query_type = table.schema.field("_q").type
    vectors = table.column("_v").combine_chunks()
    lists = table.column("_cells").combine_chunks()
    asking, cells = _ids(lists.value_parent_indices()), _ids(lists.flatten())
    order = np.argsort(cells, kind="stable")
    numbers, starts = np.unique(cells[order], return_index=True)
    by_cell = dict(zip(numbers.tolist(), np.split(asking[order], starts[1:])))
    shared = q.sparkSession.sparkContext.broadcast(
        (_ids(table.column("_q").combine_chunks()), _matrix(vectors), by_cell)
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, matrix, asking = shared.value
        # Rows of the same query gather what all of them find.
        first: dict = {}
        gather = np.array([first.setdefault(x, n) for n, x in enumerate(query_ids.tolist())], dtype=np.int64)
        best = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            batch = _present(batch)
            places = _ids(batch.column(2))
            for cell in np.unique(places):
                rows = asking.get(int(cell))
                if rows is None:
                    continue
                part = batch.take(pa.array(np.flatnonzero(places == cell)))
                block = _matrix(part.column(1), matrix.shape[1])
                at, ids, scores = _scan_block(matrix[rows], _ids(part.column(0)), block, k)
                found = gather[rows[at]], ids, scores
                if best is not None:
                    found = tuple(np.concatenate(p) for p in zip(best, found))
                best = _best(*found, k)
        if best is not None:
            at, ids, scores = best
            yield pa.RecordBatch.from_arrays(
                [pa.array(query_ids[at], query_type), pa.array(ids, id_type), pa.array(scores)],
                names=["_q", "_c", "similarity_score"],
            )

    return c.mapInArrow(scan, _result_schema(q, c))


def ivf_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    n_cells: int = 16,
    n_probe: int = 4,
    query_id: str = "query_id",
    corpus_id: str = "doc_id",
    vector: str = "embedding",
    centres: np.ndarray | None = None,
) -> DataFrame:
    """``build_cells`` and ``search_cells`` for one search; several share a stored index."""
    index = build_cells(corpus.select(corpus_id, vector), n_cells, vector, corpus_id, centres)
    return search_cells(index, queries, k, n_probe, query_id, corpus_id, vector)


# ---------------------------------------------------------------- projection


def fit_pca(df: DataFrame, k: int = 2, vector: str = "embedding") -> PipelineModel:
    """Centring and principal components; only d x d sums leave the tasks."""
    features = df.select(array_to_vector(as_double(vector)).alias("features"))
    centring = StandardScaler(
        withMean=True, withStd=False, inputCol="features", outputCol="centred"
    ).fit(features)
    components = PCA(k=k, inputCol="centred", outputCol="projected").fit(
        centring.transform(features)
    )
    return PipelineModel([centring, components])


def _components(model: PipelineModel) -> PCAModel:
    return model.stages[-1]


def pca_project(df: DataFrame, model: PipelineModel, vector: str = "embedding") -> DataFrame:
    """Add pc1..pck. Signs are fixed so that the largest loading of a component is positive."""
    loadings = _components(model).pc.toArray()
    signs = [float(np.sign(c[np.argmax(np.abs(c))]) or 1.0) for c in loadings.T]
    projected = model.transform(
        df.withColumn("features", array_to_vector(as_double(vector)))
    ).withColumn("_p", vector_to_array("projected"))
    for i, sign in enumerate(signs):
        projected = projected.withColumn(f"pc{i + 1}", F.get("_p", F.lit(i)) * sign)
    return projected.drop("features", "centred", "projected", "_p")


def explained_variance(df: DataFrame, model: PipelineModel, vector: str = "embedding") -> DataFrame:
    """Variance share of each component, in percent, and the running total."""
    ratios = [float(r) for r in _components(model).explainedVariance.toArray()]
    rows = [
        (i + 1, r, 100.0 * sum(ratios[: i + 1])) for i, r in enumerate(ratios)
    ]  # one row per component
    table = df.sparkSession.createDataFrame(
        rows, "component int, variance_ratio double, total_pct double"
    )
    return table


def highlight_label(df: DataFrame, label: str, chosen: str | None = None) -> DataFrame:
    """Highlight flag and opacity per row for a chosen label; neutral if none is chosen."""
    if chosen is None:
        return df.withColumn("is_highlighted", F.lit(False)).withColumn("opacity", F.lit(0.85))
    hit = F.coalesce(F.col(label).cast("string") == chosen, F.lit(False))
    return df.withColumn("is_highlighted", hit).withColumn(
        "opacity", F.when(hit, 1.0).otherwise(0.12)
    )


def encode_labels(df: DataFrame, label: str, labels: Sequence[str] | None = None) -> DataFrame:
    """(label, label_id): 0-based ids of the sorted distinct labels."""
    distinct = df.select(label).filter(F.col(label).isNotNull()).distinct()
    numbered = ordered_number(distinct, label, "_n")
    return numbered.select(label, (F.col("_n") - 1).cast("int").alias("label_id"))
