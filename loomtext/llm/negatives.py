"""Hard negatives by exact integer scores from bit planes and subset-sum tables.

Candidates are stored as bit planes: bit j of eight neighbouring components is one byte. For an
anchor and each group of eight components a table holds the sum of every subset of the anchor's
eight values; a candidate's byte looks its subset up, and shifting and adding the planes gives the
whole inner product without a multiplication. Anchors and candidates meet in a grid of cells of
bounded size, once to find the positives and once more to find the rows just below them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from loomtext.operators.scale import written

SCALE = 256
GROUP = 8  # components of a table, bits of a byte
ANCHOR_ROWS, CANDIDATE_ROWS = 1024, 16_384  # most rows of a side in a cell, on average
MOST_TASKS = 10_000
TABLE_ANCHORS = 64  # anchors whose tables are held at a time

POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100  # a negative scores between these parts of 100 of its positive


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """Components as whole numbers, rounded down; null if one is null, not finite or out of range.

    Sums of products must fit in 64 bits, so components are kept below 2**24 (after scaling).
    """
    wide = vector.cast("array<double>")
    whole = F.transform(wide, lambda x: F.floor(x * F.lit(float(scale))))
    fits = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * F.lit(float(scale))) < float(1 << 24)))
    return F.when(fits, F.transform(whole, lambda x: x.cast("int")))


def _finite(vector: Column) -> Column:
    wide = vector.cast("array<double>")
    return vector.isNotNull() & F.forall(
        wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )


# ---------------------------------------------------------------- scoring inside a task


def planes_of(values: np.ndarray, bits: int) -> np.ndarray:
    """(bits, groups, rows) bytes of whole numbers in two's complement; components are padded with 0."""
    rows, dims = values.shape
    padded = np.zeros((rows, -(-max(dims, 1) // GROUP) * GROUP), dtype=np.int64)
    padded[:, :dims] = values
    out = [
        np.packbits(((padded >> j) & 1).astype(np.uint8), axis=1, bitorder="little").T for j in range(bits)
    ]
    return np.stack(out)


def subset_sums(values: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): for each byte the sum of the eight values whose bits it has."""
    anchors, dims = values.shape
    groups = -(-max(dims, 1) // GROUP)
    padded = np.zeros((anchors, groups * GROUP), dtype=np.int64)
    padded[:, :dims] = values
    split = padded.reshape(anchors, groups, GROUP).transpose(1, 2, 0)
    out = np.zeros((groups, 1 << GROUP, anchors), dtype=np.int64)
    for bit in range(GROUP):
        # Subsets with this bit as highest one are the earlier subsets and its value.
        out[:, 1 << bit : 2 << bit] = out[:, : 1 << bit] + split[:, bit, None, :]
    return out


def scores_of(planes: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """(rows, anchors) inner products by looking up and shifting, from the sign plane down."""
    bits, groups, rows = planes.shape
    total = np.zeros((rows, tables.shape[2]), dtype=np.int64)
    for j in range(bits - 1, -1, -1):
        total <<= 1
        for g in range(groups):
            found = np.take(tables[g], planes[j, g], axis=0)
            if j == bits - 1:  # two's complement: the highest bit counts negative
                total -= found
            else:
                total += found
    return total


def _first(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the n best rows: score down, then id up."""
    if len(scores) > 4 * n:
        cut = np.partition(scores, len(scores) - n)[len(scores) - n]
        few = np.flatnonzero(scores >= cut)
    else:
        few = np.arange(len(scores))
    return few[np.lexsort((ids[few], -scores[few]))[:n]]


# ---------------------------------------------------------------- the grid


def _unpacked(column: pa.ChunkedArray, shape: tuple[int, ...]) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, dtype=np.uint8).reshape(len(column), *shape)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _lists(table: pa.Table, name: str) -> list:
    return table.column(name).to_pylist()


def _grid(anchors: DataFrame, rows: DataFrame, sides: tuple[int, int], cell, schema: str) -> DataFrame:
    blocks, slabs = sides
    block = F.pmod(F.xxhash64("anchor_id"), F.lit(blocks)).cast("int")
    slab = F.pmod(F.xxhash64("vec_id"), F.lit(slabs)).cast("int")
    left = anchors.withColumn("_block", block).withColumn("_slab", F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))))
    right = rows.withColumn("_slab", slab).withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["_block", "_slab"]
    # Cells are small in bytes and long in time, so they are not to be drawn together by size.
    tasks = min(blocks * slabs, MOST_TASKS)
    left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, schema)


def _cells(anchors: pa.Table, rows: pa.Table, bits: int, dims: int):
    """Per block of anchors of a cell: its places and the scores of all rows of the cell."""
    groups = -(-max(dims, 1) // GROUP)
    planes = np.ascontiguousarray(_unpacked(rows.column("planes"), (bits, groups)).transpose(1, 2, 0))
    values = np.frombuffer(b"".join(anchors.column("values").to_pylist()), dtype=np.int32)
    values = values.reshape(anchors.num_rows, dims) if dims else np.zeros((anchors.num_rows, 0), np.int32)
    for lo in range(0, anchors.num_rows, TABLE_ANCHORS):
        tables = subset_sums(values[lo : lo + TABLE_ANCHORS])
        yield lo, scores_of(planes, tables).T.copy()


def _positives(bits: int, dims: int, k: int):
    def cell(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = [[], [], []]
        if anchors.num_rows and rows.num_rows:
            asked, labels = _column(anchors, "anchor_id"), _column(anchors, "label")
            ids, own = _column(rows, "vec_id"), _column(rows, "label")
            for lo, scores in _cells(anchors, rows, bits, dims):
                for i, line in enumerate(scores, lo):
                    same = np.flatnonzero((own == labels[i]) & (ids != asked[i]))
                    best = same[_first(line[same], ids[same], k)]
                    out[0].append(np.full(len(best), asked[i]))
                    out[1].append(ids[best])
                    out[2].append(line[best])
        return pa.table([np.concatenate([np.zeros(0, np.int64), *c]) for c in out], names=["anchor_id", "positive_id", "positive_score"])

    return cell


def _negatives(bits: int, dims: int, k: int, low: int, high: int):
    def cell(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = [[], [], [], [], []]
        if anchors.num_rows and rows.num_rows:
            asked, labels = _column(anchors, "anchor_id"), _column(anchors, "label")
            goals = _lists(anchors, "positives")
            ids, own = _column(rows, "vec_id"), _column(rows, "label")
            for lo, scores in _cells(anchors, rows, bits, dims):
                for i, line in enumerate(scores, lo):
                    # low * p <= 100 * n <= high * p, in whole numbers
                    wanted = [(-(-low * p["positive_score"] // 100), high * p["positive_score"] // 100, p) for p in goals[i]]
                    floor, roof = min(w[0] for w in wanted), max(w[1] for w in wanted)
                    near = np.flatnonzero((line >= floor) & (line <= roof) & (own != labels[i]))
                    near = near[np.lexsort((ids[near], -line[near]))]
                    falling = -line[near]
                    for bottom, top, p in wanted:
                        first = np.searchsorted(falling, -top, side="left")
                        last = np.searchsorted(falling, -bottom, side="right")
                        best = near[first : min(last, first + k)]
                        out[0].append(np.full(len(best), asked[i]))
                        out[1].append(np.full(len(best), p["positive_id"]))
                        out[2].append(np.full(len(best), p["positive_score"]))
                        out[3].append(ids[best])
                        out[4].append(line[best])
        return pa.table(
            [np.concatenate([np.zeros(0, np.int64), *c]) for c in out],
            names=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"],
        )

    return cell


def _best(df: DataFrame, by: list[str], score: str, tie: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(tie))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    anchor_rows: int = ANCHOR_ROWS,
    candidate_rows: int = CANDIDATE_ROWS,
) -> DataFrame:
    """Per anchor and positive the rows of other labels that score just below the positive.

    ``is_anchor`` is a condition on the columns of ``rows``. Components are multiplied by ``scale``
    and rounded down; a score is the whole inner product with the anchor, ties go to the smaller
    id. An anchor's positives are its first other rows of the same label; a positive's negatives
    are the first rows of other labels with low * positive <= 100 * negative <= high * positive.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``. Every
    anchor is scored with every row, in cells of bounded size, whatever its label, so a hot label
    or a large group of equal vectors changes nothing; of each cell only the first few rows of
    each anchor leave it.

    Rows with a null id, label or vector, or a null or non-finite component take no part. Shorter
    vectors count as padded with zeros; empty ones score 0. Of rows that repeat an id the one with
    the smallest label and vector counts. Scaled components of 2**24 and more are refused with an
    error, as scores could leave 64 bits. An anchor without positives or negatives has no rows.
    Other columns are ignored, whatever their names; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    whole = quantised(F.col(vector_col), scale)
    out_of_range = F.raise_error(F.lit("components must stay below 2**24 after scaling")).cast("array<int>")
    given = rows.filter(
        F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & _finite(F.col(vector_col))
    ).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("long").alias("label"),
        F.coalesce(whole, out_of_range).alias("q"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    one = given.groupBy("vec_id").agg(F.min(F.struct("label", "q", "is_anchor")).alias("r"))
    stored = written(one.select("vec_id", "r.*"), "negatives-rows")
    n, n_anchors, dims, least, most = stored.agg(
        F.count(F.lit(1)),
        F.count_if("is_anchor"),
        F.max(F.size("q")),
        F.min(F.array_min("q")),
        F.max(F.array_max("q")),
    ).first()
    dims, bits = dims or 0, 1 + max(int(-(least or 0) - 1).bit_length() if (least or 0) < 0 else 0, int(max(most or 0, 0)).bit_length())
    sides = (max(1, math.ceil(n_anchors / anchor_rows)), max(1, math.ceil(n / candidate_rows), _tasks(spark, n)))

    def packed(batches):
        for batch in batches:
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            values = np.zeros((batch.num_rows, dims), dtype=np.int32)
            values[np.repeat(np.arange(batch.num_rows), sizes), _places(sizes)] = flat
            planes = planes_of(values, bits).transpose(2, 0, 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(3),
                    pa.array([p.tobytes() for p in planes], pa.binary()),
                    pa.array([v.tobytes() for v in values], pa.binary()),
                ],
                names=["vec_id", "label", "is_anchor", "planes", "values"],
            )

    schema = "vec_id long, label long, is_anchor boolean, planes binary, values binary"
    ready = written(stored.mapInArrow(packed, schema), "negatives-planes")
    candidates = ready.select("vec_id", "label", "planes")
    anchors = ready.filter("is_anchor").select(F.col("vec_id").alias("anchor_id"), "label", "values")
    near = _grid(anchors, candidates, sides, _positives(bits, dims, positives), "anchor_id long, positive_id long, positive_score long")
    best = _best(near, ["anchor_id"], "positive_score", "positive_id", positives)
    goals = best.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    asked = written(anchors.join(goals, "anchor_id"), "negatives-positives")  # few positives each
    found = _grid(
        asked, candidates, sides, _negatives(bits, dims, negatives, low, high),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    return _best(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _places(sizes: np.ndarray) -> np.ndarray:
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _tasks(spark: SparkSession, n: int) -> int:
    """As many slabs as there are shuffle partitions, but none of fewer than 512 rows on average."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / 512))
