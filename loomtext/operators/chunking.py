"""Splitting documents into overlapping chunks."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import (
    CHUNK_ID_FORMAT,
    CHUNK_OVERLAP,
    CHUNK_SEPARATORS,
    CHUNK_SIZE,
)
from ..functions.text import let, strip, text_lengths

# Texts of a batch that are cut together, in bytes; a longer text goes alone.
SLICE_BYTES = 1 << 20


def _check(size: int, overlap: int) -> None:
    if size < 1 or overlap < 0 or overlap >= size:
        raise ValueError("overlap must be at least 0 and strictly smaller than size")


def char_windows(text: Column | str, size: int, overlap: int) -> Column:
    """Windows of ``size`` characters, ``overlap`` of them shared, up to the end of the text.

    The text is cut once into steps of size - overlap; a window joins the steps it covers, so the
    work grows with the text and not with its square. Windows are trimmed, blank ones dropped.
    """
    _check(size, overlap)
    step = size - overlap
    covered = -(-size // step)
    text = F.col(text) if isinstance(text, str) else text

    def windows(t: Column) -> Column:
        beyond = F.greatest(F.length(t) - size, F.lit(0))
        last = F.ceil(beyond / step).cast("int") + 1

        def joined(steps: Column) -> Column:
            return F.transform(
                F.sequence(F.lit(1), last),
                lambda i: strip(
                    F.substring(F.array_join(F.slice(steps, i, covered), ""), 1, size)
                ),
            )

        steps = F.regexp_extract_all(t, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
        return F.filter(let(steps, joined), lambda w: w != "")

    return let(F.coalesce(text, F.lit("")), windows)


def _pieces(text: str, separator: str) -> list[str]:
    """Cut in front of every separator, which stays at the head of the next piece."""
    if separator == "":
        return list(text)
    cuts = [m.start() for m in re.finditer(re.escape(separator), text)]
    return [p for p in (text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])) if p]


def _pack(pieces: list[str], size: int, overlap: int) -> list[str]:
    """Join neighbouring pieces up to ``size``, carrying at most ``overlap`` into the next chunk."""
    chunks, first, length = [], 0, 0
    for i, piece in enumerate(pieces):
        if length + len(piece) > size and first < i:
            chunks.append("".join(pieces[first:i]))
            while length > overlap or (length and length + len(piece) > size):
                length -= len(pieces[first])
                first += 1
        length += len(piece)
    chunks.append("".join(pieces[first:]))
    return [c for c in (chunk.strip() for chunk in chunks) if c]


def split_recursive(text: str, size: int, overlap: int, separators: Sequence[str]) -> list[str]:
    """Split by the first separator that occurs; pieces too long for a chunk use the next ones."""
    at = next((i for i, s in enumerate(separators) if s == "" or s in text), len(separators) - 1)
    separator, finer = separators[at], separators[at + 1 :]
    chunks: list[str] = []
    short: list[str] = []
    for piece in _pieces(text, separator):
        if len(piece) < size:
            short.append(piece)
            continue
        chunks += _pack(short, size, overlap)
        short = []
        chunks += split_recursive(piece, size, overlap, finer) if finer else _pack([piece], size, 0)
    return chunks + _pack(short, size, overlap)


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first row, rows) of parts of an Arrow column of about ``SLICE_BYTES`` each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
    lo = 0
    while lo < len(texts):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield lo, hi - lo
        lo = hi


def recursive_chunks(
    df: DataFrame,
    id_col: str | None,
    text_col: str,
    settings: Sequence[tuple[int, int]],
    separators: Sequence[str],
) -> DataFrame:
    """(id, _size, _overlap, _i, _chunk): recursive split of each text by each (size, overlap).

    Works on Arrow batches, some texts at a time, so that a task holds the chunks of about
    ``SLICE_BYTES`` of text whatever its batch; the rows stay where they are.
    """
    for size, overlap in settings:
        _check(size, overlap)
    order = tuple(separators)
    keys = [id_col] if id_col else []
    rows = df.select(*keys, F.col(text_col).alias("_text"))
    fields = [T.StructField(f.name, f.dataType) for f in rows.schema.fields[:-1]]
    for name in ("_size", "_overlap", "_i"):
        fields.append(T.StructField(name, T.IntegerType()))
    fields.append(T.StructField("_chunk", T.StringType()))
    names = [f.name for f in fields]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, n in _slices(batch.column(batch.num_columns - 1)):
                part = batch.slice(lo, n)
                *ids, texts = part.columns
                texts = texts.to_pylist()
                for size, overlap in settings:
                    lists = [split_recursive(t, size, overlap, order) if t else [] for t in texts]
                    counts = [len(x) for x in lists]
                    total = sum(counts)
                    row = pa.array(np.repeat(np.arange(n), counts))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *[c.take(row) for c in ids],
                            pa.array(np.full(total, size, np.int32)),
                            pa.array(np.full(total, overlap, np.int32)),
                            pa.array([i for c in counts for i in range(c)], pa.int32()),
                            pa.array([c for x in lists for c in x], pa.string()),
                        ],
                        names=names,
                    )

    return rows.mapInArrow(split, T.StructType(fields))


def chunk_text(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: Sequence[str] = CHUNK_SEPARATORS,
) -> DataFrame:
    """(id, chunk_no, text): chunks of at most ``size`` characters, numbered from 1 per document.

    Separators are tried in order of preference. With ``[""]`` chunks are plain windows of
    characters and stay in the JVM. No shuffle either way.
    """
    if list(separators) == [""]:
        chunks = char_windows(text_col, size, overlap)
        pieces = df.select(id_col, F.posexplode_outer(chunks).alias("_i", "_chunk"))
    else:
        pieces = recursive_chunks(df, id_col, text_col, [(size, overlap)], separators)
    return (
        pieces.filter(F.col("_chunk").isNotNull())
        .select(id_col, (F.col("_i") + 1).alias("chunk_no"), F.col("_chunk").alias("text"))
    )


def chunk_metadata(chunks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Add the chunk id (unique within its document), source id, length and word count."""
    chunk_id = F.format_string(CHUNK_ID_FORMAT, "chunk_no")
    source_id = F.concat_ws(":", F.col(id_col).cast("string"), chunk_id)
    return chunks.select(
        "*", chunk_id.alias("chunk_id"), source_id.alias("source_id"), *text_lengths("text")
    )


def chunk_summary(chunks: DataFrame, size: int, overlap: int) -> DataFrame:
    return chunks.agg(
        F.lit(size).alias("chunk_size"),
        F.lit(overlap).alias("chunk_overlap"),
        F.count(F.lit(1)).alias("n_chunks"),
        F.round(F.avg(F.length("text")), 1).alias("mean_chars"),
    )


def chunk_size_sweep(
    df: DataFrame,
    sizes: Sequence[int] = (100, 400, 1200),
    overlap_ratio: float = 0.20,
    id_col: str = "doc_id",
    text_col: str = "text",
    separators: Sequence[str] = CHUNK_SEPARATORS,
) -> DataFrame:
    """Chunks and mean words per chunk for several sizes, in one pass over the texts."""
    settings = [(s, int(s * overlap_ratio)) for s in sizes]
    if list(separators) == [""]:
        per_text = df.select(*[char_windows(text_col, *x).alias(f"_{x[0]}") for x in settings])
        runs = F.array(
            *[
                F.struct(
                    F.lit(s).alias("_size"), F.lit(o).alias("_overlap"), F.col(f"_{s}").alias("_chunks")
                )
                for s, o in settings
            ]
        )
        listed = per_text.select(F.inline_outer(runs))
        pieces = listed.select("_size", "_overlap", F.explode_outer("_chunks").alias("_chunk"))
    else:
        pieces = recursive_chunks(df, None, text_col, settings, separators)
    word = text_lengths(F.col("_chunk"))[1]
    return (
        pieces.filter(F.col("_chunk").isNotNull())
        .groupBy(F.col("_size").alias("chunk_size"), F.col("_overlap").alias("chunk_overlap"))
        .agg(F.count(F.lit(1)).alias("n_chunks"), F.round(F.avg(word), 1).alias("mean_words"))
    )


def chunk_audit(
    chunks: DataFrame, indexed: DataFrame, size: int, at_least: int = 5
) -> DataFrame:
    """Counted violations: enough chunks, none empty, none too long, ids present, all indexed."""
    n_indexed = indexed.agg(F.count(F.lit(1)).alias("n")).scalar()
    return chunks.agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.count(F.when(strip("text") == "", 1)).alias("n_empty"),
        F.count(F.when(F.length("text") > size, 1)).alias("n_too_long"),
        F.count(F.when(F.col("chunk_id").isNull(), 1)).alias("n_without_id"),
    ).select(
        "*",
        n_indexed.alias("n_indexed"),
        (F.col("n_chunks") >= at_least).alias("has_enough"),
        (F.col("n_chunks") == n_indexed).alias("is_in_sync"),
    )
