"""Substring deduplication by level-wise doubling of repeated word windows.

Windows of ``window`` words can only repeat if every shorter window in them does. So windows of a
quarter of the length are counted first, those found repeated are doubled and counted again, and
only what is left reaches the full length. At the shorter lengths each full window is
represented by its least window (by hash), the same one in equal windows wherever they stand; that
keeps one in eight positions and loses no repetition.

Texts are dealt by document into a bucketed table once. What a level finds per document is joined
with that table bucket by bucket, so no later step shuffles a text.

Full windows are shuffled as stretches that are cut where a window's hash says so: equal
stretches collapse to their first occurrence before single windows are looked at.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm.words import SPACED, Words, batch_words, mix
from loomtext.operators.scale import scratch_path, written

WINDOW = 20
SHORTEST = 5
CUT = 16  # windows in a stretch on average
BUCKET_BYTES = 64 * 1024 * 1024  # of text in a bucket, as far as MOST_BUCKETS allow
MOST_BUCKETS = 100_000  # Spark's own limit
COPIES = 1000  # equal rows that one task writes out at once


def _anchors(w: Words, size: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word: the place of the least short window in the full one that starts there, the
    hash of the short window at the word itself, and whether the full one ends inside its row."""
    hashes, _ = w.windows(size)
    n = len(hashes)
    whole = w.at + window <= np.diff(w.bounds)[w.row]
    best, place = hashes, np.arange(n)
    seen, wanted = 1, window - size + 1
    while seen < wanted:  # the least of twice as many short windows each time; of equal ones, the first
        step = min(seen, wanted - seen)
        if step >= n:
            break
        less = best[step:] < best[:-step]
        best = np.append(np.where(less, best[step:], best[:-step]), best[-step:])
        place = np.append(np.where(less, place[step:], place[:-step]), place[-step:])
        seen += step
    return place, hashes, whole


def _candidates(w: Words, seen: list | None, size: int, window: int) -> np.ndarray:
    """Words that start a full window whose least window of ``size`` words is repeated."""
    place, _, whole = _anchors(w, size, window)
    repeated = np.zeros(len(w.hashes) + 1, dtype=bool)
    for r in range(w.rows):
        if seen[w.first + r] is not None:
            repeated[w.bounds[r] + np.asarray(seen[w.first + r], dtype=np.int64)] = True
    return whole & repeated[place]


def _places(docs: DataFrame, size: int, before: int | None, window: int, counts: bool) -> DataFrame:
    """Anchors of one level among the windows that are left: counted hashes, or their places."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = batch.column(3).to_pylist() if before else None
            for w in batch_words(batch.column(2), SPACED):
                place, hashes, whole = _anchors(w, size, window)
                chosen = whole if before is None else _candidates(w, seen, before, window)
                marked = np.zeros(len(hashes), dtype=bool)
                marked[place[chosen]] = True
                at = np.flatnonzero(marked)
                hashes = hashes[at]
                if counts:
                    values, n = np.unique(hashes, return_counts=True)
                    columns = [pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, names=["h", "n"])
                else:
                    rows = pa.array(w.first + w.row[at])
                    columns = [hashes.view(np.int64), batch.column(0).take(rows), batch.column(1).take(rows), w.at[at].astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "id", "mark", "at"])

    return docs.mapInArrow(emit, "h long, n long" if counts else "h long, id long, mark long, at int")


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of ``id, mark, text`` as a stored table of buckets by id and mark, with ``copies``.

    Equal rows are folded into one before the shuffle if there are any, so that no key is hot.
    There are as many buckets as a shuffle has partitions at least, as Spark would else deal the
    table anew for a join. The table lies in the shared folder; its name is taken out of the catalog.
    """
    spark = rows.sparkSession
    keys = rows.groupBy("id", "mark").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("size"))
    most, size = keys.agg(F.max("n"), F.sum("size")).first()
    if (most or 1) == 1:
        rows = rows.withColumn("copies", F.lit(1).cast("long"))
    else:
        rows = rows.groupBy("id", "mark", "text").agg(F.count(F.lit(1)).alias("copies"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    buckets = max(partitions, int(first or 1), math.ceil((size or 0) / BUCKET_BYTES))
    buckets = min(buckets, MOST_BUCKETS)
    name = f"substring_texts_{uuid.uuid4().hex}"
    writer = rows.repartition(buckets, "id", "mark").write.bucketBy(buckets, "id", "mark")
    writer.option("path", scratch_path(spark, "substring-texts")).saveAsTable(name, format="parquet")
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return table


def _joined(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """What was found per document beside its text; only ``found`` is shuffled."""
    return docs.join(found.hint("shuffle_hash"), ["id", "mark"], how)


def _repeated_places(docs: DataFrame, size: int, before: int | None, window: int) -> DataFrame:
    """Per document, the places of the anchors that occur twice: ``id, mark, seen``."""
    counted = _places(docs, size, before, window, counts=True).groupBy("h").agg(F.sum("n").alias("n"))
    twice = written(counted.filter("n > 1").select("h"), "windows-twice")
    places = _places(docs, size, before, window, counts=False).join(twice, "h")
    return written(places.groupBy("id", "mark").agg(F.collect_set("at").alias("seen")), "windows-seen")


def _stretches(docs: DataFrame, before: int, window: int, spell: bool) -> DataFrame:
    """Stretches of full windows that are left: ``key, n, id, mark, at`` and their hashes."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = batch.column(3).to_pylist()
            for w in batch_words(batch.column(2), SPACED):
                hashes, _ = w.windows(window)
                start = np.flatnonzero(_candidates(w, seen, before, window))
                if not len(start):
                    continue
                h = hashes[start]
                new = np.ones(len(start), dtype=bool)
                new[1:] = (np.diff(start) > 1) | (w.row[start[1:]] != w.row[start[:-1]]) | (h[:-1] % np.uint64(CUT) == 0)
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(start)))
                place = np.arange(len(start)) - np.repeat(first, n)
                key = mix(np.add.reduceat(mix(h + mix(place.astype(np.uint64))), first))
                rows = pa.array(w.first + w.row[start[first]])
                columns = [
                    pa.array(key.view(np.int64)),
                    pa.array(n.astype(np.int32)),
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array(w.at[start[first]].astype(np.int32)),
                ]
                names = ["key", "n", "id", "mark", "at"]
                if spell:
                    columns.append(pa.array([h[a : a + k].tobytes() for a, k in zip(first, n, strict=True)], type=pa.binary()))
                    names.append("hashes")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(emit, "key long, n int, id long, mark long, at int" + (", hashes binary" if spell else ""))


def _single(stretches: DataFrame) -> DataFrame:
    """The windows of stretches: ``h, id, mark, at``."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            n = batch.column(4).to_numpy()
            rows = np.repeat(np.arange(len(batch)), n)
            place = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
            h = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype=np.int64)
            at = (batch.column(2).to_numpy()[rows] + place).astype(np.int32)
            take = pa.array(rows)
            columns = [pa.array(h), batch.column(0).take(take), batch.column(1).take(take), pa.array(at)]
            yield pa.RecordBatch.from_arrays(columns, names=["h", "id", "mark", "at"])

    return stretches.select("id", "mark", "at", "hashes", "n").mapInArrow(emit, "h long, id long, mark long, at int")


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document of ``id, mark, text``: the stretches of windows that start earlier elsewhere.

    Returns ``id, mark, spans`` (array of place and number of windows), for documents with any.
    """
    sizes = [window]
    while sizes[0] // 2 >= SHORTEST:
        sizes.insert(0, sizes[0] // 2)
    if len(sizes) == 1:
        sizes.insert(0, window)
    left, before = docs, None
    for size in sizes[:-1]:
        left = _joined(docs, _repeated_places(left, size, before, window), "inner").select("id", "mark", "text", "seen")
        before = size
    place = F.struct("id", "mark", "at")
    firsts = written(
        _stretches(left, before, window, spell=True)
        .groupBy("key", "n")
        .agg(F.min(F.struct("id", "mark", "at", "hashes")).alias("f"))
        .select("key", "n", "f.id", "f.mark", "f.at", "f.hashes"),
        "windows-first",
    )
    heads = written(firsts.select("key", "n", place.alias("first")), "windows-heads")
    whole = _stretches(left, before, window, spell=False).join(heads, ["key", "n"]).filter(place != F.col("first"))
    known = _single(firsts).groupBy("h").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("c"))
    known = written(known.filter("c > 1").select("h", "first"), "windows-known")
    single = _single(firsts).join(known, "h").filter(place != F.col("first")).withColumn("n", F.lit(1))
    spans = whole.select("id", "mark", "at", "n").union(single.select("id", "mark", "at", "n"))
    return written(spans.groupBy("id", "mark").agg(F.collect_list(F.struct("at", "n")).alias("spans")), "windows-spans")


def dedup_substrings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """Every document without the words of windows that start earlier in the table.

    Words are runs between ASCII white space, unchanged. A word goes if a window of ``window``
    consecutive words that covers it also starts earlier: in a document with a smaller id, or
    further up in the same one. Windows are judged on the input.

    Returns ``doc_id, n_words, n_removed, text`` (the words left, joined by one space), one row per
    input row. Null texts have no words and give empty texts. Rows with a null id are left whole
    and remove nothing. Equal rows with one id are one occurrence; rows that share an id but not
    a text are ordered by a hash of the text. Other columns are ignored; an empty table gives an
    empty result. Windows are compared by 64-bit hashes.
    """
    rows = _dealt(
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            F.xxhash64(text_col).alias("mark"),
            F.col(text_col).cast("string").alias("text"),
        )
    )
    spans = repeated_windows(rows.filter("id IS NOT NULL").drop("copies"), window)
    marked = _joined(rows, spans, "left").select("id", "text", "spans", "copies")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, texts = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                words = (text.as_py() or "").encode().split()  # bytes are split at ASCII white space
                n = len(words)
                if spans:
                    edges = np.zeros(n + 1, dtype=np.int64)
                    for s in spans:
                        edges[s["at"]] += 1
                        edges[s["at"] + s["n"] + window - 1] -= 1
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]
                counts.append(n)
                removed.append(n - len(words))
                texts.append(b" ".join(words).decode())
            columns = [batch.column(0), pa.array(counts, type=pa.int64()), pa.array(removed, type=pa.int64()), pa.array(texts, type=pa.string()), batch.column(3)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "copies"])

    names = ["doc_id", "n_words", "n_removed", "text"]
    left = marked.mapInArrow(strip, "doc_id long, n_words long, n_removed long, text string, copies long")
    if rows.filter("copies > 1").isEmpty():
        return left.select(*names)
    # Folded rows are written out again by many tasks.
    part = F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES))
    parts = left.withColumn("part", F.explode(part)).hint("rebalance")
    more = F.least(F.lit(COPIES).cast("long"), F.col("copies") - F.col("part") * COPIES)
    return parts.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), more))).select(*names)
