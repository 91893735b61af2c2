"""Benchmark decontamination: a prefix-filtered set join over shingles, verified word by word.

Every item is cut into windows of ``window`` words; a document is contaminated where it holds all
shingles of a window in their order. As containment needs every shingle, one is enough as the
necessary prefix: the window's rarest in the documents. Documents look their shingles up among
those; the place of the shingle in the window then gives the only start that can match, the
document's length bounds it, and the words themselves are compared.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.llm.words import PLAIN_LOWER, batch_words
from loomtext.operators.scale import written

SHINGLE = 3  # words, fewer in shorter windows
# Windows that go to every task at once; a larger set of items takes one pass per block.
BLOCK = 50_000

_SPAN = "array<struct<start:int,end:int>>"


def _item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """The windows of all items: ``item_id`` (string), ``words`` (joined by one space), once each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for w in batch_words(batch.column(1), PLAIN_LOWER):
                for r in range(w.rows):
                    first, last = int(w.bounds[r]), int(w.bounds[r + 1])
                    words = w.text(first, last)
                    starts = range(max(1, len(words) - window + 1)) if words else ()
                    found += [b" ".join(words[i : i + window]).lower() for i in starts]
                    ids += [batch.column(0)[w.first + r].as_py()] * len(starts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, type=pa.string()), pa.array(found, type=pa.binary())], names=["item_id", "words"]
            )

    rows = items.select(
        items[item_id].cast("string").alias("item_id"), items[text].cast("string").alias("text")
    )
    return rows.mapInArrow(cut, "item_id string, words binary").distinct()


def _blocks(windows: DataFrame, most: int) -> list[DataFrame]:
    """The windows in parts of at most ``most`` rows."""
    n = windows.count()
    parts = max(1, -(-n // most))
    while True:
        dealt = windows.withColumn(
            "_block", F.pmod(F.xxhash64("item_id", "words"), F.lit(parts)).cast("int")
        )
        largest = dealt.groupBy("_block").count().agg(F.max("count")).scalar()
        if parts == 1 or dealt.select(largest.alias("n")).limit(1).first()["n"] <= most:
            return [dealt.filter(F.col("_block") == b).drop("_block") for b in range(parts)]
        parts *= 2


class _Windows:
    """The windows of a block, by their words, with hashes as ``batch_words`` makes them."""

    def __init__(self, rows: list[Row]):
        items: dict[bytes, list[str]] = defaultdict(list)
        for r in rows:
            named = items[bytes(r["words"])]  # an item without an id has windows too
            if r["item_id"] is not None:
                named.append(r["item_id"])
        self.words = sorted(items)
        self.items = [sorted(items[w]) for w in self.words]
        texts = pa.array([w.decode() for w in self.words], type=pa.string())
        self.hashes: list[np.ndarray] = []
        self.shingles: list[np.ndarray] = []
        for w in batch_words(texts, PLAIN_LOWER):
            sizes = np.diff(w.bounds)
            grams = {s: w.windows(s)[0] for s in {min(SHINGLE, int(n)) for n in sizes}}
            for r in range(w.rows):
                a, n = int(w.bounds[r]), int(sizes[r])
                size = min(SHINGLE, n)
                self.hashes.append(w.hashes[a : a + n].copy())
                self.shingles.append(grams[size][a : a + n - size + 1].copy())

    def size(self, i: int) -> int:
        return min(SHINGLE, len(self.hashes[i]))


class _Lookup:
    """Sorted hashes behind a table of their first bits."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        self.bits = np.zeros(1 << 20, dtype=bool)
        self.bits[self.values >> np.uint64(44)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes that are known, and their ranks."""
        if not len(self.values):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        at = np.flatnonzero(self.bits[hashes >> np.uint64(44)])
        rank = np.searchsorted(self.values, hashes[at])
        rank[rank == len(self.values)] = 0
        same = self.values[rank] == hashes[at]
        return at[same], rank[same]


def _shingle_counts(texts: DataFrame, windows: _Windows) -> dict[int, int]:
    """How often each shingle of a block occurs in the documents (at most a row per shingle)."""
    known: dict[int, list[np.ndarray]] = defaultdict(list)
    for i, shingles in enumerate(windows.shingles):
        known[windows.size(i)].append(shingles)
    shared = texts.sparkSession.sparkContext.broadcast(
        {size: _Lookup(np.concatenate(s)) for size, s in known.items()}
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {size: np.zeros(len(k.values), dtype=np.int64) for size, k in shared.value.items()}
        for batch in batches:
            for w in batch_words(batch.column(0), PLAIN_LOWER):
                for size, lookup in shared.value.items():
                    hashes, whole = w.windows(size)
                    _, ranks = lookup.find(hashes[whole])
                    totals[size] += np.bincount(ranks, minlength=len(lookup.values))
        for size, lookup in shared.value.items():
            seen = np.flatnonzero(totals[size])
            yield pa.RecordBatch.from_arrays(
                [pa.array(lookup.values[seen].view(np.int64)), pa.array(totals[size][seen])], names=["shingle", "n"]
            )

    counted = texts.select("text").mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    return {r["shingle"] & 0xFFFFFFFFFFFFFFFF: r["n"] for r in counted.collect()}


def _prefixes(windows: _Windows, counts: dict[int, int]) -> dict[int, tuple[_Lookup, list[list[tuple[int, int]]]]]:
    """By shingle size: the rarest shingle of every window, and (window, place in it) of each."""
    by_size: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
    for i, shingles in enumerate(windows.shingles):
        if not all(int(s) in counts for s in shingles):
            continue  # a shingle that no document has
        place = min(range(len(shingles)), key=lambda p: (counts[int(shingles[p])], int(shingles[p]), p))
        by_size[windows.size(i)][int(shingles[place])].append((i, place))
    out = {}
    for size, entries in by_size.items():
        lookup = _Lookup(np.array(list(entries), dtype=np.uint64))
        out[size] = lookup, [entries[int(v)] for v in lookup.values]
    return out


def _hits(w, windows: _Windows, prefixes: dict) -> Iterator[tuple[int, int, int]]:
    """Verified occurrences in a slice: (row of the slice, first word's number there, window)."""
    sizes = np.diff(w.bounds)
    for size, (lookup, entries) in prefixes.items():
        hashes, _ = w.windows(size)
        at, ranks = lookup.find(hashes)
        if not len(at):
            continue
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks, prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            for i, place in entries[ranks[a]]:
                wanted = windows.hashes[i]
                n = len(wanted)
                number = w.at[at[a:b]] - place
                inside = (number >= 0) & (number + n <= sizes[w.row[at[a:b]]])
                first = at[a:b][inside] - place
                same = (w.hashes[first[:, None] + np.arange(n)] == wanted).all(axis=1)
                for f in first[same]:
                    if b" ".join(w.text(f, f + n)).lower() == windows.words[i]:
                        yield int(w.row[f]), int(w.at[f]), i


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    block: int = BLOCK,
) -> DataFrame:
    """The words of every document that stand in an occurrence of an item's window.

    Words are runs of letters, digits and bytes beyond ASCII, A-Z lower-cased. A window is
    ``window`` consecutive words of an item; an item with fewer words is one window.

    Returns ``doc_id, n_words, spans, item_ids``: one row per input row, the covered stretches of
    words (start, end exclusive, apart from each other, in order) and the ids of the items with a
    window in it, as strings, sorted. Documents
    are never shuffled; items go to the tasks in blocks of a proven size, one pass per block.

    Null texts have no words. Null ids and repeated rows are rows like others. Items without
    words are ignored, repeated items count once; those without an id count for the spans, but are
    not among ``item_ids``. Empty tables give no rows, or no hits. Other
    columns are ignored, whatever their names.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    found = rows.withColumns(
        {"n_words": F.lit(0), "spans": F.array().cast(_SPAN), "item_ids": F.array().cast("array<string>")}
    )
    for shared in _searches(rows, _item_windows(items, item_id, item_text, window), block):
        found = _pass(found, shared)
    return found.select("doc_id", "n_words", "spans", "item_ids")


def _searches(texts: DataFrame, windows: DataFrame, block: int) -> Iterator[Broadcast]:
    """Per block of windows: them and their prefixes, for every task."""
    for part in _blocks(written(windows, "item-windows"), block):
        held = _Windows(part.collect())  # at most ``block`` rows
        yield texts.sparkSession.sparkContext.broadcast((held, _prefixes(held, _shingle_counts(texts, held))))


def _pass(found: DataFrame, shared: Broadcast) -> DataFrame:
    names = found.columns

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, prefixes = shared.value
        for batch in batches:
            columns = dict(zip(names, batch.columns, strict=True))
            counts = np.zeros(len(batch), dtype=np.int32)
            spans: dict[int, list] = defaultdict(list)
            seen: dict[int, set] = defaultdict(set)
            for w in batch_words(columns["text"], PLAIN_LOWER):
                counts[w.first : w.first + w.rows] = np.diff(w.bounds)
                for r, at, i in _hits(w, windows, prefixes):
                    spans[w.first + r].append((at, at + len(windows.hashes[i])))
                    seen[w.first + r].update(windows.items[i])
            old_spans, old_items = columns["spans"].to_pylist(), columns["item_ids"].to_pylist()
            for r in spans:
                old = [(s["start"], s["end"]) for s in old_spans[r]]
                old_spans[r] = [{"start": a, "end": b} for a, b in _merged(old + spans[r])]
                old_items[r] = sorted(seen[r].union(old_items[r]))
            columns["n_words"] = pa.array(counts)
            columns["spans"] = pa.array(old_spans, type=columns["spans"].type)
            columns["item_ids"] = pa.array(old_items, type=columns["item_ids"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return found.mapInArrow(mark, T.StructType(found.schema.fields))


def _clean(text: Column, shared: Broadcast) -> Column:
    """Whether no window of a block occurs in the text."""

    @F.arrow_udf("boolean")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        windows, prefixes = shared.value
        for texts in batches:
            kept = np.ones(len(texts), dtype=bool)
            for w in batch_words(texts, PLAIN_LOWER):
                kept[[w.first + r for r, _, _ in _hits(w, windows, prefixes)]] = False
            yield pa.array(kept)

    return clean(text)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    block: int = BLOCK,
) -> DataFrame:
    """The rows of ``docs`` without any hit, with all their columns, as they were.

    Only the texts go to Python; the rows stay where they are. Other cases as in
    ``find_contamination``: a row without words has no hit and stays.
    """
    text = docs[text_col].cast("string")
    searches = _searches(docs.select(text.alias("text")), _item_windows(items, item_id, item_text, window), block)
    for shared in searches:
        docs = docs.filter(_clean(text, shared))
    return docs
