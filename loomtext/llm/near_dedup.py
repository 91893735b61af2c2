"""Near duplicates by HyperMinHash: banded registers, estimated Jaccard, verified full sets.

A text's set is its distinct five-word shingles. Larger sets get HyperMinHash registers (leading
zeros and ten mantissa bits of the least hash per bucket); bands of four registers are buckets. A
pair at the threshold misses all 64 bands with a probability of about 3e-11. Sets too small to fill
the registers share no band reliably; for them the rarest shingles are the buckets, as many as a
pair at the threshold cannot all lack (prefix filtering), which misses nothing.

Pairs are never spelled out within a bucket. Each round, a few members of every bucket (hubs) are
compared with the others that are not in their component yet; then components are merged, buckets
of one component are done, and the rest gets eight times as many hubs. After the first round the
texts that are left are dealt anew, by the rarest shingles of their full sets: a band is shared by
most of a large group of half similar texts, a rare shingle is not. The place of a shared shingle
among the others of its set bounds what two sets can have in common. Jaccard distance is a
metric, so the distances to a bucket's first hub rule out most of the pairs that are left. Shingles
that no other candidate has are in no intersection: the sizes of two sets and of their shared parts
bound their Jaccard, which rules out pairs, and whole members of a bucket, before any comparison.
The first hub cuts each set in two, and both parts bound their share of an intersection.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomtext.llm.graph import hung
from loomtext.llm.words import SPACED_LOWER, Words, batch_words, mix
from loomtext.operators.scale import within_bound, written

SHINGLE, THRESHOLD = 5, 75  # words; hundredths of the union
SMALL = 128  # sets up to this size use their rarest shingles
BOTH = SMALL * 100 // THRESHOLD + 1  # sets that a small one can be linked with
HASHES, BUCKETS, BAND = 8, 32, 4
REGISTERS = HASHES * BUCKETS
MANTISSA = 10
# A linked pair's estimate is lower with a probability under 1e-12 (256 registers).
LEAST_ESTIMATE = 0.55
# Six standard deviations of an estimate at most.
ERROR = 0.2
HUBS = 8  # times as many hubs in each round

_SEEDS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_ONE = np.uint64(1)


def _sets(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row of a slice: (row, hash), sorted by both."""
    hashes, whole = w.windows(SHINGLE)
    sizes = np.diff(w.bounds)
    rows, grams = [w.row[whole]], [hashes[whole]]
    for n in range(1, SHINGLE):  # fewer words: the whole sequence
        short = np.flatnonzero(sizes == n)
        if len(short):
            rows.append(short)
            grams.append(mix(w.windows(n)[0][w.bounds[short]] + np.uint64(n)))
    row, gram = np.concatenate(rows), np.concatenate(grams)
    order = np.lexsort((gram, row))
    row, gram = row[order], gram[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
    return row[new], gram[new]


def registers(row: np.ndarray, gram: np.ndarray, rows: int) -> np.ndarray:
    """HyperMinHash registers of each row's set, 0 for empty buckets."""
    least = np.full(rows * REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for j, seed in enumerate(_SEEDS):
        x = mix(gram ^ seed)
        place = row * REGISTERS + j * BUCKETS + (x & np.uint64(BUCKETS - 1)).astype(np.int64)
        np.minimum.at(least, place, x >> np.uint64(11))
    filled = least != np.iinfo(np.uint64).max
    value = np.where(filled, least, _ONE)  # 53 bits, exact as floats
    length = np.frexp(value.astype(np.float64))[1].astype(np.int64)
    shift = length - 1 - MANTISSA
    right, left = np.maximum(shift, 0).astype(np.uint64), np.maximum(-shift, 0).astype(np.uint64)
    bits = ((value >> right) << left) & np.uint64((1 << MANTISSA) - 1)
    out = ((54 - length).astype(np.uint64) << np.uint64(MANTISSA)) | bits
    return np.where(filled, out, 0).astype("<u2").reshape(rows, REGISTERS)


def estimate(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> float:
    """Jaccard from two registers, less the matches that chance alone would give."""
    used = int(np.count_nonzero((a != 0) | (b != 0)))
    same = int(np.count_nonzero((a == b) & (a != 0)))
    chance = 0.17 * 2.0**-MANTISSA * 4 * n_a * n_b / (n_a + n_b) ** 2
    return max(0.0, same / max(1, used) - chance)


SKETCH = "doc_id long, n int, h1 long, h2 long, registers binary, grams binary"


def _sketches(docs: DataFrame) -> DataFrame:
    """Per row: set size, 128-bit set hash, registers of larger sets, shingles of small ones."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in batch_words(batch.column(1), SPACED_LOWER):
                row, gram = _sets(w)
                n = np.bincount(row, minlength=w.rows)
                sums = [np.zeros(w.rows, dtype=np.uint64) for _ in range(2)]
                for total, seed in zip(sums, (np.uint64(11), np.uint64(12)), strict=True):
                    np.add.at(total, row, mix(gram + mix(np.full(1, seed))))
                large = n > SMALL
                rank = np.cumsum(large) - 1
                mine = large[row]
                found = registers(rank[row[mine]], gram[mine], int(large.sum()))
                ends = np.append(0, np.cumsum(n))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(w.first, w.rows),
                        pa.array(n.astype(np.int32)),
                        *(pa.array(s.view(np.int64)) for s in sums),
                        pa.array([found[rank[r]].tobytes() if large[r] else None for r in range(w.rows)], type=pa.binary()),
                        pa.array(
                            [gram[ends[r] : ends[r + 1]].tobytes() if 0 < n[r] <= BOTH else None for r in range(w.rows)],
                            type=pa.binary(),
                        ),
                    ],
                    names=["doc_id", "n", "h1", "h2", "registers", "grams"],
                )

    return docs.mapInArrow(sketch, SKETCH)


def _bands(classes: DataFrame) -> DataFrame:
    """Buckets of larger sets: ``key, rep``."""

    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_bands = REGISTERS // BAND
        for batch in batches:
            if not len(batch):
                continue
            data = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype="<u2").reshape(-1, n_bands, BAND)
            packed = np.ascontiguousarray(data).view("<u8").reshape(-1, n_bands)
            keys = mix(mix(packed) + np.arange(1, n_bands + 1, dtype=np.uint64))
            used = packed != 0
            reps = np.repeat(batch.column(0).to_numpy(), n_bands).reshape(-1, n_bands)
            yield pa.RecordBatch.from_arrays([pa.array(keys[used].view(np.int64)), pa.array(reps[used])], names=["key", "rep"])

    return classes.filter("registers IS NOT NULL").select("rep", "registers").mapInArrow(band, "key long, rep long")


def _spelled(classes: DataFrame) -> DataFrame:
    """The stored shingles of classes: ``key, rep``."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(g, dtype=np.int64) for g in batch.column(1).to_pylist()]
            sizes = [len(s) for s in sets]
            grams = np.concatenate(sets) if sets else np.zeros(0, dtype=np.int64)
            reps = np.repeat(batch.column(0).to_numpy(), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(reps)], names=["key", "rep"])

    return classes.filter("grams IS NOT NULL").select("rep", "grams").mapInArrow(spell, "key long, rep long")


def _rarest(classes: DataFrame) -> DataFrame:
    """Buckets of small sets: their rarest shingles, as many as no link can do without."""
    small = _spelled(classes)
    shared = written(small.groupBy("key").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "near-shingles")
    counted = small.join(shared, "key", "left").select("rep", F.struct(F.coalesce("df", F.lit(1)).alias("df"), "key").alias("g"))
    n = F.size("g")
    needed = n - F.ceil(n * THRESHOLD / 100).cast("int") + 1
    return (
        counted.groupBy("rep")
        .agg(F.array_sort(F.collect_list("g")).alias("g"))  # at most BOTH entries
        .select("rep", F.explode(F.slice("g", F.lit(1), needed)).alias("g"))
        .filter("g.df > 1")
        .select("g.key", "rep")
    )


def _shared_sizes(classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Per class ``rep, n, s``: the size of its set and of the part that other classes have too.

    Where rows repeat an id, the set is not known to be that of the text: ``s`` counts it whole.
    ``single`` tells whether the id has one set all the same, as its texts are equal.
    """
    spelled = _all_spelled(classes, texts)
    alone = spelled.groupBy("key").agg(F.count(F.lit(1)).alias("df"), F.min("rep").alias("rep")).filter("df = 1")
    own = alone.groupBy("rep").agg(F.count(F.lit(1)).alias("own"))
    sizes = classes.groupBy("rep").agg(F.min("n").alias("n"), F.max("n").alias("s"), F.count(F.lit(1)).alias("sets"))
    mark = F.xxhash64("text")
    rows = texts.groupBy("rep").agg(F.count(F.lit(1)).alias("rows"), (F.min(mark) == F.max(mark)).alias("equal"))
    known = sizes.join(own, "rep", "left").join(rows, "rep", "left")
    one = (F.col("sets") == 1) & (F.coalesce("rows", F.lit(1)) == 1)
    shared = F.col("s") - F.when(one, F.coalesce("own", F.lit(0))).otherwise(F.lit(0))
    single = (F.col("sets") == 1) & F.coalesce("equal", F.lit(True))
    return known.select(
        "rep", F.col("n").cast("long").alias("n"), shared.cast("long").alias("s"), single.alias("single")
    )


def _all_spelled(classes: DataFrame, texts: DataFrame) -> DataFrame:
    """The shingles of classes, from their texts where they are not stored: ``key, rep``."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in batch_words(batch.column(1), SPACED_LOWER):
                row, gram = _sets(w)
                long = np.bincount(row, minlength=w.rows)[row] > BOTH
                reps = batch.column(0).take(pa.array(w.first + row[long]))
                yield pa.RecordBatch.from_arrays([pa.array(gram[long].view(np.int64)), reps], names=["key", "rep"])

    return texts.select("rep", "text").mapInArrow(spell, "key long, rep long").union(_spelled(classes))


def _rare_parts(sizes: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Buckets by the rarest shingles of full sets, as many as no link can do without.

    ``sizes`` names the classes (``rep, n, s, single``); added are ``key`` and ``left``, the shingles
    of the set from that one on. Linked sets have a first shingle in common, and all that they share
    is left there. Shingles of one class only come before and take part in no bucket. Where an id
    has several sets, all shingles are buckets and the whole set counts as left.
    """
    reps = sizes.select("rep")
    spelled = _all_spelled(_semi(classes, reps, "rep"), _semi(texts, reps, "rep"))
    shared = written(spelled.groupBy("key").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "near-common")
    found = spelled.join(F.broadcast(shared) if within_bound(shared) else shared, "key")
    listed = found.groupBy("rep").agg(F.array_sort(F.collect_set(F.struct("df", "key"))).alias("g"))  # of one text
    placed = listed.join(sizes, "rep").select("rep", "n", "s", "single", F.size("g").alias("size"), F.posexplode("g").alias("i", "g"))
    left = F.when(F.col("single"), F.col("size") - F.col("i")).otherwise(F.col("s"))
    parts = placed.select(F.col("g.key").alias("key"), "rep", "n", "s", left.cast("long").alias("left"))
    return parts.filter(F.col("left") * 100 >= F.col("n") * THRESHOLD)


def _compared(pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) with ``linked`` and bounds of their distance ``low, high``.

    Exact by their shingles where those are stored; else by estimate, and where that leaves the
    pair open, exact by their texts.
    """
    side = classes.select("rep", F.struct("n", "registers", "grams").alias("s"))
    sized = _lookup(_lookup(pairs, side, "a"), side, "b")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                share = min(a["n"], b["n"]) / max(a["n"], b["n"])
                if a["grams"] is not None and b["grams"] is not None:
                    x, y = (np.frombuffer(s["grams"], dtype=np.uint64) for s in (a, b))
                    found.append(_judged(x, y))
                elif 100 * share < THRESHOLD - 1e-9:
                    found.append((False, 1 - share, 1.0))
                else:
                    x, y = (np.frombuffer(s["registers"], dtype="<u2") for s in (a, b))
                    j = estimate(x, y, a["n"], b["n"])
                    found.append((None if j >= LEAST_ESTIMATE else False, max(0.0, 1 - j - ERROR), min(1.0, 1 - j + ERROR)))
            yield _verdicts(batch, found)

    shape = "a long, b long, linked boolean, low double, high double"
    judged = written(sized.select("a", "b", "s_a", "s_b").mapInArrow(judge, shape), "near-judged")
    words = texts.select("rep", F.col("text").alias("s"))
    open_pairs = judged.filter("linked IS NULL").select("a", "b")
    with_texts = _lookup(_lookup(open_pairs, words, "b"), words, "a")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (list(_row_sets(batch.column(c))) for c in (2, 3))
            yield _verdicts(batch, [_judged(x, y) for x, y in zip(left, right, strict=True)])

    verified = with_texts.select("a", "b", "s_a", "s_b").mapInArrow(verify, shape)
    return judged.filter("linked IS NOT NULL").union(verified)


def _verdicts(batch: pa.RecordBatch, found: list[tuple[bool | None, float, float]]) -> pa.RecordBatch:
    kinds = (pa.bool_(), pa.float64(), pa.float64())
    columns = [pa.array([f[i] for f in found], type=t) for i, t in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), *columns], names=["a", "b", "linked", "low", "high"]
    )


def _judged(x: np.ndarray, y: np.ndarray) -> tuple[bool, float, float]:
    common = len(np.intersect1d(x, y, assume_unique=True))
    union = len(x) + len(y) - common
    distance = 1 - common / union
    return 100 * common >= THRESHOLD * union, distance, distance


def _row_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    for w in batch_words(texts, SPACED_LOWER):
        row, gram = _sets(w)
        ends = np.searchsorted(row, np.arange(w.rows + 1))
        yield from (gram[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True))


def _lookup(pairs: DataFrame, side: DataFrame, end: str) -> DataFrame:
    """Pairs with ``s`` of one end; Spark splits an end that very many pairs share."""
    return pairs.join(side.select(F.col("rep").alias(end), F.col("s").alias(f"s_{end}")), end)


def _semi(big: DataFrame, small: DataFrame, key: str) -> DataFrame:
    return big.join(F.broadcast(small) if within_bound(small) else small, key, "left_semi")


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with its component of near duplicates.

    Words are runs between ASCII white space, A-Z lower-cased; the set is the distinct windows of
    five words, or the whole sequence if it is shorter. Two documents are linked if their sets
    share three quarters of their union. Equal sets are one class, represented by their smallest
    id. Links are confirmed on the full sets (as 64-bit hashes of the shingles).

    Returns ``doc_id, n_shingles, component_id`` (the smallest id reachable by links, its own
    included) and ``kept`` (it is that id), one row per input row. Texts without words, and null
    texts, have no shingles and are linked with nothing. Rows with a null id are linked with
    nothing either; their component is null and they are kept. Rows that repeat an id are judged
    each by its own text, but stand for one document where both represent their class. Other
    columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketches = written(_sketches(rows), "near-sketches")
    able = sketches.filter("n > 0 AND doc_id IS NOT NULL")
    classes = written(
        able.groupBy("h1", "h2")
        .agg(F.min(F.struct("doc_id", "n", "registers", "grams")).alias("r"))
        .select("h1", "h2", F.col("r.doc_id").alias("rep"), "r.n", "r.registers", "r.grams"),
        "near-classes",
    )
    buckets = _bands(classes).union(_rarest(classes))
    hubs = written(
        buckets.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).filter("hub < last").select("key"),
        "near-keys",
    )
    members = written(buckets.join(hubs, "key", "left_semi").distinct(), "near-members")
    reps = written(members.select("rep").distinct(), "near-reps")
    chosen = written(_semi(classes.select("rep", "n", "registers", "grams"), reps, "rep"), "near-chosen")
    long_reps = chosen.filter("registers IS NOT NULL").select("rep")
    texts = written(
        _semi(rows.select(F.col("doc_id").alias("rep"), "text"), written(long_reps, "near-long"), "rep"), "near-texts"
    )
    sizes = written(_shared_sizes(chosen, texts).filter(f"100 * s >= {THRESHOLD} * n"), "near-sizes")
    sized = members.join(F.broadcast(sizes) if within_bound(sizes) else sizes, "rep")
    found = _connect(sized.select("key", "rep", "n", "s", F.col("s").alias("left")), sizes, chosen, texts)
    marked = classes.select("h1", "h2", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    marked = written(
        marked.select("h1", "h2", F.coalesce("component", "rep").alias("component_id")), "near-components"
    )
    joined = sketches.select("doc_id", "n", "h1", "h2").join(marked, ["h1", "h2"], "left")
    own = (F.col("n") == 0) | F.col("doc_id").isNull()
    component = F.when(own, F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def _connect(members: DataFrame, sizes: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Components of the linked classes: ``node, component``, without the smallest nodes."""
    seen = _no_pairs(members, "a", "b")  # pairs that have been compared
    found = _no_pairs(members, "node", "component")
    found, seen, waiting = _rounds(members, found, seen, classes, texts, most_hubs=1)
    reps = written(waiting.select("rep").distinct(), "near-open")
    if reps.isEmpty():
        return found
    parts = _rare_parts(written(_semi(sizes, reps, "rep"), "near-open-sizes"), classes, texts)
    return _rounds(written(parts, "near-parts"), found, seen, classes, texts)[0]


def _no_pairs(members: DataFrame, *names: str) -> DataFrame:
    """No rows, by a filter that Spark plans away: an empty list given to Spark would be read by
    Python workers of their own in every executor, beside those of the sets."""
    return members.select(*(F.col("rep").alias(n) for n in names)).filter(F.lit(False))


def _rounds(
    members: DataFrame,
    found: DataFrame,
    seen: DataFrame,
    classes: DataFrame,
    texts: DataFrame,
    most_hubs: int | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Compare hubs of buckets until no bucket holds two components, or ``most_hubs`` have been.

    Returns the components found, the pairs compared and the members of buckets that are left.
    """
    # Members of a bucket that have not been its hub, bounds of their distance to its first, and the
    # most that they have in common with it (top) and with others apart from it (rest).
    waiting = members.withColumns(
        {"low": F.lit(0.0), "high": F.lit(1.0), "top": F.col("s").cast("double"), "rest": F.lit(0.0)}
    )
    kept = ("key", "rep", "n", "s", "left", "low", "high", "top", "rest")
    n_hubs = 1
    while True:
        home = waiting.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
            *kept, F.coalesce("component", "rep").alias("c")
        )
        home = written(home, "near-home")
        mixed = home.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y"), F.min("n").alias("least"))
        mixed = mixed.filter("x < y").select("key", "least")
        room = _may_link(F.least("s", "left"), F.col("n") + F.col("least"))
        waiting = written(home.join(mixed, "key").filter(room).drop("least"), "near-waiting")
        if waiting.isEmpty() or most_hubs and n_hubs > most_hubs:
            return found, seen, waiting
        # The text that others have most of comes first; cut to n_hubs inside each task.
        order = Window.partitionBy("key").orderBy((F.col("n") - F.col("s")) / F.col("n"), "rep")
        hubs = (
            waiting.withColumn("_n", F.row_number().over(order))
            .filter(F.col("_n") <= n_hubs)
            .select("key", *(F.col(x).alias(f"hub_{x}") for x in ("rep", "c", *kept[2:])))
        )
        hubs = written(hubs, "near-hubs")
        limit = 1 - THRESHOLD / 100 + 1e-9
        near = (F.col("hub_low") - F.col("high") <= limit) & (F.col("low") - F.col("hub_high") <= limit)
        apart = (F.col("rep") != F.col("hub_rep")) & (F.col("c") != F.col("hub_c"))
        common, both = F.least("s", "hub_s"), F.col("n") + F.col("hub_n")
        parts = F.least("top", "hub_top") + F.least("rest", "hub_rest")
        most = F.least(common, parts, "left", "hub_left")
        met = waiting.join(hubs, "key").filter(apart & near & _may_link(most, both))
        end = (F.least("rep", "hub_rep").alias("a"), F.greatest("rep", "hub_rep").alias("b"))
        pairs = written(met.select(*end).distinct().join(seen, ["a", "b"], "left_anti"), "near-pairs")
        compared = written(_compared(pairs, classes, texts), "near-compared")
        new = compared.filter("linked").select("a", "b")
        if not new.isEmpty():
            found = hung(found.select("component", "node").union(new))
        seen = written(seen.union(pairs), "near-seen")
        if n_hubs == 1:  # pairs that were ruled out are at least as far apart as their sizes say
            first = waiting.select("key", "rep", "n", "s", "left").join(hubs, "key").filter("rep <> hub_rep")
            least = F.greatest(F.lit(0.0), 1 - common / (both - common)).alias("least")
            # Where rows repeat an id, n is the least size of its sets and s the largest.
            largest = (F.greatest("n", "s") + F.greatest("hub_n", "hub_s")).alias("largest")
            ended = first.select("key", "rep", "n", "s", "left", *end, least, both.alias("both"), largest)
            ended = ended.join(compared, ["a", "b"], "left").withColumns(
                {"low": F.coalesce("low", "least"), "high": F.coalesce("high", F.lit(1.0))}
            )
            top = F.least(F.col("s"), _common("low", "largest") + 1e-6)
            rest = F.greatest(F.lit(0.0), F.col("s") - _common("high", "both") + 1e-6)
            waiting = ended.withColumns({"top": top, "rest": rest}).select(*kept)
        else:
            used = hubs.select("key", F.col("hub_rep").alias("rep"))
            waiting = waiting.select(*kept).join(used, ["key", "rep"], "left_anti")
        n_hubs *= HUBS


def _common(distance: str, both: str) -> F.Column:
    """The size of an intersection, from the distance and the sum of the set sizes."""
    return F.col(both) * (1 - F.col(distance)) / (2 - F.col(distance))


def _may_link(common: F.Column, both: F.Column) -> F.Column:
    """Whether so large an intersection reaches the threshold, given the sum of the set sizes."""
    return (100 + THRESHOLD) * common >= THRESHOLD * both


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each group (the smallest id), with all columns; null ids stay."""
    found = near_components(docs)
    gone = written(found.filter(~F.col("kept")).select("doc_id").distinct(), "near-gone")
    return docs.join(F.broadcast(gone) if within_bound(gone) else gone, "doc_id", "left_anti")
