"""Phrase collocations from a weighted de Bruijn graph of words.

The graph's nodes are pairs of neighbouring words, its edges the three-word grams between them.
Each word of a text gives one record: the gram that starts there, cut where its piece ends. Only
these longest grams are counted. A pair's count is the flow out of its node, edges and piece ends
together; a word's count is the flow out of all nodes that start with it, and of the pieces that
end with it. Of the frequent part of the graph unary paths are compacted into one row, in which
neighbours find each other's counts without another join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomtext.llm.words import PIECE_ENDS, PIECED_LOWER, Words, batch_words, mix
from loomtext.operators.scale import lookup_join, written

LEAST = 10  # occurrences of a candidate
COVERED = 50  # percent of a phrase's occurrences in a longer one that make it a part of that
TOP = 2000
UNIT = 1_000_000  # scores are whole numbers of this part

NO_LANG = "und"

# A word is hot if it is more than 1/HOT_WORDS of all, so there are fewer than that. A pair can only
# be hot if both its words are; such pairs are dealt into SALTS parts by the word that follows.
HOT_WORDS, SALTS = 1000, 64

# On average one node in CUT ends a path, so that a path fits into a row whatever the graph.
CUT = 32

HELD_WORDS = 500_000  # different words that a task holds before it gives them on
HELD_EDGES = 1_000_000
BATCH = 100_000
LONG_WORD, SHORT_WORD = 256, 32  # bytes; longer words get a cryptographic hash as key, as check

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LOWER_TABLE = np.frombuffer(_LOWER, dtype=np.uint8)
_ENDS = np.isin(np.arange(256), list(PIECE_ENDS))
_SECOND, _THIRD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


# ---------------------------------------------------------------- words and edges inside a task


def _digest(data: bytes, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8, key=seed.to_bytes(4, "little")).digest(), "little")


def _lang_codes(langs: pa.Array, seed: int) -> np.ndarray:
    coded = langs.dictionary_encode()
    codes = np.array([_digest(v.encode(), seed) for v in coded.dictionary.to_pylist()], dtype=np.uint64)
    return codes[coded.indices.to_numpy()]


def _keyed(langs: pa.Array, texts: pa.Array, seed: int) -> Iterator[tuple[Words, np.ndarray]]:
    """The words of a batch and a key for each, a 64-bit hash of its language and its letters."""
    codes = _lang_codes(langs, seed)
    for w in batch_words(texts, PIECED_LOWER, np.uint64(_digest(b"base", seed) | 1)):
        h = w.hashes.copy()
        for i in np.flatnonzero(w.end - w.start > LONG_WORD):
            h[i] = _digest(w.text(i, i + 1)[0].translate(_LOWER), seed)
        keys = mix(h ^ codes[w.first + w.row])
        keys[keys == 0] = 1  # 0 stands for no word
        yield w, keys


def _continued(w: Words) -> np.ndarray:
    """Whether the next word stands in the same piece."""
    out = np.zeros(len(w.start), dtype=bool)
    ends = np.concatenate([[0], np.cumsum(_ENDS[w.data])])
    out[:-1] = (ends[w.start[1:]] == ends[w.end[:-1]]) & (w.row[1:] == w.row[:-1])
    return out


def _checks(w: Words) -> np.ndarray:
    """32 more bits of each word, from its bytes in blocks of eight."""
    data = _LOWER_TABLE[np.concatenate([w.data, np.zeros(8, np.uint8)])]
    size = w.end - w.start
    out = size.astype(np.uint64)
    for block in range(SHORT_WORD // 8):
        i = np.flatnonzero(size > 8 * block)
        if not len(i):
            break
        some = data[(w.start[i] + 8 * block)[:, None] + np.arange(8)].view("<u8").ravel()
        unused = np.uint64(8) * (8 - np.minimum(size[i] - 8 * block, 8)).astype(np.uint64)
        out[i] = mix((out[i] ^ (some << unused)) * _THIRD + np.uint64(block + 1))
    for i in np.flatnonzero(size > SHORT_WORD):
        out[i] = _digest(w.text(i, i + 1)[0].translate(_LOWER), 1)
    return out >> np.uint64(32)


def _word_counts(seed: int):
    """Counts of words, folded inside the task; a second hash tells words of one key apart."""

    def give(held: dict) -> pa.RecordBatch:
        rows = list(held.values())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.fromiter(held, np.uint64, len(held)).view(np.int64)),
                pa.array([r[0] for r in rows], pa.string()),
                pa.array([r[1].translate(_LOWER).decode("utf-8", "replace") for r in rows], pa.string()),
                pa.array([r[2] for r in rows], pa.int64()),
                pa.array(np.array([r[3] for r in rows], np.uint64).view(np.int64)),
                pa.array(np.array([r[4] for r in rows], np.uint64).view(np.int64)),
            ],
            names=["key", "lang", "word", "n", "low", "high"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            langs = batch.column(0)
            for w, keys in _keyed(langs, batch.column(1), seed):
                if not len(keys):
                    continue
                checks = _checks(w) ^ (_lang_codes(langs, 1)[w.first + w.row] >> np.uint64(32))
                order = np.argsort(keys, kind="stable")
                starts = np.flatnonzero(np.r_[True, np.diff(keys[order].view(np.int64)) != 0])
                sizes = np.diff(np.r_[starts, len(order)])
                low = np.minimum.reduceat(checks[order], starts).tolist()
                high = np.maximum.reduceat(checks[order], starts).tolist()
                places = order[starts]
                for key, i, n, a, b in zip(keys[places].tolist(), places.tolist(), sizes.tolist(), low, high):
                    row = held.get(key)
                    if row is None:
                        held[key] = [langs[w.first + int(w.row[i])].as_py(), w.text(i, i + 1)[0], n, a, b]
                    else:
                        row[2] += n
                        row[3], row[4] = min(row[3], a), max(row[4], b)
                if len(held) > HELD_WORDS:
                    yield give(held)
                    held.clear()
        if held:
            yield give(held)

    return count


def _folded(parts: list[tuple]) -> tuple:
    """Equal edges summed, ordered by their first word (most of its bits), then by a hash."""
    x, y, z, n = (np.concatenate(c) for c in zip(*parts))
    low = mix(x + y * _SECOND + mix(z + _THIRD)) >> np.uint64(32)
    order = np.argsort((x & np.uint64(0xFFFFFFFF00000000)) | low)
    x, y, z, n = x[order], y[order], z[order], n[order]
    # Different edges of one order value may split a sum, which Spark then adds up.
    new = np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (z[1:] != z[:-1])] if len(x) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    return x[starts], y[starts], z[starts], np.add.reduceat(n, starts) if len(starts) else n


def _edge_counts(seed: int):
    """Edges (x, y, z) and their weights, folded inside the task.

    z = 0 is a piece that ends behind x and y. The flow out of a word, folded here already, is the
    record (x, 0, 0); it holds the pieces that end behind x.
    """

    def batches_of(columns: tuple) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(columns[0]), BATCH):
            some = [np.ascontiguousarray(c[lo : lo + BATCH]).view(np.int64) for c in columns]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in some], names=["x", "y", "z", "n"])

    def flow_of(edges: tuple) -> tuple:
        x, n = edges[0], edges[3]
        starts = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
        none = np.zeros(len(starts), np.uint64)
        return x[starts], none, none, np.add.reduceat(n, starts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, flows = [], 0, []
        for batch in batches:
            for w, x in _keyed(batch.column(0), batch.column(1), seed):
                if not len(x):
                    continue
                on = _continued(w)
                y, z = np.zeros_like(x), np.zeros_like(x)
                y[:-1] = np.where(on[:-1], x[1:], 0)
                z[:-2] = np.where(on[:-2] & on[1:-1], x[2:], 0)
                held.append((x, y, z, np.ones(len(x), np.int64)))
                rows += len(x)
                if rows > 2 * HELD_EDGES:
                    held = [_folded(held)]
                    rows = len(held[0][0])
                    if rows > HELD_EDGES:
                        edges = held[0]
                        yield from batches_of(tuple(c[edges[1] != 0] for c in edges))
                        flows = [_folded([*flows, flow_of(edges)])]
                        held, rows = [], 0
                        if len(flows[0][0]) > HELD_WORDS:
                            yield from batches_of(flows.pop())
        if held:
            edges = _folded(held)
            yield from batches_of(tuple(c[edges[1] != 0] for c in edges))
            flows = [_folded([*flows, flow_of(edges)])]
        if flows:
            yield from batches_of(flows[0])

    return count


# ---------------------------------------------------------------- counting


def _vocabulary(texts: DataFrame) -> tuple[DataFrame, int]:
    """(key, lang, word, n) and the seed under which no two words share a key."""
    seed = 0
    while True:
        counted = texts.mapInArrow(
            _word_counts(seed), "key long, lang string, word string, n long, low long, high long"
        )
        words = written(
            counted.groupBy("key").agg(
                F.min("lang").alias("lang"),
                F.min("word").alias("word"),
                F.sum("n").alias("n"),
                (F.min("low") != F.max("high")).alias("clash"),
                F.min("low").alias("_a"),
                F.max("low").alias("_b"),
                F.min("high").alias("_c"),
            ),
            "phrase-words",
        )
        clash = (F.col("_a") != F.col("_b")) | (F.col("_a") != F.col("_c")) | F.col("clash")
        if words.filter(clash).isEmpty():
            return words.select("key", "lang", "word", "n"), seed
        seed += 1


def _flows(texts: DataFrame, words: DataFrame, seed: int, least: int) -> DataFrame:
    """(x, y, z, n): frequent edges, and with z = 0 the flows of frequent pairs and (y = 0) words."""
    total = words.agg(F.sum("n")).first()[0] or 0
    hot = [r[0] for r in words.filter(F.col("n") * HOT_WORDS > total).select("key").collect()]  # < HOT_WORDS
    edges = texts.mapInArrow(_edge_counts(seed), "x long, y long, z long, n long")
    salt = F.when(F.col("x").isin(hot) & F.col("y").isin(hot), F.pmod("z", F.lit(SALTS))).otherwise(-1)
    dealt = edges.withColumn("salt", salt.cast("int")).repartition("x", "y", "salt")
    # Both sums below follow from this one shuffle.
    weights = dealt.groupBy("x", "y", "salt", "z").agg(F.sum("n").alias("n"))
    # One condition on the sum: a condition on z alone would be moved below the shuffle, which
    # the two branches then could not share.
    frequent = weights.filter(F.when(F.col("z") != 0, F.col("n")).otherwise(0) >= least).select("x", "y", "z", "n")
    nodes = weights.groupBy("x", "y", "salt").agg(F.sum("n").alias("n"))
    nodes = nodes.filter((F.col("salt") >= 0) | (F.col("n") >= least))
    return written(frequent.unionByName(nodes.select("x", "y", F.lit(0).cast("long").alias("z"), "n")), "phrase-counts")


# ---------------------------------------------------------------- compaction


def compact_paths(edges: DataFrame, cut: int = CUT) -> DataFrame:
    """(head, step) for every edge (x, y, z): the path that it lies on and its place there.

    An edge follows another if the node between them has no other edge in or out. Each edge finds
    the first edge of its path by asking the one it points to for that one's pointer, which
    doubles the distance each round. Some nodes, chosen by a hash, end paths whatever their
    degree. A ring that holds none of them has no first edge; its edges stay paths of one.
    """
    ends = edges.select(
        F.inline(
            F.array(
                F.struct(F.col("x").alias("p"), F.col("y").alias("q"), F.lit(None).cast("long").alias("from"), F.col("z").alias("to")),
                F.struct(F.col("y").alias("p"), F.col("z").alias("q"), F.col("x").alias("from"), F.lit(None).cast("long").alias("to")),
            )
        )
    )
    nodes = ends.groupBy("p", "q").agg(
        F.count("from").alias("n_in"), F.count("to").alias("n_out"), F.max("from").alias("from"), F.max("to").alias("to")
    )
    kept = F.pmod(F.xxhash64("p", "q"), F.lit(cut)) != 0
    unary = nodes.filter((F.col("n_in") == 1) & (F.col("n_out") == 1) & kept)
    # The node (p, q) lies between the edges (from, p, q) and (p, q, to).
    links = unary.select(
        F.struct(F.col("p").alias("x"), F.col("q").alias("y"), F.col("to").alias("z")).alias("edge"),
        F.struct(F.col("from").alias("x"), F.col("p").alias("y"), F.col("q").alias("z")).alias("before"),
    ).filter(F.col("edge") != F.col("before"))
    alone = F.col("before").isNull()
    state = written(
        edges.select(F.struct("x", "y", "z").alias("edge")).join(links, "edge", "left").select(
            "edge",
            F.coalesce("before", "edge").alias("head"),
            F.when(alone, 0).otherwise(1).alias("step"),
            alone.alias("found"),
        ),
        "phrase-paths",
    )
    open_edges = state.filter("NOT found").count()
    while open_edges:
        there = state.select(
            F.col("edge").alias("head"), F.col("head").alias("_head"), F.col("step").alias("_step"), F.col("found").alias("_found")
        )
        moved = state.filter("NOT found").join(there, "head").select(
            "edge", F.col("_head").alias("head"), (F.col("step") + F.col("_step")).alias("step"), F.col("_found").alias("found")
        )
        state = written(state.filter("found").unionByName(moved), "phrase-paths")
        left = state.filter("NOT found").count()
        if left == open_edges:
            break  # only rings are left
        open_edges = left
    return state.select(
        "edge.*",
        F.when(F.col("found"), F.col("head")).otherwise(F.col("edge")).alias("head"),
        F.when(F.col("found"), F.col("step")).otherwise(0).alias("step"),
    )


def _score(a: str, left: str, right: str) -> Column:
    """floor(UNIT * a * a / (left * right)) on 38 digits."""
    wide = {c: f"CAST({c} AS DECIMAL(19, 0))" for c in (a, left, right)}
    return F.expr(f"CAST({UNIT} AS DECIMAL(7, 0)) * {wide[a]} * {wide[a]} div ({wide[left]} * {wide[right]})")


def mine_phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    covered: int = COVERED,
    top: int | None = TOP,
) -> DataFrame:
    """The strongest phrases of two and three words of every language.

    Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends into pieces and those at blanks
    and tabs into words. f is the number of all occurrences of words within pieces, overlaps
    included. A phrase with a = f >= ``least`` is a candidate; cut in two it scores
    floor(1000000 * a * a / (f of the first part * f of the rest)), its lowest cut counts, of equal
    ones that with the shorter first part. A pair inside a longer candidate that has ``covered``
    percent of its occurrences is dropped.

    Returns ``lang, rank, phrase, a, l, r, n, score``, the first ``top`` of each language (all, if
    None) by score down, a down, phrase up; n counts all words of the language.

    Null and empty texts have no words; a null language is ``und``. Repeated rows count each.
    Whole texts are read, of any length. Other columns are ignored, whatever their names. Words
    are compared by 64-bit keys, checked by another 64 bits over the whole vocabulary; if two
    words ever share a key, all are counted again under other keys. No words, no rows.
    """
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    words, seed = _vocabulary(texts)
    counts = _flows(texts, words, seed, least)
    flows = counts.filter("z = 0").groupBy("x", "y").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    singles = words.select("key", "lang", "word").join(
        flows.filter("y = 0").select(F.col("x").alias("key"), F.col("n").alias("f")), "key"
    )
    singles = written(singles, "phrase-singles")
    first = singles.select(F.col("key").alias("x"), "lang", F.col("word").alias("w1"), F.col("f").alias("f1"))
    second = singles.select(F.col("key").alias("y"), F.col("word").alias("w2"), F.col("f").alias("f2"))
    pairs = lookup_join(flows.filter("y <> 0"), first, "x", "y")
    pairs = written(lookup_join(pairs, second, "y", "x"), "phrase-pairs")

    edges = counts.filter("z <> 0")
    node = F.struct(F.col("n").alias("pair"), "lang", "w1", "f1", "w2", "f2").alias("node")
    nodes = pairs.select("x", "y", node)
    placed = edges.join(compact_paths(edges), ["x", "y", "z"]).join(nodes, ["x", "y"])
    steps = F.sort_array(F.collect_list(F.struct("step", "x", "y", "z", "n", "node")))
    paths = placed.groupBy("head").agg(steps.alias("steps"))  # paths are cut by a hash
    # Behind each step stands the next one's node; only the last one's is looked up.
    last = F.get("steps", F.size("steps") - 1)
    tail = nodes.select(F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("node").alias("tail"))
    paths = paths.withColumn("_x", last["y"]).withColumn("_y", last["z"]).join(tail, ["_x", "_y"])
    paths = written(paths.select("steps", "tail"), "phrase-compact")

    def after(i: Column) -> Column:
        return F.coalesce(F.get("steps", i + 1)["node"], F.col("tail"))

    threes = paths.select(
        F.inline(
            F.transform(
                "steps",
                lambda s, i: F.struct(
                    s["n"].alias("a"),
                    s["node"]["lang"].alias("lang"),
                    F.concat_ws(" ", s["node"]["w1"], s["node"]["w2"], after(i)["w2"]).alias("phrase"),
                    s["node"]["f1"].alias("l1"),
                    after(i)["pair"].alias("r1"),
                    s["node"]["pair"].alias("l2"),
                    after(i)["f2"].alias("r2"),
                ),
            )
        )
    )
    threes = threes.withColumn("s1", _score("a", "l1", "r1")).withColumn("s2", _score("a", "l2", "r2"))
    second_cut = F.col("s2") < F.col("s1")
    threes = threes.select(
        "lang",
        "phrase",
        "a",
        F.when(second_cut, F.col("l2")).otherwise(F.col("l1")).alias("l"),
        F.when(second_cut, F.col("r2")).otherwise(F.col("r1")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    # The heaviest edge at a node; nodes inside a path see both of theirs in the row.
    n_steps = F.size("steps")
    weight = F.transform("steps", lambda s: s["n"])
    touched = F.transform(
        "steps",
        lambda s, i: F.struct(s["x"].alias("x"), s["y"].alias("y"), F.greatest(s["n"], F.coalesce(F.get(weight, i - 1), F.lit(0))).alias("longer")),
    )
    end = F.get("steps", n_steps - 1)
    touched = F.concat(touched, F.array(F.struct(end["y"].alias("x"), end["z"].alias("y"), end["n"].alias("longer"))))
    longer = paths.select(F.inline(touched)).groupBy("x", "y").agg(F.max("longer").alias("longer"))
    twos = pairs.join(longer, ["x", "y"], "left").filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("n") * covered)
    )
    twos = twos.select(
        "lang",
        F.concat_ws(" ", "w1", "w2").alias("phrase"),
        F.col("n").alias("a"),
        F.col("f1").alias("l"),
        F.col("f2").alias("r"),
    ).withColumn("score", _score("a", "l", "r"))
    ranked = threes.unionByName(twos)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = ranked.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
