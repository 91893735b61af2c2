from __future__ import annotations

import hashlib
import re
from fractions import Fraction

import pytest
from checks import connect, differences

from loomtext.llm import mixing, queries


def targets_by_hand(sizes, weights=(1, 2, 3), budget=None):
    """Share by weight, cap, and share the excess again, in fractions."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = min(sum(sizes.values()) if budget is None else budget, 3 * sum(sizes.values()))
    full = set()
    while True:
        free = total - sum(3 * sizes[s] for s in full)
        rest = sum(weight[s] for s in names if s not in full)
        out = {s: Fraction(3 * sizes[s]) if s in full else Fraction(free * weight[s], rest) for s in names}
        more = {s for s in names if out[s] > 3 * sizes[s]}
        if not more:
            return out
        full |= more


def by_hand(rows, budget=None):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sizes = {}
    for (_, _, s), n in zip(rows, size):
        sizes[s] = sizes.get(s, 0) + n
    goal = targets_by_hand(sizes, budget=budget)
    out = []
    for s in sizes:
        own = [(hashlib.md5(f"13:{'' if i is None else i}".encode()).hexdigest(), i is not None, i or 0, n, i)
               for (i, _, source), n in zip(rows, size) if source == s]
        words = int(goal[s])
        place = 0
        for _, _, _, n, i in sorted(own):
            taken = sum(min(n, max(0, words - epoch * sizes[s] - place)) for epoch in range(3))
            out.append((i, s, n, sizes[s], float(goal[s]), taken))
            place += n
    return sorted(out, key=repr)


ROWS = [(i, "w " * (i % 7), f"s{i % 4}") for i in range(60)]
ROWS += [(100 + i, "a b c", None) for i in range(5)]
ROWS += [(200, None, "empty"), (201, "", "empty"), (202, " \t\n", "empty")]
ROWS += [(300, "x " * 50_000, "huge"), (301, "x", "huge"), (None, "no id", "s1"), (None, "no id", "s1"), (7, "again", "s3")]
ROWS += [(400, "über ß x", "zé"), (401, "one", "z")]


def found(df):
    rows = df.select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("budget", [None, 0, 17, 10**6])
def test_against_brute_force(spark, budget):
    docs = spark.createDataFrame(
        [(*r, "a", "b", "c") for r in ROWS], "doc_id long, text string, source string, size string, _source string, place string"
    )
    got = mixing.mix_sources(docs.repartition(5), budget=budget)
    assert found(got) == by_hand(ROWS, budget)
    sums = {}
    for r in got.collect():
        assert r.taken <= 3 * r.size
        sums.setdefault((r.source, r.budget), []).append(r.taken)
    assert all(sum(taken) == words for (_, words), taken in sums.items())


def test_empty_and_single(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix_sources(none).count() == 0
    one = spark.createDataFrame([("a", None, None)], "doc_id string, text string, source string")
    assert [tuple(r) for r in mixing.mix_sources(one).collect()] == [("a", None, 0, 0, 0.0, 0, 0, 0)]


def test_texts_hold_the_words_taken(spark):
    rows = [r for r in ROWS if r[0] is not None and r[0] != 7]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = mixing.mix_sources(docs)
    words = {}
    for r in mixing.mixed_texts(docs, mix).collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert words == {r.doc_id: r.taken for r in mix.collect() if r.taken}


def test_query(spark, sf):
    assert differences(queries.op13_source_mixing(spark, sf), connect(sf), queries.OP13_SQL) == []
