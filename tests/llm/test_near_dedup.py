from __future__ import annotations

import random
import re

import numpy as np
from checks import connect, differences

from loomtext.llm import near_dedup, queries
from loomtext.llm.graph import components


def set_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def by_hand(rows):
    sets = [(i, set_of(t)) for i, t in rows]
    comp = {i: i for i, _ in rows}
    changed = True
    while changed:
        changed = False
        for i, a in sets:
            for j, b in sets:
                if a and b and comp[j] < comp[i] and 100 * len(a & b) >= 75 * len(a | b):
                    comp[i] = comp[j]
                    changed = True
    return sorted((i, len(s), comp[i], comp[i] == i) for i, s in sets)


def edited(pick, words, n):
    out = list(words)
    for _ in range(n):
        out[pick.randrange(len(out))] = f"e{pick.randrange(10**6)}"
    return out


def corpus():
    pick = random.Random(11)
    shared = [f"s{i}" for i in range(60)]
    rows, doc_id = [], 0
    for size in (3, 5, 7, 12, 40, 90, 130, 160, 180, 400):
        base = [f"w{size}_{i}" for i in range(size)]
        for edits in range(0, max(2, size // 12)):
            for _ in range(3):
                rows.append((doc_id, " ".join(edited(pick, base, edits))))
                doc_id += 1
    for n in range(60):  # one passage, else different
        rows.append((doc_id, " ".join(shared + [f"d{n}_{i}" for i in range(10 + 4 * n)])))
        doc_id += 1
    rows += [(doc_id, ""), (doc_id + 1, None), (doc_id + 2, " \n "), (doc_id + 3, "A b"), (doc_id + 4, "a  B")]
    rows += [(doc_id + 5 + i, " ".join(f"c{j}" for j in range(i, i + 200))) for i in range(0, 60, 3)]  # a chain
    pick.shuffle(rows)
    return rows


def test_against_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n string")
    got = sorted(map(tuple, near_dedup.near_components(docs).collect()))
    assert got == by_hand(rows)
    kept = near_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in got if r[3]]


def test_copies_that_are_not_linked(spark):
    pick = random.Random(4)
    base = [f"b{i}" for i in range(150)]
    rows = [(i, " ".join(edited(pick, base, 1 + i % 7))) for i in range(150)]
    # Passages of their own that several edited copies share, so that the hub lacks them.
    rows += [(200 + i, rows[i % 12][1].replace(f"b{60 + i % 5} ", f"x{i % 3} ")) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, near_dedup.near_components(docs).collect())) == by_hand(rows)


def half_similar(copies=100, words=300, edits=10, kinds=500):
    """Copies of one text with edits that a few of them share: about half similar, hardly any linked."""
    pick = random.Random(5)
    base = [f"h{i}" for i in range(words)]
    rows = []
    for doc_id in range(copies):
        out = list(base)
        for kind in pick.sample(range(kinds), edits):
            out[kind * 7 % words] = f"k{kind}"
        rows.append((doc_id, " ".join(out)))
    return rows + [(copies, rows[3][1] + " more"), (copies + 1, " ".join(base))]


def test_half_similar_copies_are_not_compared_with_each_other(spark, monkeypatch):
    rows = half_similar()
    pairs = []
    real = near_dedup._compared

    def counted(found, *rest):
        pairs.append(found.count())
        return real(found, *rest)

    monkeypatch.setattr(near_dedup, "_compared", counted)
    twice = spark.createDataFrame(rows + rows[:20], "doc_id long, text string")  # equal rows that come twice
    found = near_dedup.near_components(twice)
    assert sorted(set(map(tuple, found.collect()))) == by_hand(rows)
    assert sum(pairs) < len(rows) ** 2 / 4


def test_rounds_start_without_python(spark, monkeypatch):
    plans = []
    real = near_dedup._rounds

    def planned(members, found, seen, *rest, **options):
        plans.append([f._jdf.queryExecution().executedPlan().toString() for f in (found, seen)])
        return real(members, found, seen, *rest, **options)

    monkeypatch.setattr(near_dedup, "_rounds", planned)
    rows = half_similar(copies=20)
    found = near_dedup.near_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, found.collect())) == by_hand(rows)
    assert plans and not any("ExistingRDD" in plan for plan in plans[0])  # rows of a Python list


def test_odd_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "A b c d e f"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.near_components(docs).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in got) == [
        (0, 0, 0, True), (0, 2, 0, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False),
    ]
    assert near_dedup.near_components(docs.limit(0)).count() == 0


def test_estimates_are_close():
    pick = np.random.default_rng(2)
    for share in (0.5, 0.75, 0.9):
        both = int(2000 * share)
        x = pick.integers(0, 2**63, 4000 - both, dtype=np.int64).astype(np.uint64)
        sets = [x[:2000], np.concatenate([x[:both], x[2000:]])]
        sketch = [near_dedup.registers(np.zeros(len(s), dtype=np.int64), s, 1)[0] for s in sets]
        true = both / (4000 - both)
        assert abs(near_dedup.estimate(*sketch, *map(len, sets)) - true) < 0.15


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200), (150, 200), (150, 300), (7, 500)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, 500: 0, 100: 100, 150: 100, 200: 100, 300: 100}


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    assert differences(queries.op8_minhash_near_dedup(spark, sf), connect(sf), queries.OP8_SQL) == []
