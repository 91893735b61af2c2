from __future__ import annotations

import random
import re
import time

import numpy as np
import pyarrow as pa
from checks import connect, differences

from loomtext.llm import queries, substring_dedup
from loomtext.llm.words import SPACED, batch_words


def by_hand(rows, window):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    seen, out = set(), []
    for i in sorted(words):
        w, gone = words[i], set()
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if key in seen:
                gone.update(range(s, s + window))
            seen.add(key)
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def corpus():
    pick = random.Random(4)
    base = [f"w{pick.randrange(400)}" for _ in range(600)]
    rows = []
    for i in range(60):
        a = pick.randrange(500)
        part = base[a : a + pick.randrange(5, 100)]
        own = [f"o{pick.randrange(50)}" for _ in range(pick.randrange(40))]
        rows.append((i, " ".join(own + part + own[: pick.randrange(30)] + part)))
    rows += [(60, None), (61, ""), (62, "a " * 3000), (63, "a " * 3000 + "b"), (64, "A\n" * 25), (65, " ".join(base))]
    pick.shuffle(rows)
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n string").repartition(3)
    for window in (20, 7):
        got = substring_dedup.dedup_substrings(docs, window=window)
        assert sorted(map(tuple, got.collect())) == by_hand(rows, window)


def test_anchors_are_least_windows_found_in_few_passes():
    pick = random.Random(3)
    texts = pa.array([" ".join(f"w{pick.randrange(40)}" for _ in range(n)) for n in (0, 3, 25, 4000)])
    (w,) = batch_words(texts, SPACED)

    def took(window):
        began = time.process_time()
        for _ in range(5):
            substring_dedup._anchors(w, 5, window)
        return time.process_time() - began

    for size, window in ((5, 20), (10, 20), (7, 7), (2, 13), (5, 5000)):
        place, hashes, _ = substring_dedup._anchors(w, size, window)
        for i in range(0, len(hashes), 7):
            assert place[i] == i + np.argmin(hashes[i : i + window - size + 1])  # the first of equal ones
    # Passes grow with the logarithm of the window.
    assert min(took(2048) for _ in range(3)) < 30 * min(took(20) for _ in range(3))


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text)], "doc_id long, text string")
    got = substring_dedup.dedup_substrings(docs).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (1, 0), (1, 0), (2, 30)]
    assert substring_dedup.dedup_substrings(docs.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    assert differences(queries.op7_substring_dedup(spark, sf), connect(sf), queries.OP7_SQL) == []


def test_repeated_rows_are_written_out_again(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "COPIES", 2)
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text)] * 5 + [(2, text)] * 4 + [(3, "short")] + [(None, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.dedup_substrings(docs).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0)] * 3 + [(1, 0)] * 5 + [(2, 30)] * 4 + [(3, 0)]


def test_texts_are_shuffled_once(spark):
    docs = spark.createDataFrame([(i, f"{i} " * 40) for i in range(50)], "doc_id long, text string")
    rows = substring_dedup._dealt(docs.selectExpr("doc_id AS id", "xxhash64(text) AS mark", "text"))
    spans = spark.createDataFrame([(1, 2, [3])], "id long, mark long, spans array<int>")
    plan = substring_dedup._joined(rows, spans, "left")._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1
