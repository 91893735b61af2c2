from __future__ import annotations

import re

from checks import connect, differences

from loomtext.llm import decontaminate, queries

SHORT = "two words"
ITEM = "one two three four five six seven eight nine ten eleven twelve"


def words_of(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def by_hand(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        w, spans, found = words_of(text), set(), set()
        for item_id, item in items:
            v = words_of(item)
            if item_id is None or not v:
                continue
            n = min(window, len(v))
            for i in range(len(v) - n + 1):
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == v[i : i + n]:
                        spans.update(range(j, j + n))
                        found.add(str(item_id))
        out.append((doc_id, len(w), len(spans), sorted(found)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(
        ((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), list(r.item_ids)) for r in df.collect()), key=repr
    )


ITEMS = [(10, ITEM), (9, SHORT), (9, SHORT), (8, None), (7, "!!"), (None, "gone"), (6, "gone"), (5, ITEM.upper()), (4, "été ü")]
DOCS = [
    (1, ITEM),
    (2, "x " + ITEM.replace(" ", ", ").title() + "! " + ITEM),
    (3, " ".join(ITEM.split()[:9])),
    (4, "one two three four five six seven eight nine ten two words two words"),
    (5, None),
    (6, ""),
    (7, "gone" * 2),
    (None, "all gone, two\nWORDS"),
    (None, "all gone, two\nWORDS"),
    (8, "été Ü été ü Été ü"),
    (9, "y " * 400_000 + ITEM),
]


def test_odd_rows_and_blocks(spark):
    docs = spark.createDataFrame([(*d, "x") for d in DOCS], "doc_id long, text string, spans string")
    items = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, words string")
    for block in (50_000, 2):
        got = decontaminate.find_contamination(docs, items, block=block)
        assert rows_of(got) == by_hand(DOCS, ITEMS)
    kept = decontaminate.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 6, 7]
    assert rows_of(decontaminate.find_contamination(docs.limit(0), items)) == []
    assert all(r[2] == 0 for r in rows_of(decontaminate.find_contamination(docs, items.limit(0))))


def test_query(spark, sf):
    got = queries.op1_benchmark_decontamination(spark, sf)
    assert differences(got, connect(sf), queries.OP1_SQL) == []


def test_items_without_an_id_have_hits(spark):
    rows = DOCS[:4] + DOCS[7:10]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(None, ITEM), (None, SHORT), (9, SHORT)], "item_id long, text string")
    named = [(-1, ITEM), (-1, SHORT), (9, SHORT)]
    wanted = [(*r[:3], [i for i in r[3] if i != "-1"]) for r in by_hand(rows, named)]
    assert rows_of(decontaminate.find_contamination(docs, items)) == sorted(wanted, key=repr)
    kept = decontaminate.decontaminate(docs, items).collect()
    assert sorted(r.doc_id for r in kept) == [3, 8]
