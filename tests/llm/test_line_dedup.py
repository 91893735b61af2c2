from __future__ import annotations

import hashlib

from checks import connect, differences

from loomtext.llm import line_dedup, queries


def chunks_of(text):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    out, first = [], 0
    for i in range(len(lines)):
        if i == len(lines) - 1 or (h[i] * 31 + (h[i - 1] * 17 if i else 0)) % 4 == 0:
            out.append(lines[first : i + 1])
            first = i + 1
    return out


def by_hand(rows):
    seen, out = {}, []
    for doc_id, text in sorted((r for r in rows if r[0] is not None and r[1] is not None)):
        left, n = [], 0
        for k, c in enumerate(chunks_of(text)):
            body = "\n".join(c)
            whole = len(c) > 1 and body.translate(str.maketrans("\n\t\r", "   ")).strip(" ")
            if whole and seen.setdefault(body, (doc_id, text, k)) != (doc_id, text, k):
                n += len(c)
            else:
                left += c
        out.append((doc_id, "\n".join(left), len(text.split("\n")), n))
    return out


PASSAGE = "\n".join(f"line {i} of a passage" for i in range(30))
ROWS = [
    (1, "start\n" + PASSAGE + "\nend"),
    (2, "other\nstart\n" + PASSAGE),
    (3, PASSAGE + "\n" + PASSAGE),
    (4, ""),
    (5, "single"),
    (6, "single"),
    (7, "\n\n\n\n \n\t\n"),
    (8, "\n\n\n\n \n\t\n"),
    (9, "x\n" * 20_000 + PASSAGE),
    (9, "x\n" * 20_000 + PASSAGE),
]


def test_odd_rows(spark):
    rows = ROWS + [(None, PASSAGE), (10, None)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, n_lines string, _gone string")
    got = line_dedup.dedup_lines(docs)
    assert got.columns == ["doc_id", "text", "_gone", "n_lines", "n_removed"]
    found = [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()]
    assert sorted(r for r in found if r[0] not in (None, 10)) == by_hand(ROWS)
    assert (None, PASSAGE, 30, 0) in found and (10, None, 0, 0) in found
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_internal_names_pass_through(spark):
    names = "_row _at _text _lines _hashes _ends _chunks _chunk _bytes _hash _first _gone _left _n k n id mark".split()
    docs = spark.createDataFrame(
        [(i, PASSAGE, *names) for i in range(3)], "doc_id long, text string, " + ", ".join(f"{c} string" for c in names)
    )
    left = line_dedup.dedup_lines(docs)
    assert left.columns == ["doc_id", "text", *names, "n_lines", "n_removed"]
    rows = left.collect()
    assert {tuple(r[c] for c in names) for r in rows} == {tuple(names)}
    assert sorted((r.doc_id, r.n_removed > 0) for r in rows) == [(0, False), (1, True), (2, True)]


def test_passages_go_wherever_they_stand(spark):
    docs = spark.createDataFrame(ROWS[:2], "doc_id long, text string")
    left = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert left[1].n_removed == 0 and left[2].n_removed > 15


def test_query(spark, sf):
    assert differences(queries.op6_line_dedup(spark, sf), connect(sf), queries.OP6_SQL) == []
