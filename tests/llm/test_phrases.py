from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from checks import connect, differences
from pyspark.sql import functions as F

from loomtext.llm import phrases, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, least=10, covered=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for s in range(len(w) - k + 1):
                    f[lang, tuple(w[s : s + k])] += 1
    candidates = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    out = {}
    for (lang, g), a in candidates.items():
        if len(g) == 2 and any(
            100 * b >= covered * a and g in (h[:2], h[1:]) for (other, h), b in candidates.items() if other == lang and len(h) == 3
        ):
            continue
        cuts = [(1000000 * a * a // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, rows in out.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1)
    )


def odd_rows():
    rng = random.Random(7)
    vocabulary = ["A", "b", "Cc", "é", "日本", "d-e", "f'g", "x" * 300, "y" * 300]
    rows = [(rng.choice(["en", "fr", None, "und", ""]), " ".join(rng.choices(vocabulary, k=rng.randrange(40)))) for _ in range(150)]
    rows += [("en", "one two three four five six seven eight nine ten, eleven!") for _ in range(30)]
    rows += [("en", "ha ha ha ha. ho hi ho hi ho hi ho hi"), ("ring", "p q r p q r p q r p q r p q r " * 20)] * 12
    rows += [("long", "the same words again and again " * 20_000), ("fr", None), (None, None), ("en", ""), ("en", " \t.;\n")]
    return rows


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("held", [None, 50])
def test_against_brute_force(spark, monkeypatch, held):
    if held:
        monkeypatch.setattr(phrases, "HELD_EDGES", held)
        monkeypatch.setattr(phrases, "HELD_WORDS", held)
        monkeypatch.setattr(phrases, "HOT_WORDS", 40)
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in odd_rows()], "lang string, text string, x int, n int, word int")
    assert found(phrases.mine_phrases(docs.repartition(5))) == by_hand(odd_rows())
    assert found(phrases.mine_phrases(docs, least=3, covered=90, top=7)) == by_hand(odd_rows(), 3, 90, 7)


def test_clashing_keys_are_counted_again(spark, monkeypatch):
    real = phrases._keyed

    def weak(langs, texts, seed):
        for w, keys in real(langs, texts, seed):
            yield w, keys % 4 + 1 if seed == 0 else keys

    monkeypatch.setattr(phrases, "_keyed", weak)
    rows = [("en", "one two three one two")] * 10
    docs = spark.createDataFrame(rows, "lang string, text string")
    words, seed = phrases._vocabulary(docs)
    assert seed == 1 and words.count() == 3


def test_paths(spark):
    chain = [(i, i + 1, i + 2, 5) for i in range(300)] + [(1000, 1001, 1000, 2), (1001, 1000, 1001, 2), (7, 7, 7, 1)]
    edges = spark.createDataFrame(chain, "x long, y long, z long, n long")
    rows = phrases.compact_paths(edges, cut=1 << 40).collect()
    assert len(rows) == len(chain)
    line = [r for r in rows if r.x < 300 and r.x != r.y]
    assert {tuple(r.head) for r in line} == {(0, 1, 2)} and all(r.step == r.x for r in line)
    assert all(r.step == 0 for r in rows if r not in line)
    cut = phrases.compact_paths(edges).collect()
    assert 1 < len({tuple(r.head) for r in cut}) < 100
    for r in cut:
        assert r.x >= 300 or r.x == r.y or r.step == r.x - r.head.x


def test_empty(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert phrases.mine_phrases(docs).count() == 0
    assert phrases.mine_phrases(spark.createDataFrame([("en", None)], docs.schema)).count() == 0


def test_flows_are_the_counts_of_words(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    words, seed = phrases._vocabulary(docs)
    flows = phrases._flows(docs, words, seed, 1).filter("y = 0").groupBy("x").agg(F.sum("n").alias("f"))
    assert words.join(flows, words["key"] == flows["x"], "full").filter("f IS NULL OR n IS NULL OR f <> n").count() == 0


def test_query(spark, sf):
    assert differences(queries.op11_phrase_collocations(spark, sf), connect(sf), queries.OP11_SQL) == []
