from __future__ import annotations

import math
import random

import numpy as np
import pytest
from checks import connect, differences
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loomtext.llm import negatives, queries

SCHEMA = "vec_id long, label int, embedding array<double>, rank string, q string, planes string"


def by_hand(rows):
    best = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(256 * x) for x in v])
        best[i] = min(best.get(i, row), row)
    out = []
    for a, (own, q) in best.items():
        if a % 10:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, p)), i, label) for i, (label, p) in best.items() if i != a)
        for p, i, _ in [s for s in scored if s[2] == own][:5]:
            near = [(n, j) for n, j, label in scored if label != own and 80 * -p <= 100 * -n <= 100 * -p]
            out += [(a, i, rank, j, -p, -n) for rank, (n, j) in enumerate(near[:5], 1)]
    return sorted(out)


def odd_rows():
    rng = random.Random(5)
    rows = [(i, rng.choice([0, 0, 0, 1, 2]), [rng.uniform(-1, 1) for _ in range(11)]) for i in range(90)]
    rows += [(100 + i, i % 2, [0.5] * 11) for i in range(40)]  # ties
    rows += [(200, 1, [-0.5] * 11), (210, 1, []), (211, 0, []), (212, 0, [0.9] * 3), (213, 1, [300.0] + [0.0] * 10)]
    rows += [(300, None, [1.0] * 11), (310, 1, None), (320, 1, [None] + [1.0] * 10), (330, 1, [float("nan")] * 11)]
    rows += [(340, 1, [float("inf")] * 11), (None, 1, [1.0] * 11), (100, 1, [0.5] * 11), (101, 0, [0.7] * 11), (-10, 3, [0.1] * 11)]
    return rows


@pytest.mark.parametrize("sizes", [(1024, 16384), (3, 20)])
def test_against_brute_force(spark, sizes):
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in odd_rows()], SCHEMA).repartition(7)
    got = negatives.hard_negatives(docs, F.col("vec_id") % 10 == 0, anchor_rows=sizes[0], candidate_rows=sizes[1])
    assert sorted(tuple(r) for r in got.collect()) == by_hand(odd_rows())


def test_tables_give_inner_products():
    rng = np.random.default_rng(3)
    for dims, most in [(1, 1), (8, 256), (13, 5000), (64, 1 << 23)]:
        a, b = rng.integers(-most, most, (5, dims)), rng.integers(-most, most, (40, dims))
        planes = negatives.planes_of(b, int(most).bit_length() + 1)
        assert (negatives.scores_of(planes, negatives.subset_sums(a)) == b @ a.T).all()


def test_empty_alone_and_too_large(spark):
    def run(rows):
        return negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0).collect()

    assert run([]) == []
    assert run([(0, 1, [1.0], "", "", "")]) == []
    with pytest.raises(PySparkException, match="2\\*\\*24"):
        run([(0, 1, [1e30], "", "", "")])


def test_query(spark, sf):
    assert differences(queries.op12_hard_negatives(spark, sf), connect(sf), queries.OP12_SQL) == []
