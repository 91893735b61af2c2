from __future__ import annotations

from checks import connect, differences
from pyspark.sql import functions as F

from loomtext.llm import exact_dedup, queries

ROWS = [
    (1, "Same text", "a"),
    (2, "same TEXT", "b"),
    (3, "", None),
    (4, None, "d"),
    (5, "É", "e"),
    (6, "é", "f"),
    (None, "same text", "g"),
    (7, "x" * 300_000, "h"),
    (8, "X" * 300_000, "i"),
    (8, "x" * 300_000, "j"),
]
WANTED = {  # id: (keep, size)
    "min": [(None, 1, 3), (1, 1, 3), (2, 1, 3), (3, 3, 2), (4, 3, 2), (5, 5, 1), (6, 6, 1), (7, 7, 3), (8, 7, 3), (8, 7, 3)],
    "max": [(None, 2, 3), (1, 2, 3), (2, 2, 3), (3, 4, 2), (4, 4, 2), (5, 5, 1), (6, 6, 1), (7, 8, 3), (8, 8, 3), (8, 8, 3)],
}


def rows_of(df):
    got = df.select("doc_id", "keep_id", "group_size").collect()
    return sorted(map(tuple, got), key=lambda r: (r[0] is not None, r))


def test_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, keep_id string")
    for keep, wanted in WANTED.items():
        assert rows_of(exact_dedup.exact_classes(docs, keep=keep)) == wanted
    assert exact_dedup.exact_classes(docs.limit(0)).count() == 0


def test_colliding_hashes_are_split_by_bytes(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, keep_id string")

    def weak(text):  # equal for most texts
        return F.unhex(F.hex(F.length(text) % 2))

    got = exact_dedup.exact_classes(docs, keep="max", fingerprint=weak)
    assert rows_of(got) == WANTED["max"]
    assert got.filter("kept").count() == 6


def test_a_hot_group(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "copy").otherwise(F.concat(F.lit("t"), "id")).alias("text"),
    )
    got = exact_dedup.exact_classes(docs)
    assert got.filter("doc_id % 3 = 0 AND keep_id = 0 AND group_size = 1000").count() == 1000
    assert got.filter("kept").count() == 2001


def test_query(spark, sf):
    got = queries.op9_exact_dedup(spark, sf)
    assert differences(got, connect(sf), queries.OP9_SQL) == []
