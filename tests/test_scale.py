from __future__ import annotations

import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomtext.operators import scale as S


@pytest.fixture
def skewed(spark):
    """A third of the rows share one key."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500))
    return spark.range(6000).select("id", key.alias("key"))


def test_salted_join_equals_plain_join(spark, skewed, monkeypatch):
    monkeypatch.setattr(S, "HOT_KEYS", 50)
    small = skewed.select("key").distinct().withColumn("v", F.length("key"))
    ours = S.salted_join(skewed, small, "key", "id")
    plain = skewed.join(small, "key")
    assert ours.count() == 6000
    assert ours.select("id", "key", "v").exceptAll(plain.select("id", "key", "v")).count() == 0


def test_salted_join_many_to_many(spark, skewed, monkeypatch):
    monkeypatch.setattr(S, "HOT_KEYS", 50)
    small = spark.createDataFrame([("hot", i) for i in range(3)] + [("k1", 9)], "key string, v int")
    ours = S.salted_join(skewed, small, "key", "id").select("id", "key", "v")
    plain = skewed.join(small, "key").select("id", "key", "v")
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0


def test_lookup_join_takes_the_salted_way_beyond_the_bound(spark, skewed):
    small = skewed.select("key").distinct()
    joined = S.lookup_join(skewed, small, "key", "id", small_is_bounded=False)
    assert joined.count() == 6000


def test_within_bound(spark):
    df = spark.createDataFrame([("a" * 100, [1.0, 2.0], ["x", "y"])] * 10, "s string, v array<double>, w array<string>")
    assert S.within_bound(df)
    assert not S.within_bound(df, max_rows=9)
    assert not S.within_bound(df, max_bytes=1000)
    assert S.within_bound(df.limit(0))


@pytest.mark.parametrize("piece_rows", [1, 1_000_000])
def test_hash_rank_equals_row_number(spark, skewed, monkeypatch, piece_rows):
    monkeypatch.setattr(S, "PIECE_ROWS", piece_rows)
    keyed = skewed.withColumn("h", S.hash_key(7, "id"))
    ours = S.hash_rank(keyed, "h", "id", "r", group="key").select("id", "r")
    plain = keyed.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy("h", "id")))
    assert ours.exceptAll(plain.select("id", F.col("r").cast("long"))).count() == 0
    sized = S.hash_rank(keyed, "h", "id", "r", group="key", total="n").filter("key = 'hot'")
    assert sized.select("n").distinct().collect()[0][0] == 2000
    whole = S.hash_rank(keyed, "h", "id", "r")
    assert sorted(r["r"] for r in whole.collect()) == list(range(1, 6001))


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_ordered_number_equals_row_number(spark, n):
    df = spark.range(n).select((F.col("id") * 7 % 1009).alias("k"))
    rows = S.ordered_number(df, "k", "n").orderBy("k").collect()
    assert [r["n"] for r in rows] == list(range(1, n + 1))


def test_top_k_of_a_hot_group(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), "id", F.lit(0.5).alias("s"))
    best = S.top_k(df, "g", "s", "id", 2).orderBy("g", "rank").collect()
    assert [r["id"] for r in best] == [0, 3, 1, 4, 2, 5]
    plan = S.top_k(df, "g", "s", "id", 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_scratch_dir_follows_the_session(spark):
    folder = S.scratch_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    df = spark.range(5)
    assert S.written(df, "five").count() == 5


def test_parts_leave_no_shuffle_files(spark):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = {files.apply(i).getName() for i in range(files.size())}
        return {n for n in names if n.startswith("shuffle_")}

    def part(i):
        seen.append(shuffles())
        return spark.range(20).filter(F.col("id") % 3 == i).repartition(2).withColumn("part", F.lit(i))

    seen, setting, before = [], spark.conf.get(S._FREE), shuffles()
    table = S.written_in_parts(map(part, range(3)), "parts", ["part"])
    assert spark.conf.get(S._FREE) == setting and len(seen) == 3
    for _ in range(50):  # files are deleted beside the next step
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before
    assert sorted(r[0] for r in table.select("id").collect()) == list(range(20))
    assert sorted(r[0] for r in table.filter("part = 1").select("id").collect()) == [1, 4, 7, 10, 13, 16, 19]


def test_spread_leaves_frames_without_files(spark, sf):
    assert S.spread(spark.range(3), "id").rdd.getNumPartitions() == spark.range(3).rdd.getNumPartitions()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert S.spread(docs, "doc_id").rdd.getNumPartitions() == 8
    assert np.isfinite(S.BROADCAST_BYTES)
