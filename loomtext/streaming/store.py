"""Chunks of documents stored by bucket, added to and replaced batch by batch.

A store is a folder with four tables:

* ``manifest``: one row, the number of buckets, the name of the id and the shape of a chunk;
* ``chunks`` by ``_bucket``: chunks with the key of their document and the write that made them;
* ``documents`` by ``_bucket``: key, digest and write, one short row per stored version;
* ``commits``: one row per finished write, with its number.

A write appends chunks, then documents, and its commit last. Only committed writes count, so one that
was lost half way shows nothing and may be repeated. Of a document's versions the last committed
counts. Nothing is rewritten: a batch costs its own documents and the digests of its own buckets.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators.scale import scratch_tables, within_bound, written

BUCKETS = 256
MANIFEST = "buckets int, id_col string, chunk string"
COMMITS = "_write string, number long"
DOCUMENTS = "_key string, _digest string, _write string, _bucket int"
INNER = ("_key", "_write", "_bucket")


@dataclass(frozen=True)
class ChunkStore:
    """An opened store: where it lies, its buckets, its id column and the columns of a chunk."""

    spark: SparkSession
    folder: str
    buckets: int
    id_col: str
    chunk: T.StructType

    def _table(self, name: str, schema: T.StructType | str) -> DataFrame:
        if not path_exists(self.spark, f"{self.folder}/{name}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def commits(self) -> DataFrame:
        return self._table("commits", COMMITS)

    def versions(self, buckets: list[int] | None = None) -> DataFrame:
        """Committed versions of documents with their number, of some buckets or all."""
        rows = self._table("documents", DOCUMENTS)
        if buckets is not None:
            rows = rows.filter(F.col("_bucket").isin(buckets))
        return rows.join(_small(self.commits()), "_write")

    def digests(self, buckets: list[int]) -> DataFrame:
        """(bucket, key, digest) of the last version of every document in these buckets."""
        last = F.max_by("_digest", "number").alias("_digest")
        return self.versions(buckets).groupBy("_bucket", "_key").agg(last)

    def live(self) -> DataFrame:
        """Chunks of the last version of every document, with key, write and bucket."""
        inner = T.StructType(list(self.chunk.fields))
        for name, kind in (("_key", "string"), ("_write", "string"), ("_bucket", "integer")):
            inner = inner.add(name, kind)
        last = F.max("number").over(Window.partitionBy("_bucket", "_key"))
        old = self.versions().withColumn("_last", last).filter(F.col("number") < F.col("_last"))
        replaced = written(old.select(*INNER), "replaced")
        return (
            self._table("chunks", inner)
            .join(_small(self.commits().select("_write")), "_write", "left_semi")
            .join(_small(replaced), list(INNER), "left_anti")
        )

    def chunks(self) -> DataFrame:
        """Chunks of the last version of every document; they are not shuffled unless the list of
        replaced versions is beyond a broadcast."""
        return self.live().drop(*INNER)


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if within_bound(df) else df


def open_store(spark: SparkSession, folder: str) -> ChunkStore:
    row = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").first()
    shape = T.StructType.fromJson(json.loads(row["chunk"]))
    return ChunkStore(spark, folder, row["buckets"], row["id_col"], shape)


def create_store(
    spark: SparkSession, folder: str, id_col: str, chunk: T.StructType, buckets: int = BUCKETS
) -> ChunkStore:
    """A new, empty store. More buckets make a small batch read less of the known digests."""
    row = [(buckets, id_col, chunk.json())]
    spark.createDataFrame(row, MANIFEST).coalesce(1).write.parquet(f"{folder}/manifest")
    return open_store(spark, folder)


def _keyed(batch: DataFrame, store: ChunkStore, text_col: str, shape: str) -> DataFrame:
    """One row a document: bucket, key, digest, id and text.

    The digest covers the text and how it is cut. Of several texts for one id in a batch the one
    with the largest digest counts. A document without id has its digest for a key, so that each
    distinct text of such documents is kept once.
    """
    digest = F.sha2(F.concat(F.coalesce(F.col(text_col), F.lit("")), F.lit("\x00" + shape)), 256)
    name = F.col(store.id_col).cast("string")
    rows = batch.select(
        F.col(store.id_col), F.col(text_col).alias("_text"), digest.alias("_digest")
    ).withColumn("_key", F.coalesce(F.concat(F.lit("i"), name), F.concat(F.lit("d"), "_digest")))
    row = F.struct(store.id_col, "_text", "_digest")
    one = rows.groupBy("_key").agg(F.max_by(row, "_digest").alias("_row"))
    bucket = F.pmod(F.xxhash64("_key"), F.lit(store.buckets)).cast("int")
    return one.select("_key", bucket.alias("_bucket"), "_row.*")


def upsert(
    store: ChunkStore,
    batch: DataFrame,
    cut: Callable[[DataFrame], DataFrame],
    shape: str = "",
    text_col: str = "text",
) -> int:
    """Add new documents, replace changed ones, leave known ones; returns how many were written.

    ``cut`` turns (id, text) and further columns into chunks and passes the further columns on;
    ``shape`` names how it cuts, so that another way of cutting counts as a change. Digests are
    read from the buckets of the batch alone. One write to a store at a time.
    """
    spark, write = store.spark, uuid.uuid4().hex
    with scratch_tables(spark):
        asked = written(_keyed(batch, store, text_col, shape), "upsert-asked")
        touched = [r[0] for r in asked.select("_bucket").distinct().collect()]  # at most all buckets
        known = store.digests(touched)
        # What is known changes with the commit alone, so both tables get the same documents.
        fresh = asked.join(known, ["_bucket", "_key", "_digest"], "left_anti")
        n = fresh.count()
        if not n:
            return 0
        # Texts are dealt by bucket before they grow into chunks and vectors.
        marked = fresh.withColumn("_write", F.lit(write)).hint("rebalance", "_bucket")
        texts = marked.withColumnRenamed("_text", text_col).drop("_digest")
        columns = [F.col(f"`{f.name}`") for f in store.chunk.fields]
        _append(cut(texts).select(*columns, *INNER), f"{store.folder}/chunks")
        rows = marked.select("_key", "_digest", "_write", "_bucket")
        _append(rows, f"{store.folder}/documents")
        number = store.commits().agg(F.coalesce(F.max("number"), F.lit(0)) + 1).first()[0]
        commit = spark.createDataFrame([(write, number)], COMMITS)
        commit.coalesce(1).write.mode("append").parquet(f"{store.folder}/commits")
    return n


def _append(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy("_bucket").parquet(path)


def compact(store: ChunkStore, target: str, buckets: int | None = None) -> ChunkStore:
    """The last versions alone in a new store at ``target``, with few files and, if wanted, other
    buckets; the old folder may then be deleted."""
    spark, write = store.spark, uuid.uuid4().hex
    copy = create_store(spark, target, store.id_col, store.chunk, buckets or store.buckets)
    bucket = F.pmod(F.xxhash64("_key"), F.lit(copy.buckets)).cast("int")
    last = store.versions().groupBy("_key").agg(F.max_by("_digest", "number").alias("_digest"))
    with scratch_tables(spark):
        live = store.live().drop("_bucket")
        for rows, name in ((live, "chunks"), (last, "documents")):
            moved = rows.withColumn("_write", F.lit(write)).withColumn("_bucket", bucket)
            _append(moved.hint("rebalance", "_bucket"), f"{target}/{name}")
        commit = spark.createDataFrame([(write, 1)], COMMITS)
        commit.coalesce(1).write.parquet(f"{target}/commits")
    return copy
