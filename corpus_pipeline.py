"""The corpus pipeline: a table of documents through the training-data operators, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.llm.decontaminate import decontaminate
from loomtext.llm.line_dedup import dedup_lines
from loomtext.llm.near_dedup import drop_near_copies
from loomtext.llm.pieces import encode_pieces
from loomtext.llm.queries import PIECES
from loomtext.llm.toxicity import drop_toxic, fit_toxicity
from loomtext.operators.scale import written

# Whole texts go to Python in batches of at most so many rows: an executor holds every batch
# several times over, outside the JVM's heap.
BATCH_ROWS = 500


def _small_batches(spark: SparkSession) -> None:
    """Lower the session's rows per Arrow batch; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that a model fitted on the labelled ones rejects."""
    _small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return drop_toxic(docs, fit_toxicity(docs, labels))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated chunks of lines out of the texts; every document stays."""
    return dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    _small_batches(spark)
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents with a passage of a benchmark item."""
    _small_batches(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are left as ids: ``doc_id, n_tokens, ids``."""
    _small_batches(spark)
    ids = encode_pieces(docs, public_tokenizers.path(PIECES))
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", encoding),
]

# The stages learn, link by sketches and encode by a vocabulary, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
