from __future__ import annotations

from pyspark.sql import functions as F

from loomtext.operators import lexical as L
from loomtext.streaming.ingest import insert_chunks, read_chunks, start_insert, start_triage
from loomtext.streaming.store import compact, open_store


def test_updates_add_only_new_chunks(spark, tmp_path):
    source, index = str(tmp_path / "docs"), str(tmp_path / "index")
    schema = "doc_id long, text string"

    def arrive(*rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)

    def run(checkpoint):
        from pyspark.sql.types import _parse_datatype_string

        start_insert(
            spark, source, _parse_datatype_string(schema), index, str(tmp_path / checkpoint), size=50, overlap=10
        ).awaitTermination()
        return read_chunks(spark, index)

    arrive((1, "first text. " * 20), (2, "second text."))
    one = run("a").count()
    arrive((2, "second text."), (3, "third text."))
    two = run("a")
    assert two.count() == one + 1  # the repeat of document 2 adds nothing
    assert run("fresh").count() == one + 1  # nor does a replay of everything
    assert two.filter(F.col("embedding").isNull()).count() == 0


def test_stream_equals_batch(spark, faq, tmp_path):
    source, output = str(tmp_path / "asked"), str(tmp_path / "answers")
    rows = [(i, t) for i, t in enumerate(("river bank", "bursar fee", "nothing known"), 1)]
    asked = spark.createDataFrame(rows, "query_id long, text string")
    for i in (1, 2, 3):
        asked.filter(F.col("query_id") == i).coalesce(1).write.mode("append").parquet(source)
    model = L.fit_lexical(faq)

    def answer(questions):
        return L.search_with_fallback(faq, questions, model)

    for _ in range(2):  # a restart from the same checkpoint repeats nothing
        start_triage(
            spark, source, asked.schema, answer, output, str(tmp_path / "cp"), files_per_batch=1
        ).awaitTermination()
    live = spark.read.parquet(output)
    assert live.select("batch").distinct().count() == 3
    batch = answer(asked)
    columns = ["query_id", "status", F.round("max_confidence_score", 9).alias("s")]
    assert sorted(live.select(*columns).collect()) == sorted(batch.select(*columns).collect())


def _texts(spark, folder):
    rows = read_chunks(spark, folder).orderBy("doc_id", "chunk_no").collect()
    return [(r["doc_id"], r["text"]) for r in rows]


def test_store_replaces_changed_documents(spark, tmp_path):
    folder, schema = str(tmp_path / "store"), "doc_id long, text string"

    def add(*rows):
        batch = spark.createDataFrame(rows, schema)
        return insert_chunks(batch, folder, buckets=4, size=30, overlap=5, separators=[""])

    assert add((1, "one " * 20), (2, "two"), (3, None), (None, "no id"), (None, "no id"), (None, "nor this")) == 5
    assert add((1, "one " * 20), (None, "no id")) == 0
    before = _texts(spark, folder)
    assert add((1, "now short"), (2, "two"), (4, "four"), (4, "four")) == 2
    changed = [(None, "no id"), (None, "nor this"), (1, "now short"), (2, "two"), (4, "four")]
    assert sorted(_texts(spark, folder), key=repr) == sorted(changed, key=repr) and len(before) > 5
    assert add((2, "")) == 1  # an emptied document loses its chunks
    assert (2, "two") not in _texts(spark, folder)
    assert add((1, "one " * 20)) == 1  # an old text may come back
    assert sum(d == 1 for d, _ in _texts(spark, folder)) > 1
    copy = compact(open_store(spark, folder), str(tmp_path / "copy"), buckets=2)
    assert _texts(spark, copy.folder) == _texts(spark, folder)
    assert copy.versions().count() == 6
    folder = copy.folder
    assert add((1, "one " * 20), (2, ""), (4, "four")) == 0


def test_store_ignores_lost_writes_and_reads_its_buckets(spark, tmp_path):
    folder = str(tmp_path / "store")
    batch = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    assert insert_chunks(batch, folder, buckets=16) == 50
    # A write that was lost before its commit: its chunks and documents are there, its commit is not.
    store = open_store(spark, folder)
    inner = spark.read.parquet(f"{folder}/chunks").withColumn("_write", F.lit("lost"))
    inner.write.mode("append").partitionBy("_bucket").parquet(f"{folder}/chunks")
    lost = spark.read.parquet(f"{folder}/documents").withColumn("_write", F.lit("lost")).withColumn("_digest", F.lit("x"))
    lost.write.mode("append").partitionBy("_bucket").parquet(f"{folder}/documents")
    assert read_chunks(spark, folder).count() == 50
    assert insert_chunks(batch, folder) == 0
    plan = store.digests([3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan and "= 3" in plan


def test_empty_batch_makes_an_empty_store(spark, tmp_path):
    folder = str(tmp_path / "store")
    none = spark.createDataFrame([], "doc_id string, text string, extra int")
    assert insert_chunks(none, folder) == 0
    assert read_chunks(spark, folder).count() == 0
    assert insert_chunks(spark.createDataFrame([("a", "x", 1)], none.schema), folder) == 1
    assert read_chunks(spark, folder).select("doc_id").collect() == [("a",)]


def test_triage_leaves_no_tables_and_answers_repeats_once(spark, faq, tmp_path):
    import os

    from loomtext.operators.scale import scratch_dir

    source, output = str(tmp_path / "asked"), str(tmp_path / "answers")
    schema = "query_id long, text string, at timestamp"
    minutes = [(1, "river bank", 0), (2, "bursar fee", 1), (1, "river bank", 2), (3, "nothing known", 3)]
    for i, text, minute in minutes:
        row = spark.sql(f"SELECT {i}L AS query_id, '{text}' AS text, TIMESTAMP'2026-01-01 00:0{minute}:00' AS at")
        row.coalesce(1).write.mode("append").parquet(source)
    model = L.fit_lexical(faq)
    before = set(os.listdir(scratch_dir(spark)))

    def answer(questions):
        return L.search_with_fallback(faq, questions, model)

    for _ in range(2):
        start_triage(
            spark, source, spark.sql("SELECT 1L AS query_id, '' AS text, current_timestamp() AS at").schema,
            answer, output, str(tmp_path / "cp"), files_per_batch=1,
            once=["query_id", "text"], time_col="at", within="10 minutes",
        ).awaitTermination()
    live = spark.read.parquet(output)
    assert sorted(r[0] for r in live.select("query_id").collect()) == [1, 2, 3]
    assert set(os.listdir(scratch_dir(spark))) == before
