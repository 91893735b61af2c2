from __future__ import annotations

import corpus_pipeline
import public_tokenizers
import sentencepiece
from test_decontaminate import by_hand as hits_by_hand
from test_line_dedup import by_hand as lines_by_hand
from test_near_dedup import by_hand as near_by_hand

from loomtext.llm import queries


def test_stages_against_brute_force(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    rejected = {r.doc_id for r in queries.op2_toxicity(spark, sf).collect() if r.predicted}
    rows = [(r.doc_id, r.text) for r in table.collect() if r.doc_id not in rejected]
    rows = [(i, text) for i, text, _, _ in lines_by_hand(rows)]
    kept = {i for i, _, _, stays in near_by_hand(rows) if stays}
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    dirty = {i for i, _, n, _ in hits_by_hand([r for r in rows if r[0] in kept], items) if n}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECES))
    wanted = {i: library.encode(t) for i, t in rows if i in kept - dirty}

    docs = table
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == table.columns
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == wanted
    assert 0 < len(got) < table.count()
