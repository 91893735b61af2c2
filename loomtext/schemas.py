"""Explicit schemas of the public record shapes."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


FAQ = _strings("faq_id", "category", "question", "answer")
INTENT = _strings("query_text", "intent_label")
NOTE = _strings("query", "note")
REPLY = T.StructType(
    [
        T.StructField("group_id", T.StringType()),
        T.StructField("batch_no", T.IntegerType()),
        T.StructField("reply", T.StringType()),
    ]
)
PAGE = T.StructType(
    [
        T.StructField("doc_id", T.StringType()),
        T.StructField("page_no", T.IntegerType()),
        T.StructField("text", T.StringType()),
    ]
)
CHUNK = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("chunk_no", T.IntegerType()),
        T.StructField("chunk_id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("char_length", T.IntegerType()),
        T.StructField("token_estimate", T.IntegerType()),
    ]
)
