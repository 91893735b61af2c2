"""Queries for record reading, JSON replies and preparation."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import prepare as P
from ..operators.scale import scratch_path, spread
from ..schemas import INTENT
from ..sources import replies as J
from ..sources.files import ingest_files
from ..sources.records import inline_records, read_records, write_records
from . import sql as S
from .tables import Registry, documents, table

R = Registry()

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
LANGUAGES = [("de", "German"), ("en", "English"), ("es", "Spanish"), ("fr", "French")]
EXTRA = [
    ("Where do I return a borrowed book?", "library"),
    ("Is the reading room open on holidays?", "library"),
    ("How long may I keep a journal?", "library"),
    ("Can I renew a loan by phone?", "library"),
]


@R.add(
    "read_records",
    """SELECT doc_id, text, lang, source, n_chars FROM documents
       WHERE doc_id IS NOT NULL AND text IS NOT NULL""",
)
def read_documents(spark, sf):
    return read_records(spark, f"{sf}/documents.parquet", DOCUMENT, ["doc_id", "text"], "parquet")


@R.add(
    "inline_records",
    "SELECT lang, language, count(*) AS n_docs FROM documents JOIN (VALUES "
    + ", ".join(f"('{c}', '{n}')" for c, n in LANGUAGES)
    + ") AS x(lang, language) USING (lang) GROUP BY 1, 2",
)
def inline_languages(spark, sf):
    schema = T.StructType(
        [T.StructField("lang", T.StringType()), T.StructField("language", T.StringType())]
    )
    names = F.broadcast(inline_records(spark, LANGUAGES, schema))  # literal rows
    return (
        documents(spark, sf)
        .join(names, "lang")
        .groupBy("lang", "language")
        .agg(F.count(F.lit(1)).alias("n_docs"))
    )


@R.add(
    "with_full_text",
    """SELECT doc_id, coalesce(source, '') || ' ' || coalesce(text, '') AS full_text
       FROM documents""",
)
def with_full_text(spark, sf):
    return P.with_full_text(documents(spark, sf), ("source", "text")).select("doc_id", "full_text")


@R.add("write_records", "SELECT doc_id, lang, source, text FROM documents WHERE text IS NOT NULL")
def write_and_read(spark, sf):
    path = scratch_path(spark, "records")
    columns = ["doc_id", "lang", "source", "text"]
    write_records(documents(spark, sf), path, columns)
    schema = T.StructType([DOCUMENT[c] for c in columns])
    return read_records(spark, path, schema, ["doc_id", "text"])


@R.add(
    "assemble_pages",
    f"""SELECT conv_id, string_agg('--- PAGE ' || (turn + 1) || ' ---' || chr(10) ||
          {S.strip('text')}, chr(10) || chr(10) ORDER BY turn) AS text
        FROM conversations WHERE text <> '' GROUP BY 1""",
)
def assemble_pages(spark, sf):
    pages = table(spark, sf, "conversations").withColumn("page_no", F.col("turn") + 1)
    return P.assemble_pages(pages, "conv_id")


@R.add("ingest_files", "SELECT text FROM conversations WHERE text <> ''")
def ingest(spark, sf):
    # The turns as text files with form feeds between pages, then read back page by page.
    path = scratch_path(spark, "files")
    turns = table(spark, sf, "conversations").select("text").filter(F.col("text") != "")
    turns.write.option("lineSep", "\f").text(path)
    return ingest_files(spark, path, pattern="*.txt").select("text").filter(F.col("text") != "")


REPLIES = """replies AS (
  SELECT event_id, CASE event_id % 5
    WHEN 0 THEN props
    WHEN 1 THEN 'Sure! Here it is: ' || props || ' Anything else?'
    WHEN 2 THEN 'List: [' || props || ', ' || props || ']'
    WHEN 3 THEN props || ' and [' || props || ']'
    ELSE substr(props, 1, length(props) - 1) END AS reply FROM events)"""


def cut_sql(opening: str, closing: str) -> str:
    last = f"length(reply) - instr(reverse(reply), '{closing}') + 1"
    return f"""CASE WHEN instr(reply, '{opening}') > 0 AND instr(reply, '{closing}') > 0
      AND {last} > instr(reply, '{opening}')
      THEN substr(reply, instr(reply, '{opening}'),
                  {last} - instr(reply, '{opening}') + 1) END"""


@R.add(
    "parse_llm_json",
    f"""WITH {REPLIES}, cut AS (SELECT event_id, reply, {cut_sql('[', ']')} AS a,
                                 {cut_sql('{', '}')} AS o FROM replies),
        j AS (SELECT event_id, CASE WHEN json_valid(reply) THEN reply
                WHEN a IS NOT NULL AND json_valid(a) THEN a
                WHEN o IS NOT NULL AND json_valid(o) THEN o END AS body FROM cut)
        SELECT event_id, body IS NOT NULL AS is_parsed, coalesce(body, '') LIKE '[%' AS is_array,
          coalesce(json_extract(body, '$.k'), json_extract(body, '$[0].k'))::BIGINT AS k
        FROM j""",
)
def parse_replies(spark, sf):
    props = F.col("props")
    shape = F.col("event_id") % 5
    reply = (
        F.when(shape == 0, props)
        .when(shape == 1, F.concat(F.lit("Sure! Here it is: "), props, F.lit(" Anything else?")))
        .when(shape == 2, F.concat(F.lit("List: ["), props, F.lit(", "), props, F.lit("]")))
        .when(shape == 3, F.concat(props, F.lit(" and ["), props, F.lit("]")))
        .otherwise(F.expr("substring(props, 1, length(props) - 1)"))
    )
    events = spread(table(spark, sf, "events").select("event_id", "props"), "event_id")
    parsed = events.select("event_id", J.parse_llm_json(reply).alias("v"))
    number = F.coalesce(
        F.try_variant_get("v", "$.k", "long"), F.try_variant_get("v", "$[0].k", "long")
    )
    return parsed.select(
        "event_id",
        F.col("v").isNotNull().alias("is_parsed"),
        F.coalesce(F.schema_of_variant("v").startswith("ARRAY"), F.lit(False)).alias("is_array"),
        number.alias("k"),
    )


def conversation_replies(spark, sf):
    """Replies built from every turn: a plain array, or an object wrapped in other words."""
    turns = spread(table(spark, sf, "conversations"), "conv_id", "turn")
    plain = F.to_json(F.array("text", "role"))
    entries = F.array(
        F.to_json(F.struct(F.col("text").alias("question"), F.col("role").alias("answer"))),
        F.to_json(F.struct(F.lit("  ").alias("question"), F.col("role").alias("answer"))),
        F.to_json(F.struct(F.col("text").alias("question"))),
    )
    wrapped = F.concat(
        F.lit('Here you go: {"note": "new", "items": ['),
        F.array_join(entries, ", "),
        F.lit('], "more": ['),
        F.to_json(F.struct("role")),
        F.lit(', 7, "last"]} Thanks!'),
    )
    reply = F.when(F.col("role") == "user", plain).otherwise(wrapped)
    return turns.select("conv_id", "turn", reply.alias("reply"))


@R.add(
    "explode_llm_items",
    f"""WITH u AS (SELECT conv_id, turn, {S.strip('text')} AS text, role FROM conversations),
        i AS (
          SELECT conv_id, turn, 1 AS item_no, text, 'STRING' AS kind FROM u WHERE role = 'user'
          UNION ALL SELECT conv_id, turn, 2, role, 'STRING' FROM u WHERE role = 'user'
          UNION ALL SELECT conv_id, turn, 1, CASE WHEN text = '' THEN role ELSE text END, 'OBJECT'
            FROM u WHERE role <> 'user'
          UNION ALL SELECT conv_id, turn, 2, role, 'OBJECT' FROM u WHERE role <> 'user'
          UNION ALL SELECT conv_id, turn, 3, text, 'OBJECT' FROM u WHERE role <> 'user'
          UNION ALL SELECT conv_id, turn, 4, role, 'OBJECT' FROM u WHERE role <> 'user'
          UNION ALL SELECT conv_id, turn, 6, 'last', 'STRING' FROM u WHERE role <> 'user')
        SELECT conv_id, turn, item_no::BIGINT AS item_no, text, kind FROM i WHERE text <> ''""",
)
def explode_items(spark, sf):
    items = J.explode_llm_items(conversation_replies(spark, sf), arrays="all")
    return J.item_text(items).select("conv_id", "turn", "item_no", "text", "kind")


@R.add(
    "validate_items",
    f"""SELECT conv_id, turn, 1::BIGINT AS item_no, {S.strip('text')} AS question, role AS answer
        FROM conversations WHERE role <> 'user' AND {S.strip('text')} <> ''""",
)
def validate(spark, sf):
    items = J.explode_llm_items(conversation_replies(spark, sf), arrays="first")
    return J.validate_items(items, ["question", "answer"])


@R.add(
    "dedupe_in_group",
    """SELECT source, min(doc_id) AS doc_id, count(*) AS n_copies, arg_min(lang, doc_id) AS lang,
         arg_min(n_chars, doc_id)::BIGINT AS n_chars, md5(text) AS digest
       FROM documents GROUP BY source, text""",
)
def dedupe(spark, sf):
    kept = P.dedupe_in_group(documents(spark, sf), "source", "text", "doc_id")
    return kept.withColumn("digest", F.md5("text")).drop("text")


@R.add(
    "cap_per_group",
    """SELECT lang, doc_id, position, n < 120 AS is_short FROM (
         SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS position,
                count(*) OVER (PARTITION BY lang) AS n FROM documents) WHERE position <= 120""",
)
def cap(spark, sf):
    return P.cap_per_group(documents(spark, sf).select("lang", "doc_id"), "lang", "doc_id", 120)


@R.add(
    "assign_seq_id",
    """SELECT doc_id, printf('faq_%03d', row_number() OVER (ORDER BY doc_id)) AS seq_id
       FROM documents""",
)
def sequence(spark, sf):
    return P.assign_seq_id(documents(spark, sf).select("doc_id"), "doc_id")


@R.add(
    "seeded_shuffle",
    """SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS position
       FROM documents""",
)
def shuffle(spark, sf):
    return P.seeded_shuffle(documents(spark, sf).select("doc_id"), "doc_id")


@R.add("class_counts", "SELECT label::BIGINT AS label, count(*) AS n_rows FROM embeddings GROUP BY 1")
def class_counts(spark, sf):
    return P.class_counts(table(spark, sf, "embeddings"), "label")


@R.add(
    "class_summary",
    "SELECT count(*) AS n_rows, count(DISTINCT quality) AS n_labels FROM labels",
)
def class_summary(spark, sf):
    return P.class_summary(table(spark, sf, "labels"), "quality")


@R.add(
    "append_examples",
    "SELECT text AS query_text, lang AS intent_label FROM documents UNION ALL VALUES "
    + ", ".join(f"({S.quote(q)}, '{label}')" for q, label in EXTRA),
)
def append(spark, sf):
    train = documents(spark, sf).select(
        F.col("text").alias("query_text"), F.col("lang").alias("intent_label")
    )
    return P.append_examples(train, inline_records(spark, EXTRA, INTENT))


@R.add("peek", "SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 5")
def peek(spark, sf):
    return P.peek(documents(spark, sf), ["doc_id", "lang", "source"], 5, ["doc_id"])


@R.add(
    "sample_rows",
    "SELECT doc_id, lang FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 5",
)
def sample(spark, sf):
    return P.sample_rows(documents(spark, sf), "doc_id", 5).select("doc_id", "lang")
