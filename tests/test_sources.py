from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loomtext import schemas
from loomtext.operators import prepare as P
from loomtext.sources import replies as J
from loomtext.sources.files import ingest_files
from loomtext.sources.records import inline_records, read_or_inline, read_records, write_records


def test_csv_reader_drops_incomplete_rows(spark, tmp_path):
    file = tmp_path / "faqs.csv"
    file.write_text(
        'faq_id,category,question,answer\nfaq_001,Fees,"How, when?","Say ""now""\nor later"\n'
        "faq_002,Fees,Why?,Because\n`\n",
        encoding="utf-8",
    )
    rows = read_records(spark, str(file), schemas.FAQ, ["question", "answer"]).collect()
    assert [r["faq_id"] for r in rows] == ["faq_001", "faq_002"]
    assert rows[0]["question"] == "How, when?" and rows[0]["answer"] == 'Say "now"\nor later'


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "orc"])
def test_written_records_read_back(spark, tmp_path, fmt):
    rows = [(' a "quoted", text ', "x"), ("two\nlines \\ and more", "y")]
    df = inline_records(spark, rows, schemas.INTENT)
    write_records(df, str(tmp_path / "out"), ["query_text", "intent_label"], fmt)
    back = read_records(spark, str(tmp_path / "out"), schemas.INTENT, ["query_text"], fmt)
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_missing_file_falls_back_to_literals(spark, tmp_path):
    rows = [("q", "l"), (None, "l")]
    df = read_or_inline(spark, str(tmp_path / "none.csv"), schemas.INTENT, ["query_text"], rows)
    assert [tuple(r) for r in df.collect()] == [("q", "l")]


def test_files_become_pages(spark, tmp_path):
    (tmp_path / "a.txt").write_text("first\fsecond\f", encoding="utf-8")
    (tmp_path / "b.bin").write_bytes(b"skip")
    pages = ingest_files(spark, str(tmp_path), pattern="*.txt").orderBy("page_no").collect()
    assert [(r["page_no"], r["text"]) for r in pages] == [(1, "first"), (2, "second"), (3, "")]
    upper = ingest_files(spark, str(tmp_path), lambda b: [b.decode().upper()], "*.bin").collect()
    assert [r["text"] for r in upper] == ["SKIP"]


def test_pages_are_assembled_in_order(spark):
    rows = [("d", 2, " two \n"), ("d", 1, "one"), ("d", 3, ""), ("d", 4, None), ("d", 10, "ten")]
    df = spark.createDataFrame(rows, schemas.PAGE)
    text = P.assemble_pages(df).first()["text"]
    assert text == "--- PAGE 1 ---\none\n\n--- PAGE 2 ---\ntwo\n\n--- PAGE 10 ---\nten"


REPLIES = [
    ('["a", 5, {"q": "x", "n": 3, "r": " y "}, null, " "]', ["a", "x"]),
    ('{"zeta": "s", "items": ["b", "[c"], "alpha": ["d", {"k": 1, "b": "v"}]}', ["b", "[c"]),
    ('Sure! [{"question": "Q1", "answer": "A1"}] bye', ["Q1"]),
    ('x {"a": ["1"]} y', ["1"]),
    ('{"a": 1} and ["late"]', ["late"]),
    ("broken [1, 2", []),
    ('{"a": "[\\"x\\"]", "b": ["y"]}', ["y"]),
    ('["a"], ["b"]', []),
    ("12", []),
    ("", []),
    (None, []),
]


@pytest.mark.parametrize(("reply", "texts"), REPLIES)
def test_lenient_replies(spark, reply, texts):
    df = spark.createDataFrame([(1, reply)], "id int, reply string")
    rows = J.item_text(J.explode_llm_items(df)).orderBy("item_no").collect()
    assert [r["text"] for r in rows] == texts


def test_all_arrays_of_an_object(spark):
    df = spark.createDataFrame([(1, REPLIES[1][0])], "id int, reply string")
    rows = J.item_text(J.explode_llm_items(df, arrays="all")).orderBy("item_no").collect()
    assert [r["text"] for r in rows] == ["b", "[c", "d", "v"]
    with pytest.raises(ValueError):
        J.explode_llm_items(df, arrays="some")


def test_items_need_all_keys(spark):
    reply = '[{"question": " Q ", "answer": 7}, {"question": "Q2"}, {"question": " ", "answer": "A"}, "s"]'
    df = spark.createDataFrame([(1, reply)], "id int, reply string")
    rows = J.validate_items(J.explode_llm_items(df), ["question", "answer"]).collect()
    assert [(r["question"], r["answer"]) for r in rows] == [("Q", "7")]


def test_dedupe_cap_and_ids(spark):
    rows = [(i, "g1" if i < 8 else "g2", f"t{i % 3}") for i in range(10)]
    df = spark.createDataFrame(rows, "ord int, g string, text string")
    kept = {(r["g"], r["ord"], r["n_copies"]) for r in P.dedupe_in_group(df, "g", "text", "ord").collect()}
    assert kept == {("g1", 0, 3), ("g1", 1, 3), ("g1", 2, 2), ("g2", 8, 1), ("g2", 9, 1)}
    capped = P.cap_per_group(df, "g", "ord", 3).collect()
    assert sorted(r["ord"] for r in capped) == [0, 1, 2, 8, 9]
    assert {r["g"]: r["is_short"] for r in capped} == {"g1": False, "g2": True}
    ids = P.assign_seq_id(spark.range(1200), "id").orderBy("id").collect()
    assert ids[0]["seq_id"] == "faq_001" and ids[1199]["seq_id"] == "faq_1200"


def test_shuffle_is_a_reproducible_permutation(spark):
    first = P.seeded_shuffle(spark.range(500), "id").orderBy("position").collect()
    again = P.seeded_shuffle(spark.range(500).repartition(3), "id").orderBy("position").collect()
    assert first == again and sorted(r["id"] for r in first) == list(range(500))
    other = P.seeded_shuffle(spark.range(500), "id", seed=1).orderBy("position").collect()
    assert [r["id"] for r in other] != [r["id"] for r in first]


def test_full_text_of_nulls(spark):
    df = inline_records(spark, [("1", "c", "q", None)], schemas.FAQ)
    assert P.with_full_text(df).first()["full_text"] == "q "
    assert df.filter(F.col("answer").isNull()).count() == 1


def test_csv_keeps_empty_texts_apart_from_nulls(spark, tmp_path):
    rows = [(1, "", "a"), (2, None, "b"), (3, "x, \"y\"\nz", ""), (4, " ", None)]
    df = spark.createDataFrame(rows, "id long, text string, lang string")
    write_records(df, str(tmp_path / "t"), df.columns)
    back = read_records(spark, str(tmp_path / "t"), df.schema, ["id"], multi_line=True)
    assert sorted(map(tuple, back.collect())) == rows


def test_csv_keeps_texts_like_the_null_mark(spark, tmp_path):
    texts = ["\\N", "\\\\N", "\\\\\\N", "N", "\\", "\\N\n", "a\\N", "\\n", "", None]
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, text string, lang string")
    write_records(df, str(tmp_path / "t"), ["id", "text", "lang"])
    schema = "id long, text string, lang string"
    back = read_records(spark, str(tmp_path / "t"), spark.createDataFrame([], schema).schema, ["id"])
    assert sorted(map(tuple, back.collect())) == rows
    required = read_records(spark, str(tmp_path / "t"), back.schema, ["text"])
    assert required.count() == len(rows) - 1
