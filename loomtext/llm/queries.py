"""The registered queries of the training-data operators, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.llm import (
    chat,
    decontaminate,
    exact_dedup,
    line_dedup,
    mixing,
    near_dedup,
    negatives,
    phrases,
    pieces,
    secrets,
    substring_dedup,
    token_files,
    toxicity,
)

PIECES = "piece_bpe_32k.model"
WORD_BPE = ("word_bpe_49k.json", 49_408, 2)  # file, number of ids, id that ends a document


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    found = decontaminate.find_contamination(docs, items)
    covered = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        covered.cast("long").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (covered > 0).alias("contaminated"),
    )


OP1_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
    SELECT DISTINCT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, least(len(w), 10) AS n,
           array_to_string(list_slice(w, s, s + 9), ' ') AS seq
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM windows),
grams AS (
    SELECT doc_id, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS seq
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lengths WHERE len(w) >= n)
), hits AS (SELECT doc_id, item_id, s, g.n FROM grams g JOIN windows USING (n, seq)),
covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select("doc_id", "held_out", "score", "predicted")


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame(
        [(-7, 0, "user", trap), (-7, 1, "assistant", trap)],
        "conv_id long, turn long, role string, text string",
    )
    chats = chat.formatted_chats(chat.chat_segments(turns.unionByName(more)))
    said = F.transform(
        chat.parse_chat(F.col("formatted")),
        lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")),
    )
    learned = F.array_join(F.transform("learned", lambda t: chat.unescape(t)), "")
    return chats.select(
        "conv_id",
        F.size(said).cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP3_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
                     (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), escaped AS (
    SELECT *, regexp_replace(regexp_replace(text, '(#)(\\*)(## )', '\1\\\2\3', 'g'),
                             '(<)(\\*)(/turn>)', '\1\\\2\3', 'g') AS inside
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
           AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### ' || role || ':' || chr(10) || inside || '</turn>' || chr(10))) AS BIGINT)
           AS formatted_chars
FROM escaped GROUP BY conv_id
"""


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its number of ids, a digest of them, and one of the text read back."""
    path = public_tokenizers.path(PIECES)
    docs = _table(spark, sf_dir, "documents")
    back = pieces.decode_pieces(pieces.encode_pieces(docs, path), path)
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"),
    )


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(_table(spark, sf_dir, "documents"))

    def count(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def shown(spans: F.Column) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"] != "named")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(shown(base), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, the lines taken out, and a digest of the text that is left."""
    left = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return left.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.length(text).cast("long").alias("n_chars"),
        F.sha2(text, 256).alias("text_sha256"),
    )


OP6_SQL = r"""
WITH lines AS (
    SELECT doc_id, i, l, CAST('0x' || substr(md5(l), 1, 7) AS BIGINT) AS h
    FROM (SELECT doc_id, unnest(s) AS l, unnest(range(len(s))) AS i
          FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL))
), ends AS (
    SELECT *, (h * 31 + coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0) * 17) % 4 = 0 AS stop
    FROM lines
), numbered AS (
    SELECT *, coalesce(sum(CAST(stop AS INT)) OVER (PARTITION BY doc_id ORDER BY i
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM ends
), chunks AS (
    SELECT doc_id, k, min(i) AS at, count(*) AS n, string_agg(l, chr(10) ORDER BY i) AS body
    FROM numbered GROUP BY doc_id, k
), judged AS (
    SELECT *, n >= 2 AND trim(translate(body, chr(10) || chr(9) || chr(13), '   ')) <> ''
              AND row_number() OVER (PARTITION BY body, n >= 2 ORDER BY doc_id, k) > 1 AS gone FROM chunks
), left_over AS (
    SELECT doc_id, sum(n) AS n_lines, coalesce(sum(n) FILTER (gone), 0) AS n_removed,
           coalesce(string_agg(body, chr(10) ORDER BY k) FILTER (NOT gone), '') AS body
    FROM judged GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(length(coalesce(body, '')) AS BIGINT) AS n_chars, sha256(coalesce(body, '')) AS text_sha256
FROM documents LEFT JOIN left_over USING (doc_id)
"""


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.dedup_substrings(_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, s, array_to_string(list_slice(w, s, s + 19), ' ') AS seq
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)
), later AS (
    SELECT doc_id, s FROM windows
    QUALIFY row_number() OVER (PARTITION BY seq ORDER BY doc_id, s) > 1
), gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM later),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS body, count(*) AS n
    FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_components(_table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, s, s + 4), ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM d WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS (
    SELECT p.a, p.b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
        FROM grams x JOIN grams y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2
    ) p JOIN sizes s ON s.doc_id = p.a JOIN sizes t ON t.doc_id = p.b
    WHERE 100 * common >= 75 * (s.n + t.n - common)
), reach AS (
    WITH RECURSIVE r(doc_id, c) AS (
        SELECT doc_id, doc_id FROM documents
        UNION SELECT l.b, r.c FROM r JOIN links l ON l.a = r.doc_id WHERE r.c < l.b
    ) SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, c AS component_id, doc_id = c AS kept
FROM d JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_classes(_table(spark, sf_dir, "documents"), keep="max")


OP9_SQL = """
WITH d AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM d WINDOW same AS (PARTITION BY norm)
"""


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, size, end = WORD_BPE
    docs = _table(spark, sf_dir, "documents")
    store = token_files.write_token_files(docs, public_tokenizers.path(name), end, size, unnamed=True)
    return token_files.read_token_files(spark, store)


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(_table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?' || chr(11) || chr(12) || chr(13),
        'abcdefghijklmnopqrstuvwxyz' || repeat(chr(10), 9)), chr(10))) AS piece
    FROM documents
), words AS (
    SELECT lang, w FROM (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces) WHERE len(w) > 0
), numbered AS (SELECT lang, row_number() OVER () AS id, w FROM words),
flat AS (SELECT lang, id, unnest(w) AS x, unnest(range(len(w))) AS i FROM numbered),
ahead AS (
    SELECT lang, x, lead(x) OVER piece AS y, lead(x, 2) OVER piece AS z FROM flat
    WINDOW piece AS (PARTITION BY id ORDER BY i)
), f1 AS (SELECT lang, x, count(*) AS n FROM ahead GROUP BY lang, x),
f2 AS (SELECT lang, x, y, count(*) AS n FROM ahead WHERE y IS NOT NULL GROUP BY lang, x, y),
f3 AS (SELECT lang, x, y, z, count(*) AS n FROM ahead WHERE z IS NOT NULL GROUP BY lang, x, y, z HAVING count(*) >= 10),
sizes AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f1 GROUP BY lang),
parts AS (
    SELECT lang, x, y, max(n) AS longer
    FROM (SELECT lang, x, y, n FROM f3 UNION ALL SELECT lang, y, z, n FROM f3) GROUP BY lang, x, y
), cuts AS (
    SELECT g.lang, g.x || ' ' || g.y || ' ' || g.z AS phrase, 1 AS k, g.n AS a, l.n AS l, r.n AS r
    FROM f3 g JOIN f1 l ON l.lang = g.lang AND l.x = g.x JOIN f2 r ON r.lang = g.lang AND r.x = g.y AND r.y = g.z
    UNION ALL
    SELECT g.lang, g.x || ' ' || g.y || ' ' || g.z, 2, g.n, l.n, r.n
    FROM f3 g JOIN f2 l ON l.lang = g.lang AND l.x = g.x AND l.y = g.y JOIN f1 r ON r.lang = g.lang AND r.x = g.z
    UNION ALL
    SELECT g.lang, g.x || ' ' || g.y, 1, g.n, l.n, r.n
    FROM f2 g JOIN f1 l ON l.lang = g.lang AND l.x = g.x JOIN f1 r ON r.lang = g.lang AND r.x = g.y
    LEFT JOIN parts p ON p.lang = g.lang AND p.x = g.x AND p.y = g.y
    WHERE g.n >= 10 AND (longer IS NULL OR 100 * longer < 50 * g.n)
), scored AS (
    SELECT *, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts
), best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER first AS rank, phrase, a, l, r, n, score
FROM best JOIN sizes USING (lang)
WINDOW first AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY row_number() OVER first <= 2000
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are a hundredth of the rows; every seventh row has a wrong label."""
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").withColumn("label", shifted)
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH r AS (
    SELECT * FROM (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, q) = 1
), scored AS (
    SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS id, b.label,
           CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE label = own
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INT) AS rank, id AS negative_id,
       positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE label <> own AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER best <= 5
"""


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "budget", "place")


OP13_SQL = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           md5('13:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents
), sizes AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS s, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
    FROM d GROUP BY source
), shares AS (
    -- Sources by the share at which they are full: one is above if what the fuller ones leave, shared
    -- by the weights that are left, gives it more than three times its size.
    SELECT *, CAST(sum(s) OVER () - coalesce(3 * sum(s) OVER before, 0) AS HUGEINT) AS free,
           CAST(sum(w) OVER (ORDER BY s * 6 / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS HUGEINT) AS rest
    FROM sizes WINDOW before AS (ORDER BY s * 6 / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), judged AS (SELECT *, free * w > CAST(3 * s AS HUGEINT) * rest AS above FROM shares),
left_over AS (
    SELECT CAST((SELECT sum(s) FROM sizes) - coalesce(sum(3 * s) FILTER (above), 0) AS BIGINT) AS free,
           CAST(sum(w) FILTER (NOT above) AS BIGINT) AS rest FROM judged
), targets AS (
    SELECT source, s AS source_size,
           CASE WHEN above THEN CAST(3 * s AS DOUBLE) ELSE CAST(free * w AS DOUBLE) / CAST(rest AS DOUBLE) END AS target,
           CAST(CASE WHEN above THEN 3 * s ELSE free * w // rest END AS BIGINT) AS budget
    FROM (SELECT j.source, j.s, j.w, j.above, l.free, l.rest FROM judged j, left_over l)
), placed AS (
    SELECT doc_id, d.source, size, source_size, target, budget,
           CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place
    FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, source, budget, place,
       budget // greatest(source_size, 1) * size
           + greatest(0, least(budget % greatest(source_size, 1) - place, size)) AS taken
FROM placed
"""


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_benchmark_decontamination": op1_benchmark_decontamination,
        "op2_toxicity": op2_toxicity,
        "op4_sentencepiece": op4_sentencepiece,
        "op3_chat_formatting": op3_chat_formatting,
        "op5_secret_scans": op5_secret_scans,
        "op6_line_dedup": op6_line_dedup,
        "op7_substring_dedup": op7_substring_dedup,
        "op8_minhash_near_dedup": op8_minhash_near_dedup,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_token_files": op10_token_files,
        "op11_phrase_collocations": op11_phrase_collocations,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_source_mixing": op13_source_mixing,
    }


def all_sql() -> dict[str, str]:
    return {"op1_benchmark_decontamination": OP1_SQL, "op3_chat_formatting": OP3_SQL, "op6_line_dedup": OP6_SQL,
        "op7_substring_dedup": OP7_SQL,
        "op8_minhash_near_dedup": OP8_SQL,
        "op9_exact_dedup": OP9_SQL,
        "op11_phrase_collocations": OP11_SQL,
        "op12_hard_negatives": OP12_SQL,
        "op13_source_mixing": OP13_SQL}
