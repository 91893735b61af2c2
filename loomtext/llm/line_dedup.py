"""Line deduplication by content-defined chunks, in DataFrame functions alone.

A rolling hash over the hashes of neighbouring lines ends a chunk wherever it is divisible by
``DIVISOR``, so the same lines fall into the same chunks wherever they stand. A chunk of several
lines that occurs elsewhere before is removed, after its bytes have been compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.operators.scale import within_bound, written

DIVISOR = 4  # lines in a chunk on average
# The rolling hash weighs a line and the line before it.
THIS_LINE, LINE_BEFORE = 31, 17
LEAST_LINES = 2


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def _chunked(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``_lines`` and ``_chunks`` (k, first, last line); null texts have neither."""
    lines = docs.withColumn("_lines", F.split(F.col(text), "\n", -1))
    hashed = lines.withColumn("_hashes", F.transform("_lines", _line_hash))
    last = F.size("_lines") - 1

    def ends(i: Column) -> Column:
        before = F.coalesce(F.get("_hashes", i - 1), F.lit(0))
        return (i == last) | ((F.get("_hashes", i) * THIS_LINE + before * LINE_BEFORE) % DIVISOR == 0)

    cut = hashed.withColumn(
        "_ends", F.when(last >= 0, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), ends))
    )

    def chunk(end: Column, k: Column) -> Column:
        first = F.coalesce(F.get("_ends", k - 1), F.lit(-1)) + 1
        return F.struct(k.alias("k"), first.alias("first"), end.alias("last"))

    return cut.withColumn("_chunks", F.transform("_ends", chunk)).drop("_hashes", "_ends")


def _between(chunk: Column) -> Column:
    return F.slice("_lines", chunk["first"] + 1, chunk["last"] - chunk["first"] + 1)


def _bounded(small: DataFrame) -> DataFrame:
    return F.broadcast(small) if within_bound(small) else small


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated chunks of lines taken out, and the columns ``n_lines, n_removed``.

    Of equal chunks of two lines and more that are not blank, the first stays: the one in the row
    with the smallest id, further up in the text. Chunks are grouped by a 128-bit hash, folded
    inside each task before they are shuffled; only those whose hash repeats are then grouped and
    joined by their bytes. Texts of single lines are never touched, and a text that loses all its
    lines becomes empty, not null.

    Null texts stay null (no lines); rows with a null id stay as they are and remove nothing.
    Equal rows with one id are one occurrence: both keep their lines; rows that share an id but
    not a text are ordered by a hash of the text. Other columns are passed on, whatever their
    names (``n_lines`` and ``n_removed`` are replaced); an empty table gives an empty result.
    """
    fixed = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), fixed.alias("_at"), F.col(text_col).alias("_text"))
    chunked = _chunked(rows, "_text")
    # Texts of chunks are made before the rows are spread, so that no row carries all lines; an
    # outer explode keeps Spark from filtering by the chunks beforehand, once per line.
    spelled = F.transform(
        "_chunks",
        lambda c: F.struct(
            c["k"].alias("k"),
            (c["last"] - c["first"] + 1).alias("n"),
            F.array_join(_between(c), "\n").alias("body"),
        ),
    )
    spoken = (
        chunked.filter("_at.id IS NOT NULL")
        .select("_at", F.explode_outer(spelled).alias("_chunk"))
        .filter(F.col("_chunk.n") >= LEAST_LINES)
        .select("_at", F.col("_chunk.k").alias("k"), F.col("_chunk.body").alias("_bytes"))
        .filter(F.trim(F.translate("_bytes", "\n\t\r", "   ")) != "")
        .withColumn("_hash", F.unhex(F.md5("_bytes")))
    )
    hashes = spoken.groupBy("_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_hash")
    repeated = written(hashes, "line-hashes")
    seen = written(spoken.join(_bounded(repeated), "_hash", "left_semi"), "line-chunks")
    place = F.struct("_at", "k")
    firsts = seen.groupBy("_hash", "_bytes").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("n"))
    firsts = written(firsts.filter("n > 1").drop("n"), "line-firsts")
    later = seen.join(firsts, ["_hash", "_bytes"]).filter(place != F.col("_first"))
    gone = written(
        later.groupBy("_at.id", "_at.mark").agg(F.collect_set("k").alias("_gone")), "line-gone"
    )
    marked = chunked.join(
        _bounded(gone), (F.col("_at.id") == gone["id"]) & (F.col("_at.mark") == gone["mark"]), "left"
    )
    untouched = F.col("_gone").isNull()
    left = F.filter("_chunks", lambda c: ~F.array_contains("_gone", c["k"]))
    lines = F.flatten(F.transform(left, _between))
    text = F.when(untouched, F.col("_text")).otherwise(F.array_join(lines, "\n"))
    n = F.coalesce(F.size("_lines"), F.lit(0))
    n_lines = F.when(F.col("_text").isNull(), 0).otherwise(n)
    removed = F.when(untouched, 0).otherwise(n - F.size(lines))
    # Computed on their own: beside the other columns, a lambda would take their names for its own.
    judged = marked.select(
        "_row", text.alias("_left"), n_lines.cast("long").alias("_n"), removed.cast("long").alias("_gone")
    )
    others = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    passed = [F.col("_left" if c == text_col else f"_row.`{c}`").alias(c) for c in others]
    return judged.select(*passed, F.col("_n").alias("n_lines"), F.col("_gone").alias("n_removed"))
