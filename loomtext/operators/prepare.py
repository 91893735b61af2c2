"""Record preparation: pages, repeats, caps, ids, shuffles, counts, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.constants import FAQ_ID_FORMAT
from ..functions.text import strip
from .scale import hash_key, hash_rank, ordered_number


def with_full_text(
    df: DataFrame, parts: Sequence[str] = ("question", "answer"), name: str = "full_text"
) -> DataFrame:
    """Join the parts with one space; a null part counts as empty text."""
    texts = [F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts]
    return df.withColumn(name, F.concat_ws(" ", *texts))


def mark_pages(df: DataFrame, page_no: str = "page_no", text: str = "text") -> DataFrame:
    """Pages with text, each under its page marker."""
    marked = F.concat(F.lit("--- PAGE "), F.col(page_no).cast("string"), F.lit(" ---\n"), strip(text))
    return df.filter(F.col(text) != "").withColumn(text, marked)


def assemble_pages(
    df: DataFrame, doc: str = "doc_id", page_no: str = "page_no", text: str = "text"
) -> DataFrame:
    """One text per document from its marked pages, in page order with blank lines between.

    A document is one string by definition, so its pages meet in one row; where documents can
    outgrow a row, chunk the rows of ``mark_pages`` instead.
    """
    pages = F.sort_array(F.collect_list(F.struct(page_no, text)))
    body = F.array_join(F.transform(pages, lambda p: p[text]), "\n\n")
    return mark_pages(df, page_no, text).groupBy(doc).agg(body.alias(text))


def dedupe_in_group(df: DataFrame, group: str, text: str, order: str) -> DataFrame:
    """Whole first row by ``order`` of every distinct text in a group, with the number of copies.

    Copies are folded before the shuffle by a digest of the text, so a text that fills a third of
    the table leaves each task as one row. Texts that are null are copies of each other, and so
    are groups that are null. ``order`` should be unique: of rows that tie, any may stay. A row
    whose ``order`` is null stays only if it has no copy with one.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    place = F.struct(F.col(order).isNull(), F.col(order))
    return (
        df.groupBy(F.col(group).alias("_group"), F.sha2(F.col(text), 256).alias("_digest"))
        .agg(F.min_by(row, place).alias("_row"), F.count(F.lit(1)).alias("n_copies"))
        .select("_row.*", "n_copies")
    )


def cap_per_group(df: DataFrame, group: str, order: str, n: int) -> DataFrame:
    """First n rows per group, and whether the group fell short of n.

    The ranking is cut to n rows per task and group before the shuffle; sizes are counted apart.
    """
    first = Window.partitionBy(group).orderBy(order)
    kept = df.withColumn("position", F.row_number().over(first)).filter(F.col("position") <= n)
    sizes = df.groupBy(group).agg((F.count(F.lit(1)) < n).alias("is_short"))
    return kept.join(sizes, group)


def assign_seq_id(
    df: DataFrame, order: str, name: str = "seq_id", fmt: str = FAQ_ID_FORMAT
) -> DataFrame:
    """Sequential ids such as faq_001 in the order of a unique column; width grows past padding."""
    numbered = ordered_number(df, order, "_number")
    return numbered.withColumn(name, F.format_string(fmt, "_number")).drop("_number")


def seeded_shuffle(df: DataFrame, row_id: str, seed: int = 42) -> DataFrame:
    """Every row with its position in a reproducible full shuffle."""
    keyed = df.withColumn("_key", hash_key(seed, row_id))
    return hash_rank(keyed, "_key", row_id, "position").drop("_key")


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per label, largest first."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), label)


def class_summary(df: DataFrame, label: str) -> DataFrame:
    """Total rows and number of distinct labels."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.sum("n").alias("n_rows"), F.count(label).alias("n_labels"))


def append_examples(df: DataFrame, extra: DataFrame) -> DataFrame:
    """Add custom labelled rows to a training set, matched by column name."""
    return df.unionByName(extra)


def peek(
    df: DataFrame, columns: Sequence[str], n: int, order: Sequence[str | Column]
) -> DataFrame:
    """First n rows of some columns."""
    return df.orderBy(*order).select(*columns).limit(n)


def sample_rows(df: DataFrame, row_id: str, n: int, seed: int = 42) -> DataFrame:
    """n rows picked by a reproducible hash."""
    return df.orderBy(hash_key(seed, row_id), row_id).limit(n)
