"""Exact duplicates by 128-bit content hash, with a byte comparison inside every group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.operators.scale import within_bound, written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def content_hash(text: Column) -> Column:
    """128 bits of content."""
    return F.unhex(F.md5(text))


def _joined(big: DataFrame, small: DataFrame, on: list[str], how: str) -> DataFrame:
    return big.join(F.broadcast(small) if within_bound(small) else small, on, how)


def exact_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "min",
    normalise: Callable[[Column], Column] = lower_ascii,
    fingerprint: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """Every row with the row of its group that stays.

    Texts are equal if their normalised bytes are. ``keep`` names the id that stays, the smallest
    ("min") or the largest ("max"). Only hashes are shuffled for all rows. The texts of groups of
    two and more are then grouped by hash and bytes, folded inside each task first, so a group
    that fills a third of the table sends one text per task. Groups whose hash is shared by
    different bytes are split by bytes.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256`` (of the normalised text), one row
    per input row. Null texts count as empty texts, which are equal to each other. Null ids never
    stay unless the whole group has none; then ``keep_id`` is null and its rows are kept. Rows
    that repeat an id count in ``group_size`` and share one verdict. Other columns are ignored,
    whatever their names. An empty table gives an empty result.
    """
    best = {"min": F.min, "max": F.max}[keep]
    texts = docs.select(
        F.col(id_col).alias("doc_id"),
        normalise(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("_text"),
    ).withColumn("_hash", fingerprint(F.col("_text")))
    rows = written(
        texts.select("doc_id", "_hash", F.unhex(F.sha2("_text", 256)).alias("_sha")), "exact-rows"
    )
    found = [best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")]
    groups = written(
        rows.groupBy("_hash").agg(*found).filter("group_size > 1"), "exact-groups"
    )
    shared = _joined(texts, groups.select("_hash"), ["_hash"], "left_semi")
    variants = written(shared.groupBy("_hash", "_text").agg(*found), "exact-variants")
    clashing = written(
        variants.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_hash"),
        "exact-clashes",
    )
    classes = rows.join(groups, "_hash", "left")
    if not clashing.isEmpty():
        sha = F.unhex(F.sha2("_text", 256)).alias("_sha")
        split = _joined(texts, clashing, ["_hash"], "left_semi").join(variants, ["_hash", "_text"])
        classes = _joined(classes, clashing, ["_hash"], "left_anti").unionByName(
            split.select("_hash", "doc_id", sha, "keep_id", "group_size")
        )
    alone = F.col("group_size").isNull()
    kept = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return classes.select(
        "doc_id",
        kept.alias("keep_id"),
        F.coalesce(F.col("group_size"), F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(kept).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )
