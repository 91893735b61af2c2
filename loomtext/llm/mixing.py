"""Mixing sources to target weights: hash-random order, range sort, prefix sums, exact cuts.

Every row gets a random key that is a hash of its id. Rows are range-sorted by source and key and
written, which fixes the ranges; a row's place among its source's words is its running sum inside
its range plus the words of that source in the ranges before. A source's budget then falls on one
row exactly, wherever that lies, and a budget above the source's size repeats whole epochs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomtext.operators.scale import hash_key, ordered_number, written

WORD = r"[^\x20\x09-\x0D]+"
SEED = 13
WEIGHTS = (1, 2, 3)  # of the first, second, third source, and so on in turn
MOST_EPOCHS = 3

_RANGE_BITS = 33  # monotonically_increasing_id: number of the range above, row in it below


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def _exact(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    budget: int | None = None,
) -> DataFrame:
    """(_source, source_size, target, budget) from (_source, source_size), one row per source.

    ``budget`` words (all sizes together if none is given) are shared by weight; weights are given
    to the sorted sources in turn. Sources above ``most_epochs`` times their size are set to that,
    and what they leave is shared again until none is above; a few sums reach the driver each
    time. Comparisons are made on integers. A source's budget is the whole words of its target.
    """
    given = F.array(*[F.lit(int(w)).cast("long") for w in weights])
    numbered = ordered_number(sizes, "_source", "_number")
    table = written(
        numbered.select(
            "_source",
            "source_size",
            (F.col("source_size") * most_epochs).alias("_cap"),
            F.get(given, ((F.col("_number") - 1) % len(weights)).cast("int")).alias("_weight"),
        ),
        "mix-sources",
    )
    total, reach, weighed = (
        int(v or 0) for v in table.agg(F.sum("source_size"), F.sum("_cap"), F.sum("_weight")).first()
    )
    wanted = min(total if budget is None else budget, reach)
    shared, n_above = wanted, 0
    above = F.lit(True)
    # A share per weight only grows from round to round, so sources above it stay above.
    while weighed:
        bound, part = F.lit(weighed).cast("long"), F.lit(shared).cast("long")
        above = _exact(F.col("_weight")) * _exact(part) > _exact(F.col("_cap")) * _exact(bound)
        capped, rest, n = table.agg(
            F.sum(F.when(above, F.col("_cap"))), F.sum(F.when(~above, F.col("_weight"))), F.count_if(above)
        ).first()
        if n == n_above:
            break
        shared, weighed, n_above = wanted - int(capped), int(rest or 0), n
    if not weighed:
        above = F.lit(True)
    due = (F.col("_weight") * F.lit(shared).cast("long")).alias("_due")
    of = F.lit(max(weighed, 1)).cast("long")
    target = F.when(above, F.col("_cap").cast("double")).otherwise(F.col("_due").cast("double") / of.cast("double"))
    whole = F.when(above, F.col("_cap")).otherwise((F.col("_due") - F.col("_due") % of) / of).cast("long")
    return table.select("*", due).select("_source", "source_size", target.alias("target"), whole.alias("budget"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    budget: int | None = None,
    seed: int = SEED,
) -> DataFrame:
    """What a mix takes of every row.

    Returns ``doc_id, source, size, source_size, target, budget, place, taken``, one row per row of
    ``docs``: the words of the text, those of its source, the source's target and the whole words
    of it, the words of the source before this row in random order, and the words taken, which
    add up to the budget of every source. A row counts once in every whole epoch; in the last one
    the rows before the cut count whole and the row on it in part, so no row is taken more than
    ``most_epochs`` times.

    Null and empty texts have no words and nothing is taken of them. Rows without a source are a
    source of their own, sorted last; a source without words has target 0. Rows without an id and
    rows that repeat one count each by itself, ordered by size and a hash of the text; equal rows
    are interchangeable. The same rows and seed give the same mix whatever their order. Other
    columns are ignored, whatever their names. An empty table gives an empty result.
    """
    name = F.col(source_col).cast("string")
    rows = written(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.struct(name.isNull().alias("missing"), F.coalesce(name, F.lit("")).alias("name")).alias("_source"),
            count_words(F.col(text_col)).alias("size"),
            hash_key(seed, F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("_key"),
            F.xxhash64(F.col(text_col).cast("string")).alias("_tie"),
        ),
        "mix-rows",
    )
    sizes = rows.groupBy("_source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sizes, weights, most_epochs, budget), "mix-targets")
    placed = rows.orderBy("_source", "_key", "doc_id", "size", "_tie").select(
        "doc_id", "_source", "size", F.monotonically_increasing_id().alias("_place")
    )
    stored = written(placed, "mix-order").withColumn("_range", F.shiftright("_place", _RANGE_BITS))
    # A source has one row per range here, whatever its size.
    shares = stored.groupBy("_source", "_range").agg(F.sum("size").alias("_words"))
    earlier = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = shares.select(
        "_source", "_range", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_shift")
    ).join(targets, "_source")
    inside = Window.partitionBy("_source", "_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    local = stored.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = local.join(shifts, ["_source", "_range"]).withColumn("place", F.col("_shift") + F.col("_inside"))
    of = F.greatest("source_size", F.lit(1))
    over = F.col("budget") % of
    epochs = ((F.col("budget") - over) / of).cast("long")
    last = F.greatest(F.lit(0).cast("long"), F.least(over - F.col("place"), F.col("size")))
    return joined.select(
        "doc_id",
        F.when(~F.col("_source.missing"), F.col("_source.name")).alias("source"),
        "size",
        "source_size",
        "target",
        "budget",
        "place",
        (epochs * F.col("size") + last).alias("taken"),
    )


def mixed_texts(
    docs: DataFrame, mix: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, epoch, text): what a mix takes, a row per document and epoch; ids must be unique.

    Whole texts stay as they are; of a text on the cut the first words stay, joined by blanks.
    """
    taken = mix.filter("taken > 0").select(F.col("doc_id").alias("_id"), "size", "taken")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    repeated = rows.join(taken, F.col("doc_id") == F.col("_id")).select(
        "doc_id", "_text", "size", "taken",
        F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("taken") / F.col("size")) - 1)).alias("epoch"),
    )
    n = F.least(F.col("size"), F.col("taken") - F.col("epoch") * F.col("size"))
    first = F.array_join(F.slice(F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)), 1, n.cast("int")), " ")
    return repeated.select(
        "doc_id", F.col("epoch").cast("int").alias("epoch"), F.when(n == F.col("size"), F.col("_text")).otherwise(first).alias("text")
    )
