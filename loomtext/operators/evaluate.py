"""Classification metrics from a table of (actual, predicted)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def accuracy(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", by: str | None = None
) -> DataFrame:
    """Correct over total, overall or per split."""
    right = (F.col(actual) == F.col(predicted)).cast("int")
    keys = [by] if by else []
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(right).alias("n_correct"),
        (F.sum(right) / F.count(F.lit(1))).alias("accuracy"),
    )


def _cells(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)


def classification_report(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted rows.

    The table is counted once into (actual, predicted) cells; all else works on the cells.
    """
    cells = _cells(df, actual, predicted)
    sides = F.array(
        F.struct(
            F.col("actual").cast("string").alias("class"),
            F.col("n").alias("support"),
            F.lit(0).cast("long").alias("claimed"),
            F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hits"),
        ),
        F.struct(
            F.col("predicted").cast("string").alias("class"),
            F.lit(0).cast("long").alias("support"),
            F.col("n").alias("claimed"),
            F.lit(0).cast("long").alias("hits"),
        ),
    )
    totals = (
        cells.select(F.inline(sides))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "claimed", "hits")])
    )
    precision = _ratio(F.col("hits"), F.col("claimed"))
    recall = _ratio(F.col("hits"), F.col("support"))
    per_class = totals.select(
        "class", precision.alias("precision"), recall.alias("recall"), "support", "hits"
    ).withColumn(
        "f1",
        _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
    )
    measures = ("precision", "recall", "f1")
    share = F.sum("hits") / F.sum("support")
    summary = per_class.agg(
        F.sum("support").alias("support"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(f"w_{m}") for m in measures],
        share.alias("acc"),
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("class"),
                *[F.col(pick(m)).alias(m) for m in measures],
                F.col("support"),
            )
            for name, pick in (
                ("accuracy", lambda m: "acc"),
                ("macro avg", lambda m: f"macro_{m}"),
                ("weighted avg", lambda m: f"w_{m}"),
            )
        ]
    )
    return per_class.select("class", *measures, "support").unionByName(summary.select(F.inline(rows)))


def confusion_matrix(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """All class pairs with their counts, zero cells included (a row per cell of K x K)."""
    cells = _cells(df, actual, predicted)
    names = cells.select(F.explode(F.array("actual", "predicted")).alias("c")).agg(
        F.sort_array(F.collect_set("c")).alias("classes")  # K names
    )
    grid = (
        names.select("classes", F.explode("classes").alias("actual"))
        .select("actual", F.explode("classes").alias("predicted"))
    )
    return grid.join(cells, ["actual", "predicted"], "left").na.fill(0, subset=["n"])


def confusion_table(
    df: DataFrame, classes: list, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """The same counts as one row per actual class and one column per predicted class."""
    wide = df.groupBy(F.col(actual).alias("actual")).pivot(predicted, classes).count()
    return wide.na.fill(0)
