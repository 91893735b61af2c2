"""Intent classification on embeddings: split, fit, predict, reject."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import OOD_MESSAGE, OOD_THRESHOLD, STATUS_CONFIRMED, STATUS_OOD
from ..functions.vectors import as_double
from .scale import hash_key, hash_rank


def stratified_split(
    df: DataFrame, label: str, row_id: str, test_share: float = 0.20, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: exactly round(share * n) rows of every label, picked by a seeded hash.

    Rows are numbered in small hash pieces per label, so a label that holds most of the table is
    still shared among tasks.
    """
    keyed = df.withColumn("_key", hash_key(seed, row_id))
    placed = hash_rank(keyed, "_key", row_id, "_position", group=label, total="_n")
    is_test = F.col("_position") <= F.round(F.col("_n") * test_share)
    return placed.withColumn("is_test", is_test).drop("_key", "_position", "_n")


@dataclass(frozen=True)
class IntentModel:
    """Fitted classifier and its labels in id order."""

    classifier: LogisticRegressionModel
    labels: list


def fit_intent(
    train: DataFrame,
    label: str,
    vector: str = "embedding",
    c: float = 1.0,
    max_iter: int = 1000,
) -> IntentModel:
    """Multinomial logistic regression with squared penalty of strength 1 / (c * rows).

    Labels are encoded alphabetically; the label list is the number of classes long. Rows without
    a label or a vector are left out.
    """
    train = train.filter(F.col(label).isNotNull() & F.col(vector).isNotNull())
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label).collect()
    labels, n = [r[0] for r in counts], sum(r["n"] for r in counts)
    ids = F.create_map(*[x for i, l in enumerate(labels) for x in (F.lit(l), F.lit(float(i)))])
    rows = train.select(
        F.element_at(ids, F.col(label)).alias("label"),
        array_to_vector(as_double(vector)).alias("features"),
    )
    estimator = LogisticRegression(
        family="multinomial",
        maxIter=max_iter,
        regParam=1.0 / (c * n),
        elasticNetParam=0.0,
        standardization=False,
    )
    return IntentModel(estimator.fit(rows), labels)


def predict_intent(df: DataFrame, model: IntentModel, vector: str = "embedding") -> DataFrame:
    """Add predicted_intent, confidence_score and class_distribution (largest first, 4 places)."""
    featured = df.withColumn("_features", array_to_vector(as_double(vector)))
    scorer = model.classifier.copy()
    scorer.setFeaturesCol("_features").setProbabilityCol("_probability")
    scorer.setRawPredictionCol("_raw").setPredictionCol("_prediction")
    scored = scorer.transform(featured).withColumn("_p", vector_to_array("_probability"))
    names = F.array(*[F.lit(l) for l in model.labels])
    entries = F.zip_with(
        names, "_p", lambda l, p: F.struct(l.alias("label"), F.round(p, 4).alias("probability"))
    )
    keyed = F.transform(
        entries, lambda e: F.struct((-e["probability"]).alias("k"), e["label"].alias("l"), e.alias("e"))
    )
    best = F.array_position("_p", F.array_max("_p")).cast("int")
    return (
        scored.withColumn("predicted_intent", F.element_at(names, best))
        .withColumn("confidence_score", F.round(F.array_max("_p"), 4))
        .withColumn("class_distribution", F.transform(F.array_sort(keyed), lambda x: x["e"]))
        .drop("_features", "_probability", "_raw", "_prediction", "_p")
    )


def reject_unsure(
    predictions: DataFrame, threshold: float = OOD_THRESHOLD, message: str = OOD_MESSAGE
) -> DataFrame:
    """Decide per prediction: below the threshold it falls back with a provisional intent."""
    unsure: Column = F.col("confidence_score") < threshold
    return predictions.select(
        *[c for c in predictions.columns if c != "predicted_intent"],
        F.when(unsure, STATUS_OOD).otherwise(STATUS_CONFIRMED).alias("status"),
        F.when(~unsure, F.col("predicted_intent")).alias("predicted_intent"),
        F.when(unsure, F.col("predicted_intent")).alias("provisional_intent"),
        F.when(unsure, message).alias("fallback_message"),
    )


def predict_with_fallback(
    df: DataFrame,
    model: IntentModel,
    threshold: float = OOD_THRESHOLD,
    vector: str = "embedding",
    message: str = OOD_MESSAGE,
) -> DataFrame:
    return reject_unsure(predict_intent(df, model, vector), threshold, message)


def retrain_with_new_class(
    train: DataFrame, extra: DataFrame, label: str, vector: str = "embedding", **options
) -> IntentModel:
    """Append rows of a new class, rebuild the label ids and fit again."""
    columns = [label, vector]
    both = train.select(*columns).unionByName(extra.select(*columns))
    return fit_intent(both, label, vector, **options)
