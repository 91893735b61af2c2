from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtext.operators import classify as C
from loomtext.operators import evaluate as E


@pytest.fixture(scope="module")
def clusters(spark):
    """Three groups on a sphere; one label holds most of the rows."""
    rng = np.random.default_rng(3)
    rows = []
    for label, n in (("advising", 200), ("library", 40), ("parking", 60)):
        centre = rng.normal(size=8)
        for _ in range(n):
            v = centre + rng.normal(scale=0.4, size=8)
            rows.append((len(rows), label, [float(x) for x in v / np.linalg.norm(v)]))
    return spark.createDataFrame(rows, "id long, label string, embedding array<double>").cache()


@pytest.fixture(scope="module")
def model(clusters):
    return C.fit_intent(clusters, "label")


def test_split_sizes_are_exact_and_repeatable(clusters):
    split = C.stratified_split(clusters, "label", "id")
    sizes = {r["label"]: r["n"] for r in split.filter("is_test").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert sizes == {"advising": 40, "library": 8, "parking": 12}
    again = C.stratified_split(clusters.repartition(3), "label", "id")
    assert split.select("id", "is_test").exceptAll(again.select("id", "is_test")).count() == 0
    other = C.stratified_split(clusters, "label", "id", seed=1)
    assert split.select("id", "is_test").exceptAll(other.select("id", "is_test")).count() > 0


def test_fit_minimises_the_stated_loss(clusters, model):
    """At the optimum the gradient of mean cross-entropy + 1/(2n) |W|^2 is zero."""
    rows = clusters.collect()
    x = np.array([r["embedding"] for r in rows])
    y = np.array([[r["label"] == l for l in model.labels] for r in rows], dtype=float)
    w = model.classifier.coefficientMatrix.toArray()
    b = model.classifier.interceptVector.toArray()
    z = x @ w.T + b
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    gradient = (p - y).T @ x / len(x) + w / len(x)
    assert np.abs(gradient).max() < 1e-4
    assert np.abs((p - y).mean(axis=0)).max() < 1e-4


def test_predictions(clusters, model):
    assert model.labels == ["advising", "library", "parking"]
    rows = C.predict_intent(clusters, model).collect()
    for r in rows:
        shares = [e["probability"] for e in r["class_distribution"]]
        assert abs(sum(shares) - 1) < 1e-3 and shares == sorted(shares, reverse=True)
        assert 0 <= r["confidence_score"] <= 1
        assert r["class_distribution"][0]["label"] == r["predicted_intent"]
    right = sum(r["label"] == r["predicted_intent"] for r in rows)
    assert right / len(rows) >= 0.70


def test_rejection_is_strict(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", 0.4999)], "predicted_intent string, confidence_score double")
    rows = C.reject_unsure(df).orderBy(F.desc("confidence_score")).collect()
    assert (rows[0]["status"], rows[0]["predicted_intent"]) == ("CONFIRMED_INTENT", "a")
    assert (rows[1]["status"], rows[1]["predicted_intent"]) == ("OOD_FALLBACK_TRIGGERED", None)
    assert rows[1]["provisional_intent"] == "b" and rows[1]["fallback_message"]


def test_new_class(spark, clusters):
    far = spark.createDataFrame([("id_card", [-1.0] + [0.0] * 7)] * 30, "label string, embedding array<double>")
    grown = C.retrain_with_new_class(clusters, far, "label")
    assert grown.labels == ["advising", "id_card", "library", "parking"]
    assert C.predict_intent(far, grown).first()["predicted_intent"] == "id_card"


def test_report_of_unseen_classes(spark):
    df = spark.createDataFrame(
        [("a", "a"), ("a", "b"), ("b", "b"), ("c", "b"), ("c", "d")], "actual string, predicted string"
    )
    rows = {r["class"]: r for r in E.classification_report(df).collect()}
    assert rows["b"]["precision"] == pytest.approx(1 / 3) and rows["b"]["recall"] == 1.0
    assert (rows["c"]["precision"], rows["c"]["recall"], rows["c"]["f1"]) == (0.0, 0.0, 0.0)
    assert rows["d"]["support"] == 0
    assert rows["accuracy"]["f1"] == pytest.approx(0.4) and rows["accuracy"]["support"] == 5
    cells = {(r["actual"], r["predicted"]): r["n"] for r in E.confusion_matrix(df).collect()}
    assert len(cells) == 16 and cells["c", "d"] == 1 and cells["d", "d"] == 0
    assert E.accuracy(df).first()["accuracy"] == pytest.approx(0.4)
