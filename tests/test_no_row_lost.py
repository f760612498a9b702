"""Rows that have no place in a result are errors, not silently left out."""

import pytest
from pyspark.errors import PySparkException

from txlab.operators import metrics, models, resample


def rows(spark, labels):
    return spark.createDataFrame([(k, c, float(k)) for k, c in enumerate(labels)], "id long, label int, x double")


@pytest.mark.parametrize("step", [resample.undersample, resample.oversample])
def test_null_label(spark, step):
    with pytest.raises(PySparkException, match="no label"):
        step(rows(spark, [0] * 20 + [1] * 18 + [None] * 2), "id", "label").collect()


def test_minority_of_one(spark):
    with pytest.raises(ValueError, match="one row"):
        resample.smote(rows(spark, [0] * 11 + [1]), "id", "label", ["x"])


def test_minority_of_text(spark):
    d = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "label string")
    assert resample.minority_class(d, "label") == "c"


@pytest.mark.parametrize("label, prediction", [(2, 1), (None, 1), (1, None), (0, 3)])
def test_foreign_labels(spark, label, prediction):
    d = spark.createDataFrame([(1, 1), (0, 0), (label, prediction)], "label int, prediction int")
    with pytest.raises(PySparkException, match="neither 0 nor 1"):
        metrics.confusion_matrix(d, "label", "prediction").collect()


@pytest.mark.parametrize("score", [None, float("nan")])
def test_scores_without_a_place(spark, score):
    d = spark.createDataFrame([(1, 0.5), (0, score)], "label int, score double")
    with pytest.raises(PySparkException, match="NULL or NaN"):
        metrics.score_curve(d, "label", "score").collect()


def test_depth():
    assert models.tree_depth(None) == 30 and models.tree_depth(7) == 7
    with pytest.raises(ValueError):
        models.tree_depth(31)
