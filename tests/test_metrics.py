from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tabloom.functions.scores import array_element, class_probability, clipped, log_loss
from tabloom.operators import metrics, scoring

FIVE = [(0.8, 1.0), (0.8, 0.0), (0.4, 0.0), (0.35, 1.0), (0.1, 0.0)]


def scores(spark, rows):
    return spark.createDataFrame(rows, "p1 double, label double")


def test_five_scores(spark):
    areas = metrics.curve_areas(scores(spark, FIVE)).first()
    assert areas["area_under_roc"] == pytest.approx(0.5833333333)
    assert areas["area_under_pr"] == pytest.approx(0.4583333333)


def test_areas_equal_mllib_without_binning(spark):
    rng = np.random.default_rng(11)
    rows = [(float(p), float(rng.random() < p)) for p in np.concatenate([rng.random(3000), np.full(1500, 0.25), np.round(rng.random(800), 2)])]
    df = scores(spark, rows)
    areas = metrics.curve_areas(df).first()
    for metric, column in (("areaUnderROC", "area_under_roc"), ("areaUnderPR", "area_under_pr")):
        evaluator = BinaryClassificationEvaluator(rawPredictionCol="p1", metricName=metric, numBins=0)
        assert areas[column] == pytest.approx(evaluator.evaluate(df), abs=1e-12)


def test_threshold_curve(spark):
    rows = {r["threshold"]: r for r in metrics.threshold_curve(scores(spark, FIVE)).collect()}
    cells = {t: (r["tp"], r["fp"], r["tn"], r["fn"]) for t, r in rows.items()}
    assert cells == {0.8: (1, 1, 2, 1), 0.4: (1, 2, 1, 1), 0.35: (2, 2, 1, 0), 0.1: (2, 3, 0, 0)}
    assert (rows[0.8]["precision"], rows[0.8]["recall"], rows[0.8]["fpr"]) == (0.5, 0.5, pytest.approx(1 / 3))


def test_log_loss(spark):
    loss = lambda rows: metrics.mean_log_loss(scores(spark, rows)).first()["log_loss"]
    assert loss([(0.9, 1.0), (0.2, 0.0)]) == pytest.approx(0.164252033)
    assert loss([(0.9, 1.0), (0.2, 0.0), (1.0, 1.0)]) == pytest.approx(0.109501355)


def test_log_loss_honours_column_names(spark):
    df = spark.createDataFrame([(0.9, 1.0, 0.5, 0.0)], "score double, truth double, p1 double, label double")
    assert metrics.mean_log_loss(df, "truth", "score").first()["log_loss"] == pytest.approx(-math.log(0.9))


def test_null_scores_stay_null(spark):
    df = spark.createDataFrame([(None, 1.0)], "p1 double, label double")
    assert df.select(clipped("p1").alias("c"), log_loss("label", "p1").alias("l")).first() == (None, None)


def test_one_predicted_class(spark):
    df = spark.createDataFrame([(0.2, 1.0, 0.0), (0.1, 0.0, 0.0)], "p1 double, label double, prediction double")
    row = metrics.confusion(df).first()
    assert (row["false_positives"], row["true_positives"], row["true_negatives"], row["false_negatives"]) == (0, 0, 1, 1)
    summary = {r["Metric"]: (r["Class_0"], r["Class_1"]) for r in metrics.fit_summary(df).collect()}
    assert summary["Precision"] == (0.5, 0.0) and summary["F-measure"][1] == 0.0


def test_evaluate_agrees_with_its_parts(spark):
    rng = np.random.default_rng(2)
    rows = [(float(p), float(rng.random() < p), float(p > 0.35)) for p in np.round(rng.random(2000), 3)]
    df = spark.createDataFrame(rows, "p1 double, label double, prediction double")
    whole = metrics.evaluate(df, {"m": ("p1", "prediction")}).first()
    assert whole["log_loss"] == pytest.approx(metrics.mean_log_loss(df).first()["log_loss"])
    cells = metrics.confusion(df).first().asDict()
    assert {k: whole[k] for k in cells} == cells


def test_models_are_ordered_by_precision_recall_area(spark):
    rows = [(1.0, 0.9, 0.1, 1.0), (1.0, 0.8, 0.7, 1.0), (0.0, 0.2, 0.8, 0.0), (0.0, 0.1, 0.9, 1.0)]
    df = spark.createDataFrame(rows, "label double, good double, bad double, guess double")
    table = metrics.compare_models(df, {"bad": ("bad", "guess"), "good": ("good", "guess")}).collect()
    assert [r["model"] for r in table] == ["good"] * 7 + ["bad"] * 7
    assert [r["metric"] for r in table[:7]] == list(metrics.METRICS)
    assert table[0]["value"] == 1.0


def test_only_one_class(spark):
    row = metrics.curve_areas(scores(spark, [(0.4, 1.0), (0.6, 1.0)])).first()
    assert row["area_under_roc"] is None and row["area_under_pr"] == 1.0


def test_probability_column_by_name(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense(0.3, 0.7), Vectors.dense(0.9, 0.1))], ["probability", "other"])
    assert scoring.add_class_probability(df, "other", "q").columns == ["probability", "other", "q"]
    assert scoring.add_class_probability(df, "other", "q").first()["q"] == 0.1
    assert df.select(class_probability(position=5).alias("p")).first()["p"] is None


def test_array_element_out_of_range(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "a array<double>")
    assert df.select(array_element("a", 1).alias("x"), array_element("a", 2).alias("y")).first() == (2.0, None)


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(0.35,), (0.36,), (None,)], "p1 double")
    assert [r["prediction"] for r in scoring.add_class(df, "p1", 0.35).collect()] == [0.0, 1.0, None]


def test_linear_score(spark):
    df = spark.createDataFrame([(2.0, 1)], "a double, b int")
    assert scoring.linear_score(df, {"a": 0.5, "b": -1.0}, 0.25).first()["p1"] == pytest.approx(1 / (1 + math.exp(-0.25)))


def test_peek_is_a_limit(spark):
    assert scoring.peek(spark.range(100), 3).count() == 3
    assert metrics.mean_log_loss(scores(spark, [(0.5, 1.0)])).select(F.round("log_loss", 4)).first()[0] == 0.6931
