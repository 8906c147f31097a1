"""Apply fitted models. Scoring is a row-wise expression: no shuffle, no Python worker."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, functions as F

from tabloom.functions.scores import class_probability, linear_predictor, logistic, threshold_class


def add_class_probability(df: DataFrame, probability: str = "probability", alias: str = "p1") -> DataFrame:
    """``df`` with the probability of the positive class as a double column."""
    return df.select("*", class_probability(probability).alias(alias))


def apply_model(model: Model, prepared: DataFrame, alias: str = "p1") -> DataFrame:
    """Predictions of ``model`` with the positive-class probability next to them."""
    return add_class_probability(model.transform(prepared), model.getProbabilityCol(), alias)


def score(df: DataFrame, pipeline: PipelineModel, model: Model, alias: str = "p1") -> DataFrame:
    """Raw rows to predictions. The label column may be absent."""
    return apply_model(model, pipeline.transform(df), alias)


def linear_score(df: DataFrame, weights: Mapping[str, float], intercept: float = 0.0, alias: str = "p1") -> DataFrame:
    """Score with a coefficient table instead of a fitted model."""
    return df.withColumn(alias, logistic(linear_predictor(weights, intercept)))


def add_class(df: DataFrame, score_column: str = "p1", threshold: float = 0.5, alias: str = "prediction") -> DataFrame:
    return df.withColumn(alias, threshold_class(score_column, threshold))


def peek(predictions: DataFrame, n: int = 1) -> DataFrame:
    """A few predictions to look at; the other partitions are not computed."""
    return predictions.limit(n)


def score_side_by_side(models: Mapping[str, Model], prepared: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` plus ``p1_<name>`` and ``prediction_<name>`` per model, in one row-wise pass."""
    scored = prepared
    for name, model in models.items():
        outputs = {
            model.rawPredictionCol: f"raw_{name}",
            model.probabilityCol: f"probability_{name}",
            model.predictionCol: f"prediction_{name}",
        }
        scored = model.copy(outputs).transform(scored)
    return scored.select(
        *keep,
        *[class_probability(f"probability_{name}").alias(f"p1_{name}") for name in models],
        *[F.col(f"prediction_{name}") for name in models],
    )
