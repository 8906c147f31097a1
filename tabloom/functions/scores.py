"""Expressions on class scores. All of them stay on the JVM."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, functions as F

# Scores are moved this far away from 0 and 1 before a logarithm is taken.
SCORE_MARGIN = 1e-15


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def array_element(col: Column | str, position: int) -> Column:
    """Element ``position`` (from 0) of an array column, null when the array is shorter."""
    return F.get(_column(col), position)


def class_probability(col: Column | str = "probability", position: int = 1) -> Column:
    """Probability of one class out of an ML probability vector."""
    return F.get(vector_to_array(_column(col)), position)


def complement(col: Column | str) -> Column:
    return F.lit(1.0) - _column(col)


def clipped(score: Column | str) -> Column:
    """The score kept off 0 and 1; null stays null."""
    p = _column(score)
    return F.when(p.isNotNull(), F.greatest(F.lit(SCORE_MARGIN), F.least(F.lit(1.0 - SCORE_MARGIN), p)))


def log_loss(label: Column | str, score: Column | str) -> Column:
    """Log loss of one row: ``-(y ln p + (1 - y) ln(1 - p))`` with ``p`` kept off 0 and 1."""
    y, p = _column(label), clipped(score)
    return -(y * F.ln(p) + complement(y) * F.ln(complement(p)))


def linear_predictor(weights: Mapping[str, float], intercept: float = 0.0) -> Column:
    """``intercept + sum(weight * column)``, added up in the order of ``weights``."""
    total = F.lit(float(intercept))
    for name, weight in weights.items():
        total = total + F.col(name).cast("double") * F.lit(float(weight))
    return total


def logistic(col: Column | str) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_column(col)))


def threshold_class(score: Column | str, threshold: float) -> Column:
    """1.0 where the score lies above the threshold, else 0.0; null scores stay null."""
    return (_column(score) > F.lit(float(threshold))).cast("double")
