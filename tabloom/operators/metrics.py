"""Exact evaluation of binary classifiers.

Everything that needs the score order is an aggregate of one running-total table; several models
are evaluated side by side from a single scan of their predictions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions.scores import log_loss
from tabloom.operators.cumulative import Series, cumulative_weights

METRICS = ("area_under_pr", "area_under_roc", "log_loss", "false_positives", "true_positives", "true_negatives", "false_negatives")


def _rate(part: Column, whole: Column) -> Column:
    return part / F.nullif(whole, F.lit(0))


def mean_log_loss(df: DataFrame, label: str = "label", score: str = "p1") -> DataFrame:
    return df.agg(F.avg(log_loss(label, score)).alias("log_loss"))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row with the four cells, each counted by its own condition."""
    y, guess = F.col(label), F.col(prediction)
    return df.agg(
        F.count_if((guess == 1) & (y == 0)).alias("false_positives"),
        F.count_if((guess == 1) & (y == 1)).alias("true_positives"),
        F.count_if((guess == 0) & (y == 0)).alias("true_negatives"),
        F.count_if((guess == 0) & (y == 1)).alias("false_negatives"),
    )


def _running(df: DataFrame, label: str, models: Mapping[str, tuple[str, str | None]], buckets: int | None) -> DataFrame:
    """Running class counts along each model's score, with counts of predicted positives."""
    y = F.col(label)
    series = []
    for name, (score, prediction) in models.items():
        guess = F.col(prediction) if prediction else F.lit(None).cast("double")
        series.append(
            Series(
                name,
                score,
                {
                    "pos": (y == 1).cast("int"),
                    "neg": (y == 0).cast("int"),
                    "hit": ((y == 1) & (guess == 1)).cast("int"),
                    "alarm": ((y == 0) & (guess == 1)).cast("int"),
                },
            )
        )
    return cumulative_weights(df, series, buckets).withColumnRenamed("series", "model")


def _at_or_above(name: str) -> Column:
    """Weight of the rows whose score is at least the current one."""
    return F.col(f"total_{name}") - F.col(f"cum_{name}") + F.col(name)


def threshold_curve(df: DataFrame, label: str = "label", score: str = "p1", buckets: int | None = None) -> DataFrame:
    """``(threshold, tp, fp, tn, fn, precision, recall, fpr)`` for every distinct score.

    A row counts as predicted positive when its score is at least the threshold.
    """
    curve = _running(df, label, {"": (score, None)}, buckets).select(
        F.col("value").alias("threshold"),
        _at_or_above("pos").alias("tp"),
        _at_or_above("neg").alias("fp"),
        (F.col("cum_neg") - F.col("neg")).alias("tn"),
        (F.col("cum_pos") - F.col("pos")).alias("fn"),
    )
    return curve.select(
        "*",
        _rate(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _rate(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        _rate(F.col("fp"), F.col("fp") + F.col("tn")).alias("fpr"),
    )


def evaluate(
    df: DataFrame,
    models: Mapping[str, tuple[str, str | None]],
    label: str = "label",
    buckets: int | None = None,
) -> DataFrame:
    """One row per model: areas, log loss and confusion counts.

    ``models`` maps a name to its score column and, if there is one, its prediction column. Areas
    are by the trapezoidal rule over all distinct scores; the precision-recall curve starts at
    recall 0 with the precision of the highest score.
    """
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    all_pos, all_neg = F.col("total_pos").cast("double"), F.col("total_neg").cast("double")
    tp, fp = _at_or_above("pos").cast("double"), _at_or_above("neg").cast("double")
    tp_before, fp_before = tp - pos, fp - neg
    precision = _rate(tp, tp + fp)
    precision_before = F.coalesce(_rate(tp_before, tp_before + fp_before), precision)
    # A distinct score stands for pos + neg rows, so its two possible losses are weighted by them.
    loss = pos * log_loss(F.lit(1.0), "value") + neg * log_loss(F.lit(0.0), "value")

    running = _running(df, label, models, buckets)
    totals = running.groupBy("model").agg(
        F.sum(_rate(pos, all_pos) * (precision_before + precision) / 2.0).alias("area_under_pr"),
        F.sum(_rate(neg, all_neg) * _rate(tp_before + tp, all_pos) / 2.0).alias("area_under_roc"),
        (F.sum(loss) / F.nullif(F.sum(pos + neg), F.lit(0.0))).alias("log_loss"),
        # Each weight is taken once from the values and once from the bucket totals. Were one of them
        # unused on one side only, the two sides would no longer share a shuffle and a scan.
        F.sum("hit").alias("hits"),
        F.sum("alarm").alias("alarms"),
        (F.max("total_pos") - F.max("total_hit")).alias("misses"),
        (F.max("total_neg") - F.max("total_alarm")).alias("rejections"),
    )
    return totals.select(
        "model",
        "area_under_pr",
        "area_under_roc",
        "log_loss",
        F.col("alarms").alias("false_positives"),
        F.col("hits").alias("true_positives"),
        F.col("rejections").alias("true_negatives"),
        F.col("misses").alias("false_negatives"),
    )


def curve_areas(df: DataFrame, label: str = "label", score: str = "p1", buckets: int | None = None) -> DataFrame:
    """One row: exact ``area_under_pr`` and ``area_under_roc``."""
    return evaluate(df, {"": (score, None)}, label, buckets).select("area_under_pr", "area_under_roc")


def compare_models(
    df: DataFrame, models: Mapping[str, tuple[str, str | None]], label: str = "label", buckets: int | None = None
) -> DataFrame:
    """``(model, metric, value)``, the model with the largest precision-recall area first."""
    measured = evaluate(df, models, label, buckets)
    rows = [F.struct(F.lit(i).alias("position"), F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for i, m in enumerate(METRICS)]
    long = measured.select("model", F.col("area_under_pr").alias("order_key"), F.inline(F.array(*rows)))
    return long.orderBy(F.desc("order_key"), "model", "position").select("model", "metric", "value")


def fit_summary(
    df: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "p1", buckets: int | None = None
) -> DataFrame:
    """``(Metric, Class_0, Class_1)``: rates of both classes, accuracy and area under the ROC curve.

    Works for any classifier and any set of predictions. A class that is never predicted has
    precision and F-measure 0; rates of a class that does not occur are null.
    """
    measured = evaluate(df, {"": (score, prediction)}, label, buckets)
    fp, tp, tn, fn = (F.col(m).cast("double") for m in METRICS[3:])
    recall = (_rate(tn, tn + fp), _rate(tp, tp + fn))
    precision = (F.coalesce(_rate(tn, tn + fn), F.lit(0.0)), F.coalesce(_rate(tp, tp + fp), F.lit(0.0)))
    false_rate = (_rate(fn, tp + fn), _rate(fp, tn + fp))
    f_measure = tuple(F.coalesce(_rate(2.0 * p * r, p + r), F.lit(0.0)) for p, r in zip(precision, recall))
    accuracy = _rate(tp + tn, tp + tn + fp + fn)
    table = {
        "Prediction labels": (F.lit(0.0), F.lit(1.0)),
        "True Positive Rate": recall,
        "Recall": recall,
        "Precision": precision,
        "False Positive Rate": false_rate,
        "F-measure": f_measure,
        "Total Accuracy": (F.lit(0.0), accuracy),
        "Area Under ROC": (F.lit(0.0), F.col("area_under_roc")),
    }
    rows = [F.struct(F.lit(m).alias("Metric"), a.alias("Class_0"), b.alias("Class_1")) for m, (a, b) in table.items()]
    return measured.select(F.inline(F.array(*rows)))
