"""Evaluation of scores: areas, curves, losses, confusion counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.inputs import PLACES, SCORED_CTE, rounded, scored_lines, table
from registry.profiling import union_all
from tabloom.operators import metrics

CURVE_CTE = f"""{SCORED_CTE},
points AS (SELECT p1, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM scored GROUP BY p1),
curve AS (
  SELECT p1 AS threshold, pos, neg,
         sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg
  FROM points WINDOW w AS (ORDER BY p1 DESC)),
steps AS (
  SELECT *, tp / (tp + fp) AS prec, coalesce((tp - pos) / nullif(tp + fp - pos - neg, 0), tp / (tp + fp)) AS prec_before FROM curve),
areas AS (
  SELECT sum(pos / all_pos * (prec_before + prec) / 2) AS area_under_pr,
         sum(neg / all_neg * (tp - pos + tp) / all_pos / 2) AS area_under_roc FROM steps),
cells AS (
  SELECT count(*) FILTER (prediction = 1 AND label = 0) AS fp, count(*) FILTER (prediction = 1 AND label = 1) AS tp,
         count(*) FILTER (prediction = 0 AND label = 0) AS tn, count(*) FILTER (prediction = 0 AND label = 1) AS fn,
         avg(-(label * ln(p1) + (1 - label) * ln(1 - p1))) AS log_loss FROM scored)"""


@query("curve_areas", f"WITH {CURVE_CTE} SELECT round(area_under_pr, {PLACES}) AS area_under_pr, round(area_under_roc, {PLACES}) AS area_under_roc FROM areas")
def curve_areas(spark, sf_dir):
    return rounded(metrics.curve_areas(scored_lines(spark, sf_dir)), "area_under_pr", "area_under_roc")


@query(
    "curve_areas_few_scores",
    f"""WITH scored AS (SELECT CAST(l_linestatus = 'O' AS DOUBLE) AS label, l_tax AS p1, 0.0::DOUBLE AS prediction FROM lineitem),
{CURVE_CTE[len(SCORED_CTE) + 1:]}
SELECT round(area_under_pr, {PLACES}) AS area_under_pr, round(area_under_roc, {PLACES}) AS area_under_roc FROM areas""".replace(
        "avg(-(label * ln(p1) + (1 - label) * ln(1 - p1)))", "0"
    ),
)
def curve_areas_few_scores(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select((F.col("l_linestatus") == "O").cast("double").alias("label"), F.col("l_tax").alias("p1"))
    return rounded(metrics.curve_areas(lines), "area_under_pr", "area_under_roc")


@query(
    "curve_areas_documents",
    f"""WITH scored AS (SELECT CAST(quality AS DOUBLE) AS label, CAST(n_chars AS DOUBLE) AS p1, 0.0::DOUBLE AS prediction
  FROM documents JOIN labels ON documents.doc_id = labels.doc_id),
{CURVE_CTE[len(SCORED_CTE) + 1:]}
SELECT round(area_under_pr, {PLACES}) AS area_under_pr, round(area_under_roc, {PLACES}) AS area_under_roc FROM areas""".replace(
        "avg(-(label * ln(p1) + (1 - label) * ln(1 - p1)))", "0"
    ),
)
def curve_areas_documents(spark, sf_dir):
    """How well the length of a document ranks its quality; any number can serve as a score."""
    labelled = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")
    scores = labelled.select(F.col("quality").cast("double").alias("label"), F.col("n_chars").cast("double").alias("p1"))
    return rounded(metrics.curve_areas(scores), "area_under_pr", "area_under_roc")


@query(
    "threshold_curve",
    f"""WITH {CURVE_CTE}
SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       CAST(all_neg - fp AS BIGINT) AS tn, CAST(all_pos - tp AS BIGINT) AS fn,
       round(tp / (tp + fp), {PLACES}) AS precision, round(tp / all_pos, {PLACES}) AS recall, round(fp / all_neg, {PLACES}) AS fpr
FROM curve""",
)
def threshold_curve(spark, sf_dir):
    curve = metrics.threshold_curve(scored_lines(spark, sf_dir))
    return rounded(curve, "precision", "recall", "fpr")


@query("log_loss", f"WITH {CURVE_CTE} SELECT round(log_loss, {PLACES}) AS log_loss FROM cells")
def log_loss(spark, sf_dir):
    return rounded(metrics.mean_log_loss(scored_lines(spark, sf_dir)), "log_loss")


@query(
    "log_loss_certain",
    f"""WITH scored AS (SELECT CAST(l_linestatus = 'O' AS DOUBLE) AS y, greatest(1e-15, least(1 - 1e-15, l_discount * 10)) AS p FROM lineitem)
SELECT round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), {PLACES}) AS log_loss FROM scored""",
)
def log_loss_certain(spark, sf_dir):
    # Scores of exactly 0 and 1 occur; they must neither fail nor drop out.
    lines = table(spark, sf_dir, "lineitem").select(
        (F.col("l_linestatus") == "O").cast("double").alias("label"), (F.col("l_discount") * 10).alias("p1")
    )
    return rounded(metrics.mean_log_loss(lines), "log_loss")


@query(
    "confusion",
    f"""WITH {CURVE_CTE} SELECT CAST(fp AS BIGINT) AS false_positives, CAST(tp AS BIGINT) AS true_positives,
CAST(tn AS BIGINT) AS true_negatives, CAST(fn AS BIGINT) AS false_negatives FROM cells""",
)
def confusion(spark, sf_dir):
    return metrics.confusion(scored_lines(spark, sf_dir))


SUMMARY_ROWS = {
    "Prediction labels": ("0", "1"),
    "True Positive Rate": ("tn / (tn + fp)", "tp / (tp + fn)"),
    "Recall": ("tn / (tn + fp)", "tp / (tp + fn)"),
    "Precision": ("tn / (tn + fn)", "tp / (tp + fp)"),
    "False Positive Rate": ("fn / (tp + fn)", "fp / (tn + fp)"),
    "F-measure": ("2 * tn / (2 * tn + fn + fp)", "2 * tp / (2 * tp + fn + fp)"),
    "Total Accuracy": ("0", "(tp + tn) / (tp + tn + fp + fn)"),
    "Area Under ROC": ("0", "area_under_roc"),
}


@query(
    "fit_summary",
    f"WITH {CURVE_CTE} SELECT * FROM ("
    + union_all(
        f"""SELECT '{name}' AS "Metric", round(CAST({a} AS DOUBLE), {PLACES}) AS "Class_0", round(CAST({b} AS DOUBLE), {PLACES}) AS "Class_1" FROM cells, areas"""
        for name, (a, b) in SUMMARY_ROWS.items()
    )
    + ")",
)
def fit_summary(spark, sf_dir):
    return rounded(metrics.fit_summary(scored_lines(spark, sf_dir)), "Class_0", "Class_1")


@query(
    "evaluate_scores",
    f"""WITH {CURVE_CTE} SELECT 'given' AS model, round(area_under_pr, {PLACES}) AS area_under_pr,
round(area_under_roc, {PLACES}) AS area_under_roc, round(log_loss, {PLACES}) AS log_loss, CAST(fp AS BIGINT) AS false_positives,
CAST(tp AS BIGINT) AS true_positives, CAST(tn AS BIGINT) AS true_negatives, CAST(fn AS BIGINT) AS false_negatives FROM cells, areas""",
)
def evaluate_scores(spark, sf_dir):
    measured = metrics.evaluate(scored_lines(spark, sf_dir), {"given": ("p1", "prediction")})
    return rounded(measured, "area_under_pr", "area_under_roc", "log_loss")
