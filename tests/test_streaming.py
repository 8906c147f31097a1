"""Rows that arrive in files are scored once each, with the scores of the batch job."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from registry.inputs import TARGET_ROLES
from registry.modelling import modelling_lines
from tabloom.operators import models, scoring
from tabloom.operators.features import FEATURES, LABEL_COLUMN, fit_features
from tabloom.sinks.fitted import save_models, save_pipeline
from tabloom.streaming.scoring import arriving, score_arriving


def test_new_files_are_scored_once(spark, sf_dir, tmp_path):
    lines = modelling_lines(spark, sf_dir)
    fitted = fit_features(lines, TARGET_ROLES)
    small = dataclasses.replace(models.LOGISTIC, settings={**models.LOGISTIC.settings, "maxIter": 5})
    model = models.fit(small, fitted.transform(lines).select(LABEL_COLUMN, FEATURES))
    save_pipeline(fitted.model, str(tmp_path / "pipeline"))
    save_models({"lr": model}, {"lr": str(tmp_path / "lr")})
    unlabelled = lines.drop(TARGET_ROLES.label)
    folder = str(tmp_path / "in")

    def run():
        stream = arriving(spark, folder, unlabelled.schema, files_per_batch=2)
        query = score_arriving(stream, str(tmp_path / "pipeline"), "lr", str(tmp_path / "lr"), str(tmp_path / "out"), str(tmp_path / "state"))
        assert query.awaitTermination(300)
        return spark.read.parquet(str(tmp_path / "out"))

    first = F.col("l_orderkey") % 3 == 0
    unlabelled.where(first).repartition(5).write.parquet(folder)
    assert run().count() == unlabelled.where(first).count()
    unlabelled.where(~first).repartition(3).write.mode("append").parquet(folder)
    scored = run()
    assert "features" not in scored.columns and run().count() == unlabelled.count()
    columns = [*unlabelled.columns, "prediction", "p1"]
    batch = scoring.score(unlabelled, fitted.model, model).select(columns)
    assert scored.select(columns).exceptAll(batch).count() == 0
